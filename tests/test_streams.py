"""Positions of the record log and puts of the bounded sink, without a session."""

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from distributary.sources.records import RecordLogReader
from distributary.streaming.puts import PutWriter, puts_of

BEGIN = datetime(2024, 5, 1)


def write_log(folder, name, first, n):
    rows = {"arrived": [BEGIN + timedelta(hours=first + i) for i in range(n)], "data": [str(first + i).encode() for i in range(n)]}
    pq.write_table(pa.table(rows), f"{folder}/{name}.parquet", row_group_size=4)


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    for name, first, n in (("a", 0, 10), ("b", 10, 1), ("c", 11, 6)):
        write_log(folder, name, first, n)
    return folder


def reader(log, **options):
    return RecordLogReader({"path": str(log), "positions": str(log.parent / "positions"), "max_records": "4"} | options)


def records(source, start, end):
    parts = source.partitions(start, end)
    return [int(v) for part in parts for batch in source.read(part) for v in batch.column("data").to_pylist()]


def run(source, start, batches):
    """As Spark does: the next offset, its batch, and the one before is finished."""
    got = []
    for _ in range(batches):
        end = source.latestOffset()
        if end != start:
            got.append(records(source, start, end))
            source.commit(end)
            start = end
    return got, start


def test_batches_are_capped_and_cover_the_log(log):
    source = reader(log, slice_records="3")
    got, end = run(source, source.initialOffset(), 8)
    assert [len(g) for g in got] == [4, 4, 4, 4, 1] and sum(got, []) == list(range(17))
    write_log(log, "d", 17, 3)
    assert run(source, end, 2)[0] == [[17, 18, 19]]


@pytest.mark.parametrize("lost", [False, True])
def test_a_restart_goes_on_behind_the_last_batch(log, lost):
    source = reader(log)
    start = source.initialOffset()
    first = source.latestOffset()
    assert records(source, start, first) == [0, 1, 2, 3]
    source.commit(first)
    second = source.latestOffset()
    assert records(source, first, second) == [4, 5, 6, 7]
    if not lost:
        source.commit(second)  # else the source never hears that its last batch is done
    got, _ = run(reader(log), second, 6)
    assert sum(got, []) == list(range(8, 17)) and all(len(g) <= 4 for g in got)


def test_start_positions(log):
    since = reader(log, position="AT_TIMESTAMP", timestamp="2024-05-01T12:30:00", max_records="100")
    start = since.initialOffset()
    assert start == {"file": "c.parquet", "row": 0}
    assert records(since, start, since.latestOffset()) == [13, 14, 15, 16]
    latest = reader(log, position="LATEST")
    end = latest.initialOffset()
    assert latest.latestOffset() == end
    write_log(log, "d", 17, 2)
    assert records(latest, end, latest.latestOffset()) == [17, 18]
    for wrong in ({"position": "SOMEWHERE"}, {"position": "AT_TIMESTAMP"}):
        with pytest.raises(ValueError):
            reader(log, **wrong)


def test_puts_are_bounded():
    items = ["x" * 30, "é" * 10, "y", "z" * 90, "w", "v", "u", "t"]
    assert list(puts_of(iter(items), 3, 50)) == [items[:2], [items[2]], [items[3]], items[4:7], items[7:]]
    assert list(puts_of(iter([]), 3, 50)) == []


def test_repeated_and_failed_tasks_leave_nothing(tmp_path):
    writer = PutWriter(str(tmp_path / "sink"), 2, 1000)
    batch = pa.record_batch({"value": ["a", None, "b", "c"]})
    lost, done, failed = (writer.write(iter([batch])) for _ in range(3))
    writer.abort([failed, None], 1)
    writer.commit([done, None], 0)
    writer.commit([done, None], 0)
    assert done.items == 3
    table = pq.read_table(tmp_path / "sink" / "puts" / done.file).to_pydict()
    assert table == {"put": [0, 0, 1], "value": ["a", "b", "c"]}
    left = {p.name for p in (tmp_path / "sink" / "puts").iterdir()}
    assert left == {lost.file, done.file}
    manifests = list((tmp_path / "sink" / "manifests").iterdir())
    assert len(manifests) == 1 and done.file in manifests[0].read_text() and lost.file not in manifests[0].read_text()
