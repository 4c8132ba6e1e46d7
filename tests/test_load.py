import json

import pytest
from pyspark.sql import functions as F

from catalog import inputs
from catalog.queries import existing_tables, halves
from distributary.functions.event_layout import LINE_FIELDS
from distributary.functions.schema_uri import URI_PREFIX
from distributary.operators.shred import INLINE_MODE, Registry, shred_entities
from distributary.operators.parse import parse_enriched, parse
from distributary.functions.json_values import marked, written_at
from distributary.plans.batches import commit, committed, drop_abandoned
from distributary.plans.shredding import bad_records, event_rows, shred
from distributary.plans.tables import (
    create_events_table,
    describe_table,
    list_tables,
    table_comments,
    widen_columns,
)
from distributary.functions.casts import cast_json
from distributary.settings import BATCH_COLUMN, Settings, work_dir
from distributary.sources.lines import (
    AT_TIMESTAMP,
    LATEST,
    TRIM_HORIZON,
    broker_options,
    read_lines,
    start_from,
    stream_lines,
)
from distributary.sources.registry import schemas_from
from distributary.streaming.load import Loader
from distributary.streaming.sinks import DiscardingSink, text_sink
from tests.conftest import SF_DIR
from tests.test_registry import SLIP_COLUMNS, SLIPS, TEXT, VENDOR, document

EVENT_ID = "5f0d1a52-33c4-4d0e-9a5b-0c2f7be1d604"
SLIP_TABLE = "net_quillhouse_loan_slip_2"
JSON_LINES = Settings(inputs.ATOMIC_SCHEMA, purpose="JSON")


def line(**values):
    base = {
        "event_id": EVENT_ID,
        "collector_tstamp": "2024-01-01 00:00:00.000",
        "v_collector": "c",
        "v_etl": "e",
    }
    return "\t".join((base | values).get(f.name, "") for f in LINE_FIELDS)


def frame(spark, lines):
    return spark.createDataFrame([(text,) for text in lines], "value string")


def json_line(name, version, data):
    """A self-describing payload; ``data`` as JSON text or as a value."""
    text = data if isinstance(data, str) else json.dumps(data)
    return f'{{"schema":"{URI_PREFIX}{VENDOR}/{name}/jsonschema/{version}","data":{text}}}'


def slip(version="2-0-0", **data):
    return json_line("LoanSlip", version, {"due": "2025-03-09", "renewable": False} | data)


def registry_of(spark, documents):
    texts = spark.createDataFrame([(json.dumps(d),) for d in documents], "document string")
    return Registry.from_schemas(schemas_from(texts), mode=INLINE_MODE)


def test_times_far_away(spark):
    far = ["0003-02-01 00:00:00.000", "4810-11-05 23:59:59.000", "9999-12-31 00:00:00"]
    parsed = parse_enriched(frame(spark, [line(collector_tstamp=t) for t in far]))
    found = parsed.select(F.size("errors").alias("n"), F.col("atomic.collector_tstamp").cast("string").alias("t"))
    assert [(r.n, r.t) for r in found.collect()] == [(0, t[:19]) for t in far]


def test_purpose_is_checked(spark):
    with pytest.raises(ValueError):
        parse(frame(spark, [""]), "OTHER")
    with pytest.raises(ValueError):
        Settings(atomic_schema="", purpose="OTHER")


def test_records_with_one_id_stand_alone(spark):
    """A failed record does not take another one with the same id along."""
    lines = frame(spark, [line(), line(geo_country="USA"), line()])
    records = shred(lines, inputs.registry(spark), inputs.SETTINGS)
    assert event_rows(records).count() == 2
    assert bad_records(records).first().kind == "loader_runtime_error"


def test_joined_registry_gives_the_same(spark):
    parsed = parse_enriched(inputs.enriched_lines(spark, SF_DIR))
    small = inputs.registry(spark)
    large = Registry.from_schemas(small.schemas, folder=work_dir(spark))
    assert small.inline is not None and large.inline is None
    with pytest.raises(ValueError):
        Registry.from_schemas(small.schemas, mode=INLINE_MODE, max_bytes=100)
    with pytest.raises(ValueError):
        Registry.from_schemas(small.schemas)

    def result(registry):
        shredded = shred_entities(parsed, registry, True, inputs.ATOMIC_SCHEMA)
        return sorted(r.j for r in shredded.select(F.to_json(F.struct("payload", "entities")).alias("j")).collect())

    assert result(small) == result(large)


def test_invalid_schema_spoils_its_group(spark):
    broken = document("LoanSlip", {}, "2-1-2") | {"type": 5}
    records = shred(frame(spark, [slip()]), registry_of(spark, [*SLIPS, broken]), JSON_LINES)
    assert bad_records(records).first().errors[0].error == "InvalidSchema"


def test_payloads_of_all_versions(spark, database):
    lines = frame(spark, [
        slip(copiesHeld=40),
        slip("2-0-1", shelf="Q7-b", due=None),
        json_line("LoanSlip", "2-1-0", '{"due":"2025-03-11","fee":{"currency":"DKK","amount":12.50},"renewable":true}'),
        json_line("LoanSlip", "2-1-1", '{"renewable":true,"branch":"pier","due":"2025-03-12","remarks":[ 2.50, {"z":1e2,"a":-0}]}'),
    ])
    sink = DiscardingSink()
    Loader(spark, registry_of(spark, SLIPS), JSON_LINES, database, sink).load(lines)
    assert list_tables(spark, database) == [SLIP_TABLE] and sink.total == 1  # a slip that is never due
    described = describe_table(spark, database, SLIP_TABLE).collect()
    assert [f'"{r.column_name}"' for r in described] == [c.split()[0] for c in SLIP_COLUMNS]
    assert {r.column_name: r.data_type for r in described}["branch"] == "varchar(5)"
    rows = committed(spark, database, SLIP_TABLE).orderBy("due").collect()
    assert [str(r.due) for r in rows] == ["2025-03-09", "2025-03-11", "2025-03-12"]
    assert [r["fee.amount"] for r in rows] == [None, 12.5, None]
    assert [r.copies_held for r in rows] == [40, None, None]
    assert rows[2].remarks == '[2.50,{"z":1e2,"a":-0}]' and rows[2].branch == "pier"


def test_entity_without_values_is_bad(spark):
    memo = document("memo", {"body": TEXT})
    records = shred(frame(spark, [json_line("memo", "1-0-0", {})]), registry_of(spark, [memo]), JSON_LINES)
    assert bad_records(records).first().errors[0].message.startswith("Cannot insert: ")


def test_table_evolves_by_steps(spark, database):
    widths = []
    for n, last in ((1, "2-0-0"), (2, "2-0-1"), (4, "2-1-1")):
        Loader(spark, registry_of(spark, SLIPS[:n]), JSON_LINES, database).load(frame(spark, [slip(last)]))
        widths.append(len(describe_table(spark, database, SLIP_TABLE).collect()))
        comment = table_comments(spark, database).first().comment
        assert comment == f"{URI_PREFIX}{VENDOR}/LoanSlip/jsonschema/{last}"
    assert widths == [3, 4, 8]
    assert committed(spark, database, SLIP_TABLE).where("branch is null and due is not null").count() == 3


def test_the_registry_is_asked_once_for_what_is_missing(spark, database):
    """New versions and groups are found once a batch names them; what nobody lists is not asked for again in its time."""
    now, asked, listed = [0.0], [], [SLIPS[:1]]
    sink = DiscardingSink()

    def reload():
        asked.append(now[0])
        return registry_of(spark, listed[0])

    loader = Loader(spark, reload(), JSON_LINES, database, sink, reload=reload, clock=lambda: now[0])
    shredded = []
    stage = loader.stage
    loader.stage = lambda lines, path: shredded.append(path) or stage(lines, path)

    def load(time, *lines):
        now[0] = time
        loader.load(frame(spark, lines))
        return len(asked) - 1, len(shredded), sink.total, loader.unlisted

    assert load(1, slip()) == (0, 1, 0, 0)
    stray = json_line("stray", "1-0-0", {"a": "b"})
    assert load(2, slip(), stray) == (1, 2, 1, 0)
    assert load(3, stray, slip()) == (1, 3, 2, 0)
    listed[0] = SLIPS[:2]
    assert load(4, slip("2-0-1", shelf="B-12")) == (2, 5, 2, 0)
    assert load(5, slip("2-0-7")) == (3, 6, 2, 1)
    assert load(6, slip("2-0-7"), stray) == (3, 7, 3, 2)
    listed[0] = [*SLIPS, document("stray", {"a": TEXT})]
    assert load(700, stray) == (4, 8, 3, 2)
    rows = committed(spark, database, SLIP_TABLE)
    assert rows.count() == 6 and rows.where("shelf = 'B-12'").count() == 1
    assert committed(spark, database, "net_quillhouse_stray_1").count() == 1


def test_colliding_columns_do_not_stop_a_batch(spark, database):
    documents = [*SLIPS, document("pair", {"shelfMark": TEXT, "shelf_mark": TEXT})]
    sink = DiscardingSink()
    lines = frame(spark, [json_line("pair", "1-0-0", {"shelfMark": "x"}), slip()])
    Loader(spark, registry_of(spark, documents), JSON_LINES, database, sink).load(lines)
    assert sink.total == 1 and committed(spark, database, SLIP_TABLE).count() == 1


def test_events_table_and_catalog(spark, database):
    assert create_events_table(spark, database)
    assert not create_events_table(spark, database)
    assert list_tables(spark, database) == ["events"]
    described = describe_table(spark, database, "events").collect()
    assert len(described) == 128
    assert not spark.catalog.tableExists(f"{database}.missing")


def test_replayed_batch_and_bad_rows(spark, database, tmp_path):
    lines = inputs.enriched_lines(spark, SF_DIR)
    sink = text_sink(str(tmp_path / "bad"))
    loader = Loader(spark, inputs.registry(spark), inputs.SETTINGS, database, sink)
    loader.load_batch(lines, 7, "one")
    first = committed(spark, database, "events").count()
    loader.load_batch(lines, 7, "one")
    assert committed(spark, database, "events").count() == first
    total = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    bad = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "bad")).collect()]
    assert first + len(bad) == total
    assert {b["processor"]["artifact"] for b in bad} == {"distributary"}


def test_what_a_stopped_batch_left_is_never_seen(spark, database):
    class Stopping(Loader):
        def fill(self, staged, table, batch_id, token):
            super().fill(staged, table, batch_id, token)
            raise InterruptedError(table)

    def load(loader, number, stream="one"):
        loader(spark, inputs.registry(spark), inputs.SETTINGS, database).load_batch(frame(spark, [line(), line()]), number, stream)
        return committed(spark, database, "events").count()

    assert load(Loader, 0) == 2
    for _ in range(2):
        with pytest.raises(InterruptedError):
            load(Stopping, 1)
    assert committed(spark, database, "events").count() == 2
    assert [load(Loader, 1), load(Loader, 1), load(Loader, 0), load(Loader, 0, "other")] == [4, 4, 4, 6]
    assert spark.table(f"{database}.events").count() == 10
    assert drop_abandoned(spark, database, "events") == 2
    assert spark.table(f"{database}.events").count() == committed(spark, database, "events").count() == 6
    for token in "ab":  # two drivers commit the same batch
        rows = spark.table(f"{database}.events").limit(1).withColumn(BATCH_COLUMN, F.lit(token))
        rows.write.insertInto(f"{database}.events")
        commit(spark, database, token, "one", 2)
    assert committed(spark, database, "events").count() == 7


def test_widening_keeps_rows_comment_and_other_widths(spark, database):
    Loader(spark, registry_of(spark, SLIPS), JSON_LINES, database).load(frame(spark, [slip("2-1-1", branch="north")]))
    before = describe_table(spark, database, SLIP_TABLE).collect()
    spark.sql(f"CREATE TABLE {database}.{SLIP_TABLE}__wide (x string) USING parquet")  # left by a call that stopped
    widen_columns(spark, database, SLIP_TABLE, ["branch"], "VARCHAR(40)")
    after = describe_table(spark, database, SLIP_TABLE).collect()
    changed = [(a.column_name, b.data_type) for a, b in zip(before, after, strict=True) if a != b]
    assert changed == [("branch", "varchar(40)")]
    assert list_tables(spark, database) == [SLIP_TABLE]
    assert table_comments(spark, database).first().comment.endswith("/2-1-1")
    assert committed(spark, database, SLIP_TABLE).first().branch == "north"


def test_no_loader_loses_batches_of_another(spark, database, tmp_path):
    """Two loads, then a stream, a second one on the same files, and the first again: nothing lost or doubled."""
    def loader():
        return Loader(spark, inputs.registry(spark), inputs.SETTINGS, database)

    def count():
        return committed(spark, database, "events").count()

    loader().load(frame(spark, [line(), line()]))
    same = loader()
    same.load(frame(spark, [line()]))
    same.load(frame(spark, [line()]))
    assert count() == 4
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.tsv").write_text(line() + "\n" + line() + "\n")

    def run(checkpoint):
        lines = stream_lines(spark, str(folder), 1)
        loader().stream(lines, str(tmp_path / checkpoint), once=True).awaitTermination()
        return count()

    assert run("one") == 6
    assert run("two") == 8
    (folder / "b.tsv").write_text(line() + "\n")
    assert [run("one"), run("two"), run("one")] == [9, 10, 10]


def test_malformed_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"ab\xffcd\n")
    assert [r.value for r in read_lines(spark, str(tmp_path)).collect()] == ["ab\ufffdcd"]
    strict = Settings(inputs.ATOMIC_SCHEMA, decoding="strict")
    records = shred(read_lines(spark, str(tmp_path), "strict"), inputs.registry(spark), strict)
    bad = bad_records(records).first()
    assert (bad.kind, bad.payload) == ("loader_parsing_error", "YWL/Y2Q=")
    assert bad.errors[0].message == "Cannot deserialize payload as UTF-8"


def test_lengths_by_column(spark):
    settings = Settings(inputs.ATOMIC_SCHEMA, lengths={"page_title": 1200, "page_url": 10})
    lines = frame(spark, [line(page_title="t" * 1500, page_url="u" * 50, page_referrer="r" * 1500)])
    row = event_rows(shred(lines, inputs.registry(spark), settings)).first()
    assert [len(row[c]) for c in ("page_title", "page_url", "page_referrer")] == [1200, 10, 1024]


def test_whole_numbers_are_exact_however_written(spark):
    cases = {
        "1e3": 1000, "9007199254740993e0": 9007199254740993, "9007199254740993": 9007199254740993, "5.0": 5, "0e5": 0,
        "-92233720368547758.08e2": -9223372036854775808, "9223372036854775808e0": None, "15e-1": None, "1e999999999999": None,
        "0.00000000000000000000000000000000000000001e41": 1, "1.0000000000000000000000000000000000000000001": None,
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    value, problem = cast_json(F.parse_json("t"), "BIGINT", written=F.col("t"))
    found = {r.t: (r.v, r.e is None) for r in rows.select("t", value.alias("v"), problem.alias("e")).collect()}
    assert found == {t: (v, v is not None) for t, v in cases.items()}


def test_json_as_written(spark):
    """Marked text of fields: keys in order, numbers untouched, strings never taken for numbers, the last of equal keys."""
    documents = {
        '{"a": 1.10, "b": {"z": [1e3 , -0, "1.5", 7], "y": "\\" 2.5"}, "a": 2.50}': ("2.50", '{"z":[1e3,-0,"1.5",7],"y":"\\" 2.5"}'),
        '{"a": "x\ufdd0n1.5", "b": [2.5, "\ufdd0n1.5", "\\\\ufdd0"]}': ("x\ufdd0n1.5", '[2.5,"\ufdd0n1.5","\\\\ufdd0"]'),
        '{"b": ["\\ufdd0n2.5", 1.0, "\\\\\\uFDD0"], "a": 1}': ("1", '["\ufdd0n2.5",1.0,"\\\\\ufdd0"]'),
        '{"a": 12345678901234567890123456789012345678901, "b": null}': ("12345678901234567890123456789012345678901", None),
        '{"a": -0.0, "b": {"k": 1E-7}}': ("-0.0", '{"k":1E-7}'),
    }
    rows = spark.createDataFrame([(t,) for t in documents], "t string")
    at = lambda name: written_at(marked(F.col("t")), F.array(F.lit(name))).alias(name)
    assert {r.t: (r.a, r.b) for r in rows.select("t", at("a"), at("b")).collect()} == documents


def test_stream_goes_on_after_a_restart(spark, database, tmp_path):
    folder = tmp_path / "lines" / "deep"
    folder.mkdir(parents=True)
    (folder / "a.tsv").write_text(line() + "\n\n" + line(br_cookies="1") + "\n")
    sink = DiscardingSink()

    def run():
        loader = Loader(spark, inputs.registry(spark), inputs.SETTINGS, database, sink)
        lines = stream_lines(spark, str(tmp_path / "lines"), 1)
        loader.stream(lines, str(tmp_path / "checkpoint"), once=True).awaitTermination()
        return committed(spark, database, "events").count()

    assert run() == 2
    assert run() == 2
    (folder / "b.tsv").write_text(line() + "\nbroken\n")
    assert run() == 3
    assert sink.total == 1
    assert read_lines(spark, str(tmp_path / "lines")).count() == 4


def test_discards_are_reported_by_period():
    now, timers = [0.0], []

    class Timer:
        def __init__(self, left, action):
            self.left, self.action, self.open = left, action, True
            timers.append(self)

        def start(self):
            pass

        def cancel(self):
            self.open = False

    sink = DiscardingSink(30, lambda: now[0], Timer)
    for count, time in [(2, 10), (1, 31), (0, 70), (4, 80)]:
        now[0] = time
        sink.add(count)
    assert sink.reports == [3] and sink.pending == 4 and sink.total == 7
    assert [(t.left, t.open) for t in timers] == [(20, False), (20, True)]
    now[0] = 100
    timers[-1].action()  # nothing arrives any more
    assert sink.reports == [3, 4] and sink.pending == 0


def test_bad_rows_are_appended(spark, tmp_path):
    sink = text_sink(str(tmp_path / "bad"))
    for text in ("one", "two"):
        sink(frame(spark, [text]), 0)
    assert {r.value for r in spark.read.text(str(tmp_path / "bad")).collect()} == {"one", "two"}


def test_start_positions(spark):
    rows = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, id) as t from range(10)")
    assert start_from(rows, "t", TRIM_HORIZON).count() == 10
    assert start_from(rows, "t", LATEST).count() == 0
    assert start_from(rows, "t", AT_TIMESTAMP, "2024-01-06 00:00:00").count() == 5
    with pytest.raises(ValueError):
        start_from(rows, "t", "SOMEWHERE")
    assert broker_options(LATEST, max_records=5) == {"startingOffsets": "latest", "maxOffsetsPerTrigger": "5"}
    assert broker_options(AT_TIMESTAMP, 5) == {"startingTimestamp": "5"}


def test_a_batch_is_probed_before_it_is_shredded(spark, database):
    """New versions that stand in the text are learned before anything is shredded; an escaped URI is found as before."""
    listed, written = [SLIPS[:1]], []
    loader = Loader(spark, registry_of(spark, SLIPS[:1]), JSON_LINES, database, reload=lambda: registry_of(spark, listed[0]))
    stage = loader.stage

    def staged(lines, path):
        written.append(stage(lines, path) is not None)
        return spark.read.parquet(path) if written[-1] else None

    loader.stage = staged
    listed[0] = SLIPS[:2]
    loader.load(frame(spark, [slip("2-0-1", shelf="B-12"), slip()]))
    assert written == [False, True]
    listed[0] = SLIPS
    loader.load(frame(spark, [slip("2-1-1", branch="pier").replace("/", "\\/")]))
    assert written == [False, True, True, True]
    rows = committed(spark, database, SLIP_TABLE)
    assert rows.count() == 3 and rows.where("branch = 'pier'").count() == rows.where("shelf = 'B-12'").count() == 1
    assert loader.unlisted == 0


def test_halves_are_cut_after_lines_are_made(spark):
    """A filter below the lines would make each of them twice; together the halves hold every line once."""
    parts = halves(spark, SF_DIR)
    for part in parts:
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Filter") < plan.index("Generate")
    everything = sorted(r.value for part in parts for r in part.collect())
    assert everything == sorted(r.value for r in inputs.enriched_lines(spark, SF_DIR).collect())


def test_existing_tables_parse_the_events_once(spark):
    """The result joins names and comments that are known by then; the events are not parsed for it again."""
    found = existing_tables(spark, SF_DIR)
    assert found.columns == ["table_name", "comment", "is_there"]
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
