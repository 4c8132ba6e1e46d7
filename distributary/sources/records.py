"""A streaming source over a record log, with positions of its own and a cap of records per batch.

A record log is a folder of Parquet files with ``arrived`` (when the log took the record) and ``data`` (its bytes).
Files are never changed; new ones sort behind older ones by name. A position is a file and a number of its rows. Where
a stream starts is said once: at the beginning of the log (TRIM_HORIZON), behind what is there (LATEST), or with the
records that arrived at a time or later (AT_TIMESTAMP). A batch has at most ``max_records`` rows of the log.

Planning a batch reads the footers of the files it enters, no records. Tasks read slices of ``slice_records`` rows.
The position behind the last finished batch is kept in a file below ``positions``, a folder that belongs to the
stream's checkpoint: Spark tells a restarted source where it stands only when it plans the next batch.

    spark.dataSource.register(RecordLog)
    spark.readStream.format("record_log").options(path=..., positions=..., position="AT_TIMESTAMP",
        timestamp="2024-03-01 00:00:00", max_records=10000).load()
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from distributary.sources.lines import AT_TIMESTAMP, LATEST, TRIM_HORIZON

RECORD = "arrived timestamp_ntz, data binary"
ARROW_RECORD = pa.schema([("arrived", pa.timestamp("us")), ("data", pa.binary())])
START = ("", 0)
SLICE_RECORDS = 100_000

Position = tuple[str, int]


@dataclass
class Slice(InputPartition):
    """Rows of one file."""

    file: str
    low: int
    high: int


class RecordLog(DataSource):
    """The source ``record_log``."""

    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return RECORD

    def streamReader(self, schema: object) -> RecordLogReader:
        return RecordLogReader(dict(self.options))


class RecordLogReader(DataSourceStreamReader):
    """Plans batches of bounded size and reads them."""

    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.positions = options["positions"]
        self.position = options.get("position", TRIM_HORIZON)
        if self.position not in (TRIM_HORIZON, LATEST, AT_TIMESTAMP):
            raise ValueError(f"unknown start position {self.position!r}")
        self.since = None
        if self.position == AT_TIMESTAMP:
            if "timestamp" not in options:
                raise ValueError("AT_TIMESTAMP needs a timestamp")
            self.since = datetime.fromisoformat(options["timestamp"])
        self.max_records = int(options.get("max_records", 10_000))
        self.slice_records = int(options.get("slice_records", SLICE_RECORDS))
        self.sizes: dict[str, int] = {}
        self.known: Position | None = None
        self.offered: Position | None = None

    # Files and positions

    def store(self, folder: str) -> tuple[pa.fs.FileSystem, str]:
        return pa.fs.FileSystem.from_uri(folder) if "://" in folder else (pa.fs.LocalFileSystem(), folder.removeprefix("file:"))

    def files(self) -> list[str]:
        store, path = self.store(self.folder)
        listed = store.get_file_info(pa.fs.FileSelector(path, recursive=False))
        return sorted(f.base_name for f in listed if f.base_name.endswith(".parquet"))

    def open(self, file: str) -> pq.ParquetFile:
        store, path = self.store(self.folder)
        return pq.ParquetFile(store.open_input_file(f"{path}/{file}"))

    def size(self, file: str) -> int:
        if file not in self.sizes:
            self.sizes[file] = self.open(file).metadata.num_rows
        return self.sizes[file]

    def slices(self, start: Position, end: Position | None) -> Iterator[Slice]:
        """Rows behind ``start`` up to ``end``, file by file."""
        for file in self.files():
            if file < start[0] or (end is not None and file > end[0]):
                continue
            low = start[1] if file == start[0] else 0
            high = end[1] if end is not None and file == end[0] else self.size(file)
            if low < high:
                yield Slice(file, low, high)

    def ahead(self, start: Position) -> Position:
        """The position at most ``max_records`` behind ``start``."""
        left, at = self.max_records, start
        for part in self.slices(start, None):
            taken = min(left, part.high - part.low)
            at, left = (part.file, part.low + taken), left - taken
            if not left:
                break
        return at

    def behind_all(self) -> Position:
        files = self.files()
        return (files[-1], self.size(files[-1])) if files else START

    def first_since(self) -> Position:
        """The first file with a record of that time or later, by the statistics in its footer; earlier ones are not read."""
        for file in self.files():
            footer = self.open(file).metadata
            column = footer.schema.names.index("arrived")
            for group in range(footer.num_row_groups):
                known = footer.row_group(group).column(column).statistics
                if known is None or not known.has_min_max or known.max.replace(tzinfo=None) >= self.since:
                    return file, 0
        return self.behind_all()

    def noted(self) -> Position | None:
        store, path = self.store(self.positions)
        if store.get_file_info(f"{path}/position").type != pa.fs.FileType.File:
            return None
        with store.open_input_file(f"{path}/position") as file:
            return position_of(json.loads(file.read()))

    # Calls from Spark

    def initialOffset(self) -> dict:
        starts = {TRIM_HORIZON: lambda: START, LATEST: self.behind_all, AT_TIMESTAMP: self.first_since}
        self.known = starts[self.position]()
        self.note(self.known)
        return offset_of(self.known)

    def latestOffset(self) -> dict:
        if self.known is None:
            self.known = self.noted() or START
        if self.offered is not None and self.offered > self.known:
            self.known = self.offered  # it was offered before and needed no batch: it is finished
        self.offered = self.ahead(self.known)
        return offset_of(self.offered)

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        first, last = position_of(start), position_of(end)
        self.known = max(last, self.known or last)
        step = self.slice_records
        return [
            Slice(part.file, low, min(low + step, part.high))
            for part in self.slices(first, last)
            for low in range(part.low, part.high, step)
        ]

    def commit(self, end: dict) -> None:
        self.note(position_of(end))

    def note(self, position: Position) -> None:
        store, path = self.store(self.positions)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/position.new") as file:
            file.write(json.dumps(offset_of(position)).encode())
        store.move(f"{path}/position.new", f"{path}/position")

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        """Records of a slice; row groups outside it are not read."""
        file, first = self.open(partition.file), 0
        for group in range(file.metadata.num_row_groups):
            size = file.metadata.row_group(group).num_rows
            low, high = max(partition.low - first, 0), min(partition.high - first, size)
            first += size
            if low >= high:
                continue
            table = file.read_row_group(group, columns=["arrived", "data"]).slice(low, high - low)
            table = pa.table([table.column(f.name).cast(f.type) for f in ARROW_RECORD], schema=ARROW_RECORD)
            if self.since is not None:
                table = table.filter(pc.greater_equal(table.column("arrived"), pa.scalar(self.since, pa.timestamp("us"))))
            yield from table.to_batches(max_chunksize=10_000)


def offset_of(position: Position) -> dict:
    return {"file": position[0], "row": position[1]}


def position_of(offset: dict) -> Position:
    return offset["file"], offset["row"]
