"""Token ids in Arrow files of equal-length sequences, readable at random without copying.

Documents are dealt out by ranges of ``doc_id``; each task encodes its range in order and writes files whose record
batches hold ``ids`` and ``mask`` as fixed-size lists. All ids of a file form one stream; the last sequence is padded,
and ``mask`` is false on padding. One row per document (file, place of its first id in the file, number of ids) goes to
an index table written by Spark. A file counts only if the index names it, so files of lost or repeated tasks do no
harm: every attempt writes files of its own.

Null and empty texts have the end id alone; any length is encoded whole. Rows without ``doc_id`` come first. Rows with
equal ids are all written, next to each other and in the order of their texts. An empty table gives no file and an
empty index. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from distributary.llm.bpe import PieceCache
from distributary.llm.shared import arrow_schema, new_folder, written
from distributary.llm.text import batch_of, texts_of

SEQUENCE = 2048
BATCH_SEQUENCES = 128
FILE_TOKENS = 16 << 20
END_ID = 0

INDEX = "part int, place long, file string, doc_id long, at long, n_tokens long"
CHECKS = "doc_id long, start long, n_tokens long, ids_crc32 long"


@lru_cache(maxsize=2)
def library_encoder(path: str) -> PieceCache:
    """Pieces encoded by the tokenizers library; equal pieces are encoded once."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    dtype, added = id_type(size), {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    token_bytes = lambda token: len(token.encode()) if token in added else len(token)  # noqa: E731  a character a byte

    lengths = np.array([token_bytes(tokenizer.id_to_token(i)) for i in range(size)])

    def run(parts: list[bytes], inner: np.ndarray) -> list[bytes]:
        found = [b""] * len(parts)
        alone = np.flatnonzero(~inner).tolist()
        texts = [parts[i].decode() for i in alone]
        for i, e in zip(alone, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            found[i] = np.array(e.ids, dtype=dtype).tobytes()
        # Pieces that stay apart in any order are encoded as one text, and told apart by the bytes of their tokens.
        joined = np.flatnonzero(inner)
        text = b"".join([parts[i] for i in joined.tolist()]).decode()
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=dtype)
        ends = np.searchsorted(np.cumsum(lengths[ids]), np.cumsum([len(parts[i]) for i in joined.tolist()])) + 1
        raw, ends = ids.tobytes(), (ends * ids.itemsize).tolist()
        for i, low, high in zip(joined.tolist(), [0, *ends], ends, strict=False):
            found[i] = raw[low:high]
        return found

    return PieceCache(run, dtype, added)


def id_type(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.uint32


class SequenceFile:
    """Writes a stream of ids as batches of fixed-size lists."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, length: int) -> None:
        self.length, self.dtype, self.size = length, dtype, 0
        self.kept: list[np.ndarray] = []
        self.waiting = 0
        self.name = name
        store, path = pa.fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        self.out = store.open_output_stream(f"{path}/{name}")
        values = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(values, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(self.out, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.kept.append(ids)
        self.size += len(ids)
        self.waiting += len(ids)
        if self.waiting >= BATCH_SEQUENCES * self.length:
            self.flush(last=False)

    def flush(self, last: bool) -> None:
        """Whole batches; at the end also the rest, padded to whole sequences."""
        ids = np.concatenate([np.zeros(0, self.dtype), *self.kept])
        step = BATCH_SEQUENCES * self.length
        whole = len(ids) // step * step
        for i in range(0, whole, step):
            self.write(ids[i : i + step], step)
        rest = ids[whole:]
        if last and len(rest):
            self.write(rest, -(-len(rest) // self.length) * self.length)
        self.kept, self.waiting = [rest], len(rest)

    def write(self, ids: np.ndarray, size: int) -> None:
        mask = np.arange(size) < len(ids)
        padded = np.zeros(size, dtype=self.dtype)
        padded[: len(ids)] = ids
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def close(self) -> None:
        self.flush(last=True)
        self.writer.close()
        self.out.close()


def write_token_files(
    documents: DataFrame, path: str, folder: str, length: int = SEQUENCE, file_tokens: int = FILE_TOKENS
) -> DataFrame:
    """Writes all documents in ascending order of ``doc_id``; returns the index, itself written."""
    schema = arrow_schema(INDEX)
    ordered = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = library_encoder(path)
        part, place, file = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                ids, bounds = cache.texts(texts)
                ids = np.insert(ids, bounds[1:], END_ID)
                sizes = np.diff(bounds) + 1
                before = np.cumsum(sizes) - sizes
                if file is None:
                    file = SequenceFile(folder, f"{part:06d}-{uuid.uuid4().hex}.arrow", cache.dtype, length)
                same = [np.full(len(texts), part), place + before, [file.name] * len(texts)]
                doc_ids = batch.column("doc_id").slice(texts.first, len(texts))
                yield batch_of(schema, [*same, doc_ids, file.size + before, sizes])
                file.add(ids)
                place += len(ids)
                if file.size >= file_tokens:
                    file.close()
                    file = None
        if file is not None:
            file.close()

    return written(ordered.mapInArrow(run, INDEX), "token-index")


def starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: ids of all documents before. The sums before each part have one row per part."""
    sums = {r["part"]: r["n"] for r in index.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    rows, before = [], 0
    for part in sorted(sums):
        rows.append((part, before))
        before += sums[part]
    parts = index.sparkSession.createDataFrame(rows, "part int, before long")
    return index.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("place"))


class SequenceReader:
    """Random access to the ids of one file; batches are views of the mapped file where the store allows it."""

    def __init__(self, folder: str, name: str) -> None:
        store, path = pa.fs.FileSystem.from_uri(folder)
        local = isinstance(store, pa.fs.LocalFileSystem)
        self.source = pa.memory_map(f"{path}/{name}") if local else store.open_input_file(f"{path}/{name}")
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.at, self.ids, self.mask = -1, None, None

    def load(self, i: int) -> None:
        if i != self.at:
            batch = self.reader.get_batch(i)
            self.ids = batch.column("ids").values.to_numpy()
            self.mask = batch.column("mask").values
            self.at = i

    def read(self, at: int, n: int) -> np.ndarray:
        """``n`` ids from place ``at``; a view if they lie in one batch."""
        step, found = BATCH_SEQUENCES * self.length, []
        while n:
            self.load(at // step)
            low = at % step
            some = self.ids[low : low + n]
            if len(some) == 0 or not pa.compute.all(self.mask.slice(low, len(some))).as_py():
                raise ValueError("the index points at padding")
            found.append(some)
            at, n = at + len(some), n - len(some)
        return found[0] if len(found) == 1 else np.concatenate([np.zeros(0, np.uint16), *found])

    def close(self) -> None:
        self.source.close()


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """Per document: place in the whole stream, number of ids and their checksum, all read back from the files."""
    schema = arrow_schema(CHECKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name = None, None
        for batch in batches:
            sums = []
            for file, at, n in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "n_tokens")), strict=True):
                if file != name:
                    if reader:
                        reader.close()
                    reader, name = SequenceReader(folder, file), file
                sums.append(zlib.crc32(reader.read(at, n).astype("<u4").tobytes()))
            yield batch_of(schema, [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), sums])

    columns = ["file", "doc_id", "at", "n_tokens", "start"]
    return starts(index).select(*columns).mapInArrow(run, CHECKS)


def token_file_checks(documents: DataFrame, path: str) -> DataFrame:
    """Writes the token files and reads all of them back."""
    folder = new_folder(documents.sparkSession, "token-files")
    return read_token_files(write_token_files(documents, path, folder), folder)
