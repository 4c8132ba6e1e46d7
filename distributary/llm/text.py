"""Words of whole texts as arrays: where they start and end, their document, and a 64-bit hash of each.

Texts stay one byte buffer per Arrow batch, so a word class is a table of 256 byte values. Every class used here
treats all bytes from 0x80 on as part of a word, hence UTF-8 sequences are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19  # of text at a time; arrays of its words, pieces and tokens take some hundred times as much
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

U64 = np.uint64


def spread_bits(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants that depend on ``seed`` alone."""
    steps = np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)
    return spread_bits(steps + U64(seed)) | U64(1)


def spaced_words() -> np.ndarray:
    """Class of ``[^\\x20\\x09-\\x0D]``."""
    table = np.ones(256, dtype=bool)
    table[list(SPACES)] = False
    return table


def plain_words() -> np.ndarray:
    """Class of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` (of text in lower case)."""
    table = np.zeros(256, dtype=bool)
    table[0x30:0x3A] = True
    table[0x61:0x7B] = True
    table[0x80:] = True
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


SPACED, PLAIN, LOWER = spaced_words(), plain_words(), lower_table()
LENGTHS = constants(1, 11)[0]
BLOCK = 8
BLOCKS = 8  # longer ranges are hashed one by one
KEPT = np.array([(1 << 8 * n) - 1 for n in range(BLOCK + 1)], dtype=U64)


@dataclass
class Texts:
    """Bytes of some texts, one after the other; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def lowered(self) -> Texts:
        return Texts(LOWER[self.data], self.offsets, self.first)


def texts_of(column: pa.Array | pa.ChunkedArray, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a column in chunks of bounded size (a longer text is a chunk of its own). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    rows = len(column)
    if rows == 0:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.zeros(0, np.uint8)
    if column.null_count:  # null slots may have bytes
        valid = np.asarray(column.is_valid())
        sizes = np.diff(offsets) * valid
        if sizes.sum() != offsets[-1] - offsets[0]:
            pieces = [data[offsets[i] : offsets[i + 1]] for i in np.flatnonzero(valid)]
            data = np.concatenate(pieces) if pieces else data[:0]
        else:
            data = data[offsets[0] : offsets[-1]]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + chunk_bytes, side="right")) - 1
        last = min(max(last, first + 1), rows)
        low = offsets[first]
        yield Texts(data[low : offsets[last]], offsets[first : last + 1] - low, first)
        first = last


@dataclass
class Words:
    """Words of a chunk in order: byte range, row within the chunk, and the first word of each row."""

    texts: Texts
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.counts())

    def hashes(self) -> np.ndarray:
        return range_hashes(self.texts.data, self.start, self.end)


def blocks_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes that start at each place of the data as one little-endian number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(BLOCK, np.uint8)])
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, mixed after every 8 bytes; ranges of up to 8 bytes and equal length never collide.

    Ranges of more than 64 bytes are hashed one by one (BLAKE2b).
    """
    length = end - start
    value = spread_bits(length.astype(U64) * LENGTHS)
    blocks = blocks_at(data)
    left = np.flatnonzero(length <= BLOCK * BLOCKS)
    at, rest = start[left], length[left]
    for _ in range(BLOCKS):
        more = rest > 0
        left, at, rest = left[more], at[more], rest[more]
        if not len(left):
            break
        value[left] = spread_bits((value[left] ^ (blocks[at] & KEPT[np.minimum(rest, BLOCK)])) + LENGTHS)
        at, rest = at + BLOCK, rest - BLOCK
    for i in np.flatnonzero(length > BLOCK * BLOCKS):
        digest = blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest()
        value[i] = int.from_bytes(digest, "little")
    return value


def same_ranges(data: np.ndarray, start: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ranges of equal ``length`` at ``start`` and at ``other`` hold the same bytes."""
    same = np.ones(len(start), dtype=bool)
    blocks = blocks_at(data)
    left = np.flatnonzero((start != other) & (length <= BLOCK * BLOCKS))
    done = 0
    while len(left := left[length[left] > done]):
        kept = KEPT[np.minimum(length[left] - done, BLOCK)]
        same[left] &= ((blocks[start[left] + done] ^ blocks[other[left] + done]) & kept) == 0
        done += BLOCK
    for i in np.flatnonzero((start != other) & (length > BLOCK * BLOCKS)):
        same[i] = np.array_equal(data[start[i] : start[i] + length[i]], data[other[i] : other[i] + length[i]])
    return same


def distinct_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One range of each content, and which of them each range equals; ranges are told apart by their bytes."""
    _, at, place = np.unique(range_hashes(data, start, end), return_index=True, return_inverse=True)
    length = end - start
    wrong = length != length[at][place]
    wrong[~wrong] = ~same_ranges(data, start[~wrong], start[at][place[~wrong]], length[~wrong])
    if wrong.any():  # equal hashes of different bytes
        seen: dict[bytes, int] = {}
        for i in np.flatnonzero(wrong).tolist():
            content = data[start[i] : end[i]].tobytes()
            if content not in seen:
                seen[content] = len(at)
                at = np.append(at, i)
            place[i] = seen[content]
    return at, place


def words_of(texts: Texts, table: np.ndarray) -> Words:
    inside = table[texts.data]
    n = len(inside)
    breaks = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[breaks] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[breaks - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(texts, start, end, np.searchsorted(start, texts.offsets))


def gram_hashes(hashes: np.ndarray, rows: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``size`` words within one row."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    factors = constants(size, 1000 * size + seed)
    value = hashes[:n] * factors[0]
    for j in range(1, size):
        value += hashes[j : j + n] * factors[j]
    whole = rows[:n] == rows[size - 1 :]
    at = np.flatnonzero(whole)
    return at, spread_bits(value[at])


def whole_hash(hashes: np.ndarray) -> int:
    """Hash of a sequence shorter than a window, never equal to that of another length by design."""
    n = len(hashes)
    with np.errstate(over="ignore"):
        return int(spread_bits((hashes * constants(n, 1000 * n)).sum(keepdims=True))[0])


def covered(at: np.ndarray, size: int | np.ndarray, n: int) -> np.ndarray:
    """Marks the ``n`` words that lie in a run starting at one of ``at``."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + size, -1)
    return np.cumsum(steps[:-1]) > 0


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive ``bounds``."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )
