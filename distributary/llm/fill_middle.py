"""Fill-in-middle: texts are cut into prefix, middle and suffix at unit borders and put together in another order.

Units are lines here (a line end belongs to its line). The two cuts of a text are numbers of units. Where they are is
found in an index over the text's fixed blocks of ``BLOCK`` bytes: two Fenwick trees hold the units and the code points
that end, or begin, in the blocks. Binary lifting goes down the tree of units to the block that holds the cut and, with
it, sums the code points before that block; the border is then sought inside that one block. All trees of a batch are
built and gone down together by array operations; building costs one pass over the bytes.

Cuts, rates and forms are drawn from the SHA-256 of a seed and the row's id, hence a row has the same result in every run
and in every partition. Forms: ``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` is <S>suffix<P>prefix<M>middle, ``plain``
the text as it is: empty texts, those that hold a sentinel already, and those that the rate leaves out.

A null text is an empty text; texts of any length are cut whole. A null id is drawn as an empty one. Rows of equal id
have the same draws, whatever their texts; repeated rows are each transformed. Columns named like an added one are
replaced, all others are kept. An empty table gives an empty table. One narrow pass, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distributary.llm.shared import arrow_schema
from distributary.llm.text import Texts, batch_of, texts_of

BLOCK = 1024
SEED = 7
SENTINELS = ("<P>", "<S>", "<M>")
ADDED = "n long, form string, prefix_chars long, middle_chars long, output string"
DRAWN = ("fim_first", "fim_second", "fim_rate", "fim_order")


@dataclass
class BlockTrees:
    """Fenwick trees over the blocks of each text of a chunk; entry ``roots[t] + i - 1`` is node ``i`` of text ``t``."""

    texts: Texts
    starts: np.ndarray
    roots: np.ndarray
    sizes: np.ndarray
    units: np.ndarray
    points: np.ndarray

    @classmethod
    def over(cls, texts: Texts, block: int = BLOCK) -> BlockTrees:
        data, offsets = texts.data, texts.offsets
        sizes = -(-np.diff(offsets) // block)
        roots = np.cumsum(sizes) - sizes
        local = np.arange(sizes.sum()) - np.repeat(roots, sizes)
        starts = np.repeat(offsets[:-1], sizes) + local * block
        trees = [tree_of(block_sums(marks, starts), local) for marks in (data == 0x0A, (data & 0xC0) != 0x80)]
        return cls(texts, starts, roots, sizes, *trees)

    def totals(self, tree: np.ndarray) -> np.ndarray:
        """Sum over all blocks of each text: a walk up from the last node."""
        found = np.zeros(len(self.sizes), dtype=np.int64)
        node = self.sizes.copy()
        while (going := node > 0).any():
            found[going] += tree[self.roots[going] + node[going] - 1]
            node &= node - 1
        return found

    def line_counts(self) -> np.ndarray:
        """Units of each text: line ends, and one more if text follows the last."""
        ends = self.texts.offsets[1:]
        open_end = np.diff(self.texts.offsets) > 0
        open_end[open_end] = self.texts.data[ends[open_end] - 1] != 0x0A
        return self.totals(self.units) + open_end

    def cut(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte and code point at which the first ``units`` of each text end."""
        n = len(units)
        node, unit_sum, point_sum = (np.zeros(n, dtype=np.int64) for _ in range(3))
        step = 1 << int(self.sizes.max(initial=1)).bit_length()
        while step:
            further = node + step
            rows = np.flatnonzero(further <= self.sizes)
            at = self.roots[rows] + further[rows] - 1
            below = unit_sum[rows] + self.units[at] < units[rows]
            rows, at = rows[below], at[below]
            node[rows] = further[rows]
            unit_sum[rows] += self.units[at]
            point_sum[rows] += self.points[at]
            step >>= 1
        bytes_at, points_at = self.texts.offsets[:-1].copy(), np.zeros(n, dtype=np.int64)
        for t in np.flatnonzero(units > 0).tolist():
            if node[t] == self.sizes[t]:  # fewer line ends than units: the last unit ends with the text
                bytes_at[t], points_at[t] = self.texts.offsets[t + 1], point_sum[t]
                continue
            low = self.starts[self.roots[t] + node[t]]
            high = min(low + BLOCK, self.texts.offsets[t + 1])
            ends = np.flatnonzero(self.texts.data[low:high] == 0x0A)
            bytes_at[t] = low + ends[units[t] - unit_sum[t] - 1] + 1
            points_at[t] = point_sum[t] + np.count_nonzero((self.texts.data[low : bytes_at[t]] & 0xC0) != 0x80)
        return bytes_at, points_at


def block_sums(marks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(marks, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)


def tree_of(sums: np.ndarray, local: np.ndarray) -> np.ndarray:
    """Node ``i`` of a text holds the sum of its last ``i & -i`` blocks up to block ``i``."""
    before = np.concatenate([[0], np.cumsum(sums)])
    node = local + 1
    at = np.arange(len(sums)) + 1
    return before[at] - before[at - (node & -node)]


def hex_group(digest: Column, i: int) -> Column:
    return F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")


def holds_any(texts: Texts, sentinels: tuple[str, ...]) -> np.ndarray:
    raw = texts.data.tobytes()
    found = np.zeros(len(texts), dtype=bool)
    for mark in (s.encode() for s in sentinels):
        at = raw.find(mark)
        while at >= 0:
            t = int(np.searchsorted(texts.offsets, at, side="right")) - 1
            end = int(texts.offsets[t + 1])
            if at + len(mark) <= end:
                found[t] = True
                at = raw.find(mark, end)
            else:  # across the border of two texts
                at = raw.find(mark, at + 1)
    return found


def transform(
    frame: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    seed: int = SEED,
    rate: int = 100,
    spm: int = 50,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """Adds ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``; ``rate`` and ``spm`` are percentages."""
    added = [field.split()[0] for field in ADDED.split(",")]
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    drawn = frame.drop(*added, *DRAWN, "fim_digest").withColumn("fim_digest", digest)
    kept = drawn.columns[:-1]
    drawn = drawn.select(*kept, *(hex_group(F.col("fim_digest"), i).alias(name) for i, name in enumerate(DRAWN)))
    schema = drawn.drop(*DRAWN)
    for field in ADDED.split(","):
        name, kind = field.split()
        schema = schema.withColumn(name, F.lit(None).cast(kind))
    prefix_mark, suffix_mark, middle_mark = (s.encode() for s in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text)
            draws = [batch.column(name).to_numpy() for name in DRAWN]
            for texts in texts_of(column.cast(pa.string()) if not pa.types.is_string(column.type) else column):
                first, second, chance, order = (d[texts.first : texts.first + len(texts)] for d in draws)
                trees = BlockTrees.over(texts)
                n = trees.line_counts()
                cuts = np.sort([first % (n + 1), second % (n + 1)], axis=0)
                (low, low_points), (high, high_points) = trees.cut(cuts[0]), trees.cut(cuts[1])
                plain = (np.diff(texts.offsets) == 0) | holds_any(texts, sentinels) | (chance % 100 >= rate)
                reverse = order % 100 < spm
                raw, output = texts.data.tobytes(), []
                places = zip(*(x.tolist() for x in (texts.offsets[:-1], low, high, texts.offsets[1:], plain, reverse)), strict=True)
                for start, i, j, end, as_is, suffix_first in places:
                    if as_is:
                        output.append(raw[start:end])
                    elif suffix_first:
                        output.append(b"".join([suffix_mark, raw[j:end], prefix_mark, raw[start:i], middle_mark, raw[i:j]]))
                    else:
                        output.append(b"".join([prefix_mark, raw[start:i], suffix_mark, raw[j:end], middle_mark, raw[i:j]]))
                form = np.where(plain, "plain", np.where(reverse, "spm", "psm"))
                lengths = [pa.array(x, mask=plain) for x in (low_points, high_points - low_points)]
                values = batch_of(arrow_schema(ADDED), [n, form, *lengths, pa.array(output, pa.binary()).cast(pa.string())])
                rows = batch.slice(texts.first, len(texts)).select(kept)
                yield pa.RecordBatch.from_arrays([*rows.columns, *values.columns], names=[*kept, *added])

    return drawn.mapInArrow(run, schema.schema)


def restored(form: Column, output: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text again, exactly, from its form and output: no part holds a sentinel, so the output falls into its parts."""
    mark = "|".join("".join(c if c.isalnum() else f"\\{c}" for c in s) for s in sentinels)
    parts = F.split(output, mark)
    part = lambda i: F.element_at(parts, i)
    psm, spm = (F.concat(part(a), part(4), part(b)) for a, b in ((2, 3), (3, 2)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(documents: DataFrame) -> DataFrame:
    """Per document: units, form, lengths, and digests of the output and of the text restored from it."""
    made = transform(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    back = restored(F.col("form"), F.col("output"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )
