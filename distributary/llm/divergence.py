"""Source divergence audit: how far the term frequencies of each source are from its language's and from other sources'.

Terms are counted in the tasks that read the texts. A term of up to 8 bytes is packed into one 64-bit number, one of up
to 16 into two; such buckets are sorted by a radix sort over 16-bit digits and counted in runs. Longer terms form
buckets of their own by length, sorted by their bytes. Counts are merged in the task while they stay below
``HELD_TERMS``, then combined by Spark.

Each language keeps the terms that at least ``LEAST_DOCUMENTS`` of its rows have. A group (language and source) has, for
each kept term, p = 1 + floor(SCALE * (count + 2) / (N + 2 V)); so has the language as a whole. The divergence of a term
is floor((p - q)^2 / (p + q)). All arithmetic is exact: counts become decimals, p and f fit 64 bits.

Divergences of two groups are sums over all kept terms, also those that neither has. Only counted terms travel: they
are dealt to blocks of terms by hash, ``BLOCK_TERMS`` to a block, and to pairs of tiles of ``TILE`` sources; a block
compares its sources as a dense matrix and gives what its terms add beyond those without any count, which is the same
for all terms and enters as V times that. A term block of a language thus never holds more than 2 * ``TILE`` times about
``BLOCK_TERMS`` numbers, whatever share of the rows a source has; with more than ``TILE`` sources a count is sent once
per tile, as the result has a row for every pair of sources. The pairs are symmetric and computed once.

Null text, language and source are ''. Texts of any length are counted whole; every row counts, repeated ones too. Texts
without terms add a group without counts. A language without kept terms has divergence 0 in all its pairs; a source alone
in its language has no pairs. Ties in rank go by the item's bytes. Other columns are not looked at. An empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from distributary.llm.shared import arrow_schema, written
from distributary.llm.text import KEPT, U64, Texts, Words, batch_of, blocks_at, texts_of, words_of

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP = 10
HELD_TERMS = 600_000
BLOCK_TERMS = 4096
TILE = 256
BROADCAST_GROUPS = 100_000
SALTS = 32

COUNTS = "lang string, source string, term string, n long, n_docs long"
PARTS = "lang string, one long, two long, added long"
RESULT = ["lang", "source", "part", "item", "value", "rank"]


def letters() -> np.ndarray:
    """Class of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]`` (of text in lower case)."""
    table = np.zeros(256, dtype=bool)
    table[0x61:0x7B] = True
    table[0x80:] = True
    return table


LETTERS = letters()


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Stable order by several columns of unsigned numbers, the first the most significant: a radix sort by 16 bits.

    Digits that are equal in all rows are passed over.
    """
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in range(0, 8 * key.itemsize, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]  # numpy sorts 16-bit numbers by radix
    return order


def run_starts(keys: list[np.ndarray]) -> np.ndarray:
    """First rows of runs of equal keys."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def packed(words: Words, chosen: np.ndarray, numbers: int) -> list[np.ndarray]:
    """The bytes of the chosen words, big-endian, as ``numbers`` columns of 64 bits; zeros follow short words."""
    blocks = blocks_at(words.texts.data)
    last = len(words.texts.data)
    columns = []
    for i in range(numbers):
        start = words.start[chosen] + 8 * i
        left = np.clip(words.end[chosen] - start, 0, 8)
        columns.append((blocks[np.minimum(start, last)] & KEPT[left]).byteswap())
    return columns


def unpacked(columns: list[np.ndarray]) -> pa.Array:
    """The words of packed columns as strings."""
    width = 8 * len(columns)
    raw = np.stack([c.byteswap() for c in columns], axis=1).view(np.uint8).reshape(-1, width)
    sizes = np.count_nonzero(raw, axis=1)
    data = raw[np.arange(width) < sizes[:, None]]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data.tobytes()))


def byte_sorted(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Number of the term of each chosen word, all of one length, and the terms in the order of their bytes."""
    length = int(words.end[chosen[0]] - words.start[chosen[0]])
    raw = words.texts.data
    rows = np.stack([raw[s : s + length] for s in words.start[chosen].tolist()])
    terms, number = np.unique(rows.view(f"V{length}").ravel(), return_inverse=True)
    return number.astype(U64), [bytes(t) for t in terms]


class Counts:
    """Counts of terms by group: sorted columns of packed terms by their number of words, and a table of long ones."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.short: dict[int, list[list[np.ndarray]]] = {1: [], 2: []}
        self.long: dict[tuple[int, bytes], list[int]] = {}
        self.size = 0

    def group_numbers(self, langs: list[str], sources: list[str]) -> np.ndarray:
        numbers = [self.groups.setdefault(pair, len(self.groups)) for pair in zip(langs, sources, strict=True)]
        return np.array(numbers, dtype=np.uint32)

    def add(self, texts: Texts, groups: np.ndarray) -> None:
        words = words_of(texts.lowered(), LETTERS)
        rows, length = words.rows(), words.end - words.start
        for numbers, chosen in ((1, np.flatnonzero(length <= 8)), (2, np.flatnonzero((length > 8) & (length <= 16)))):
            if len(chosen):
                self.short[numbers].append(counted(groups[rows[chosen]], packed(words, chosen, numbers), rows[chosen]))
        longer = np.flatnonzero(length > 16)
        longer = longer[np.argsort(length[longer], kind="stable")]
        for chosen in np.split(longer, np.flatnonzero(np.diff(length[longer])) + 1) if len(longer) else []:
            number, terms = byte_sorted(words, chosen)
            group, term, n, docs = counted(groups[rows[chosen]], [number], rows[chosen])
            for g, t, a, b in zip(group.tolist(), term.tolist(), n.tolist(), docs.tolist(), strict=True):
                both = self.long.setdefault((g, terms[t]), [0, 0])
                both[0] += a
                both[1] += b
        self.size = len(self.long) + sum(len(part[0]) for parts in self.short.values() for part in parts)

    def merge(self) -> None:
        """One sorted part for each number of words."""
        for numbers, parts in self.short.items():
            if len(parts) > 1:
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                keys = columns[:-2]
                order = radix_order(keys)
                columns = [c[order] for c in columns]
                first = run_starts(columns[:-2])
                sums = [np.add.reduceat(c, first) for c in columns[-2:]]
                self.short[numbers] = [[*(c[first] for c in columns[:-2]), *sums]]
        self.size = len(self.long) + sum(len(part[0]) for parts in self.short.values() for part in parts)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """All counts as rows; nothing is held afterwards."""
        self.merge()
        schema, names = arrow_schema(COUNTS), list(self.groups)
        langs, sources = (pa.array([x[i] for x in names], pa.string()) for i in (0, 1))
        for parts in self.short.values():
            for group, *term, n, docs in parts:
                for low in range(0, len(group), 100_000):
                    cut = slice(low, low + 100_000)
                    at = pa.array(group[cut])
                    yield batch_of(schema, [langs.take(at), sources.take(at), unpacked([t[cut] for t in term]), n[cut], docs[cut]])
        if self.long:
            rows = [(*names[g], term.decode(), n, docs) for (g, term), (n, docs) in self.long.items()]
            yield batch_of(schema, list(zip(*rows, strict=True)))
        self.__init__()


def counted(groups: np.ndarray, term: list[np.ndarray], rows: np.ndarray) -> list[np.ndarray]:
    """Group, packed term, occurrences and rows with it, sorted; ``rows`` is in ascending order."""
    order = radix_order([groups, *term])
    keys = [k[order] for k in (groups, *term)]
    rows = rows[order]
    first = run_starts(keys)
    new_row = np.ones(len(rows), dtype=np.int64)
    new_row[1:] = rows[1:] != rows[:-1]
    new_row[first] = 1
    n = np.diff(np.append(first, len(rows)))
    return [*(k[first] for k in keys), n, np.add.reduceat(new_row, first)]


def group_columns(documents: DataFrame) -> DataFrame:
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    return documents.select(text("lang"), text("source"), text("text"))


def term_counts(documents: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences and ``n_docs`` rows with the term, a row for each that occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for batch in batches:
            langs, sources = (batch.column(name).to_pylist() for name in ("lang", "source"))
            for texts in texts_of(batch.column("text")):
                rows = slice(texts.first, texts.first + len(texts))
                counts.add(texts, counts.group_numbers(langs[rows], sources[rows]))
                if counts.size > HELD_TERMS:
                    counts.merge()
                    if counts.size > HELD_TERMS // 2:
                        yield from counts.batches()
        yield from counts.batches()

    parts = group_columns(documents).mapInArrow(run, COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def chance(count: str, total: str, kept: str) -> F.Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 kept)), of whole numbers beyond 64 bits."""
    number = lambda name: f"cast({name} as decimal(19, 0))"
    scaled = f"({number(count)} + 2) * cast({SCALE} as decimal(10, 0))"
    return F.expr(f"1 + ({scaled}) div ({number(total)} + 2 * {number(kept)})")


def apart(p: str, q: str) -> F.Column:
    """floor((p - q)^2 / (p + q)) of columns."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def with_group(frame: DataFrame, groups: DataFrame, n_groups: int, columns: list[str]) -> DataFrame:
    """Adds columns of the groups by language and source. Many groups are joined by salted keys: one may have a third of all rows."""
    groups = groups.select("lang", "source", *columns)
    if n_groups <= BROADCAST_GROUPS:
        return frame.join(F.broadcast(groups), ["lang", "source"])
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    frame = frame.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    return frame.join(salted, ["lang", "source", "salt"]).drop("salt")


def divergence(p: np.ndarray | int, q: np.ndarray | int) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of 64-bit integers up to SCALE + 1."""
    return (p - q) ** 2 // (p + q)


def block_pairs(table: pa.Table) -> pa.Table:
    """What a block of terms adds to each pair of sources of two tiles, beyond terms without counts."""
    lang = table.column("lang")[0].as_py()
    tile, other = (table.column(name)[0].as_py() for name in ("tile", "other"))
    known = table.column("term").combine_chunks().dictionary_encode()
    real, n_terms = np.asarray(known.is_valid()), len(known.dictionary)
    term = known.indices.drop_null().to_numpy()
    number, least, p = (table.column(name).to_numpy() for name in ("number", "least", "p"))
    sources, first, place = np.unique(number, return_index=True, return_inverse=True)
    base = least[first]
    matrix = np.repeat(base[:, None], n_terms, axis=1)
    matrix[place[real], term] = p[real]
    ones, twos, added = [], [], []
    for i in np.flatnonzero(sources // TILE == tile):
        others = np.flatnonzero((sources // TILE == other) & (sources > sources[i]))
        sums = divergence(matrix[others], matrix[i]).sum(axis=1) - divergence(base[others], base[i]) * n_terms
        ones.append(np.full(len(others), sources[i]))
        twos.append(sources[others])
        added.append(sums)
    columns = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (ones, twos, added)]
    return pa.Table.from_batches([batch_of(arrow_schema(PARTS), [[lang] * len(columns[0]), *columns])])


def pair_values(cells: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """``lang``, ``source``, ``item`` and ``value`` of all ordered pairs of sources of a language.

    A source without any term of a block has no count there, yet differs from those that have: it sends a row without
    a term to every block of its language.
    """
    block_count = F.greatest(F.lit(1), F.ceil(F.col("kept") / BLOCK_TERMS)).cast("long")
    own = with_group(cells.drop("kept"), groups, n_groups, ["kept", "number", "least", "tiles"])
    own = own.withColumn("block", F.pmod(F.xxhash64("lang", "term"), block_count))
    present = groups.filter("kept > 0").withColumns({"term": F.lit(None).cast("string"), "p": F.col("least")})
    present = present.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), block_count - 1)))
    sent = ["lang", "block", "term", "number", "least", "p", "tiles"]
    both = own.select(*sent).unionByName(present.select(*sent))
    both = both.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    tile = F.floor(F.col("number") / TILE)
    both = both.withColumns({"tile": F.least(tile, "at"), "other": F.greatest(tile, "at")}).drop("tiles", "at")
    parts = both.groupBy("lang", "block", "tile", "other").applyInArrow(block_pairs, PARTS)
    added = parts.groupBy("lang", "one", "two").agg(F.sum("added").alias("added"))
    one = groups.select("lang", "kept", F.col("number").alias("one"), "source", F.col("least").alias("p"))
    two = groups.select("lang", F.col("number").alias("two"), F.col("source").alias("item"), F.col("least").alias("q"))
    two = F.broadcast(two) if n_groups <= BROADCAST_GROUPS else two
    pairs = one.join(two, "lang").filter("one < two").join(added, ["lang", "one", "two"], "left")
    value = F.col("kept") * apart("p", "q") + F.coalesce("added", F.lit(0))
    value = F.when(F.col("kept") == 0, F.lit(0)).otherwise(value).cast("long")
    ways = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    pairs = pairs.select("lang", F.explode(ways).alias("way"), value.alias("value"))
    return pairs.select("lang", "way.source", "way.item", "value")


def audit(documents: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """Ranked divergences of every group: from each other source of its language, and by its most frequent terms."""
    counts = written(term_counts(documents), "term-counts")
    by_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("docs"))
    kept = written(by_lang.filter(F.col("docs") >= least_documents).select("lang", "term", "lang_n"), "kept-terms")
    totals = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    occurring = written(counts.join(kept, ["lang", "term"]), "kept-counts")
    every = group_columns(documents).select("lang", "source").distinct()
    groups = every.join(occurring.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    groups = groups.join(totals, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    groups = groups.withColumns({"number": number, "nothing": F.lit(0).cast("long")})
    tiles = (F.floor(F.max("number").over(Window.partitionBy("lang")) / TILE) + 1).cast("long")
    groups = groups.withColumns({"tiles": tiles, "least": F.when(F.col("kept") > 0, chance("nothing", "total", "kept"))})
    groups = written(groups, "groups")
    n_groups = groups.count()
    cells = with_group(occurring, groups, n_groups, ["total", "kept", "lang_total"])
    cells = cells.withColumns({"p": chance("n", "total", "kept"), "q": chance("lang_n", "lang_total", "kept")})

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(by_value)
    pairs = pair_values(cells, groups, n_groups).withColumns({"rank": rank, "part": F.lit("pair")})
    terms = cells.filter("p > q").select("lang", "source", F.col("term").alias("item"), apart("p", "q").alias("value"))
    terms = terms.withColumn("rank", rank).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pairs.select(*RESULT).unionByName(terms.select(*RESULT))
