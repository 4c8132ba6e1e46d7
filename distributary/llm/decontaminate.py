"""Benchmark decontamination by winnowing.

From every run of ``WINNOW`` consecutive word k-grams the one with the smallest hash (the rightmost of equals) is kept
as a fingerprint. Any shared span of ``WINDOW = GRAM + WINNOW - 1`` words holds such a run, from which both sides keep
the same fingerprint, so no shared window escapes. Fingerprints of documents are joined with those of the benchmark;
each hit is extended word by word to both sides, and counts where a whole benchmark window stands in the document.

Items with fewer words than a window are one window; they take part with their whole length as a single fingerprint.

If the benchmark's fingerprints and words are few (``BROADCAST_BYTES``), every task gets them and documents are read
once, in place. Otherwise fingerprints are joined by a shuffle and hits meet their texts in a second join. Both ways
give the same rows.

Words are compared by 64-bit hashes. Null and empty texts have no words; any length is taken whole. Rows of equal
``doc_id`` are judged each for itself; benchmark rows of equal ``item_id`` count as one item; items without id or
words are left out. Documents without id are judged too. An empty table of documents gives an empty result, an empty
benchmark finds nothing. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from distributary.llm.shared import BROADCAST_BYTES, arrow_schema, written
from distributary.llm.text import PLAIN, U64, batch_of, covered, gram_hashes, spread_bits, texts_of, words_of

WINDOW = 10
GRAM = 6
WINNOW = WINDOW - GRAM + 1

PRINTS = "print long, key string, at int"
ADDED = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def winnowed(value: np.ndarray, at: np.ndarray, rows: np.ndarray, run: int) -> np.ndarray:
    """Places (in ``at``) of the grams kept by winnowing within each row."""
    n = len(value) - run + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(run - 1, run - 1 + n)  # rightmost first, so that only a smaller hash replaces it
    least = value[best].copy()
    for j in range(run - 2, -1, -1):
        other = value[j : j + n]
        less = other < least
        least[less] = other[less]
        best[less] = np.arange(j, j + n)[less]
    whole = rows[at[:n]] == rows[at[run - 1 :]]
    return np.unique(best[whole])


def fingerprints(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the winnowed grams of full windows."""
    at, value = gram_hashes(hashes, rows, GRAM)
    chosen = winnowed(value, at, rows, WINNOW)
    return at[chosen], value[chosen]


def short_prints(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Every run of ``size`` words, for items that have just as many; marked apart by their size."""
    at, value = gram_hashes(hashes, rows, size, seed=7)
    return at, spread_bits(value + U64(size))


class Benchmark:
    """Items as word hashes, and their fingerprints in order, for tasks that hold all of it."""

    def __init__(self, items: list[tuple[str, np.ndarray]]) -> None:
        self.names = [name for name, _ in items]
        self.words = [words for _, words in items]
        self.short = sorted({len(w) for w in self.words if len(w) < WINDOW})
        prints, owner, place = [], [], []
        for i, words in enumerate(self.words):
            row = np.zeros(len(words), dtype=np.int64)
            at, value = fingerprints(words, row) if len(words) >= WINDOW else short_prints(words, row, len(words))
            prints.append(value)
            owner.append(np.full(len(at), i))
            place.append(at)
        value = np.concatenate([np.zeros(0, U64), *prints])
        order = np.argsort(value, kind="stable")
        self.prints = value[order]
        self.owner = np.concatenate([np.zeros(0, np.int64), *owner])[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *place])[order]

    def hits(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word, item and place in the item of every fingerprint of the words that the benchmark has too."""
        found = [fingerprints(hashes, rows), *(short_prints(hashes, rows, n) for n in self.short)]
        at = np.concatenate([f[0] for f in found])
        value = np.concatenate([f[1] for f in found])
        low = np.searchsorted(self.prints, value, side="left")
        n = np.searchsorted(self.prints, value, side="right") - low
        listed = n > 0
        at, low, n = at[listed], low[listed], n[listed]
        place = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else low, n) + np.arange(n.sum())
        return np.repeat(at, n), self.owner[place], self.place[place]


def extended(doc: np.ndarray, item: np.ndarray, at: int, place: int) -> list[int]:
    """Starts of the item's windows that stand in the document around a hit: equal words to both sides."""
    size = min(WINDOW, len(item))
    gram = GRAM if len(item) >= WINDOW else size
    back = min(at, place, size - gram)
    ahead = min(len(doc) - at, len(item) - place, size)
    same = doc[at - back : at + ahead] == item[place - back : place + ahead]
    if not same[back : back + gram].all():
        return []
    wrong = np.flatnonzero(~same)
    low = int(wrong[wrong < back].max(initial=-1)) + 1
    high = int(wrong[wrong >= back].min(initial=len(same)))
    return [at - back + i for i in range(low, high - size + 1)]


def judged(doc: np.ndarray, hits: list[tuple[int, str, np.ndarray, int]]) -> tuple[int, int, str, np.ndarray]:
    """Hit words, items found, digest of their ids, and the marks of the words; each hit is (word, id, item, place)."""
    starts, sizes, names = [], [], set()
    for at, name, item, place in hits:
        windows = extended(doc, item, at, place)
        if windows:
            names.add(name)
            starts += windows
            sizes += [min(WINDOW, len(item))] * len(windows)
    marked = covered(np.array(starts, np.int64), np.array(sizes, np.int64), len(doc))
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return int(marked.sum()), len(names), digest, marked


def items_of(benchmark: DataFrame) -> DataFrame:
    """``item`` (its id as text) and ``words`` (64-bit hashes) of every row with words."""
    schema = "item string, words binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, packed = [], []
            for texts in texts_of(batch.column("text")):
                words = words_of(texts.lowered(), PLAIN)
                hashes = words.hashes()
                for i in np.flatnonzero(words.counts()):
                    names.append(batch.column("item")[texts.first + int(i)].as_py())
                    packed.append(hashes[words.bounds[i] : words.bounds[i + 1]].tobytes())
            yield batch_of(arrow_schema(schema), [names, packed])

    named = benchmark.filter("item_id is not null").select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string"))
    return named.mapInArrow(run, schema)


def with_added(documents: DataFrame) -> StructType:
    kinds = [field.split() for field in ADDED.split(",")]
    return documents.withColumns({name: F.lit(None).cast(kind) for name, kind in kinds}).schema


def with_results(rows: pa.RecordBatch, n_words: np.ndarray, results: list[tuple[int, int, str]]) -> pa.RecordBatch:
    hit, n, digest = zip(*results, strict=True)
    schema = arrow_schema(ADDED)
    added = batch_of(schema, [n_words, hit, n, digest, np.array(hit) > 0])
    return pa.RecordBatch.from_arrays([*rows.columns, *added.columns], names=[*rows.schema.names, *schema.names])


def narrow(documents: DataFrame, benchmark: Benchmark) -> DataFrame:
    """Documents judged in place by a benchmark of bounded size."""
    held = documents.sparkSession.sparkContext.broadcast(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        nothing = judged(np.zeros(0, U64), [])
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                words = words_of(texts.lowered(), PLAIN)
                hashes, rows = words.hashes(), words.rows()
                at, owner, place = items.hits(hashes, rows)
                counts = words.counts()
                results = [nothing[:3]] * len(texts)
                order = np.argsort(rows[at], kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(rows[at][order])) + 1) if len(order) else []:
                    i = int(rows[at[part[0]]])
                    low, high = words.bounds[i], words.bounds[i + 1]
                    hits = [(int(at[j] - low), items.names[owner[j]], items.words[owner[j]], int(place[j])) for j in part]
                    results[i] = judged(hashes[low:high], hits)[:3]
                yield with_results(batch.slice(texts.first, len(texts)), counts, results)

    return documents.mapInArrow(run, with_added(documents))


def prints_of(frame: DataFrame, short: list[int]) -> DataFrame:
    """Fingerprints of the texts as rows; ``key`` names the text. Of short sizes only those in ``short``."""
    schema = arrow_schema(PRINTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                words = words_of(texts.lowered(), PLAIN)
                hashes, rows = words.hashes(), words.rows()
                found = [fingerprints(hashes, rows), *(short_prints(hashes, rows, n) for n in short)]
                at = np.concatenate([f[0] for f in found])
                value = np.concatenate([f[1] for f in found])
                names = batch.column("key").slice(texts.first, len(texts)).take(pa.array(rows[at]))
                yield batch_of(schema, [value.view(np.int64), names, at - words.bounds[rows[at]]])

    return frame.select("key", "text").mapInArrow(run, PRINTS)


def item_prints(items: DataFrame) -> DataFrame:
    schema = arrow_schema(PRINTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [np.frombuffer(w, dtype=U64) for w in batch.column("words").to_pylist()]
            known = Benchmark(list(zip(batch.column("key").to_pylist(), words, strict=True)))
            names = [known.names[i] for i in known.owner]
            yield batch_of(schema, [known.prints.view(np.int64), names, known.place])

    return items.mapInArrow(run, PRINTS)


def shuffled(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The same by joins, for benchmarks of any size: fingerprints first, then the texts of documents with hits."""
    keyed = documents.withColumn("bench_key", F.concat_ws(":", "doc_id", F.xxhash64("doc_id", "text").cast("string")))
    items = items.withColumn("key", F.concat_ws(":", "item", F.hex(F.xxhash64("words"))))
    sizes = items.select((F.length("words") / 8).cast("int").alias("n")).filter(F.col("n") < WINDOW).distinct()
    short = sorted(r["n"] for r in sizes.collect())  # fewer than a window has words
    texts = prints_of(keyed.select(F.col("bench_key").alias("key"), "text").dropDuplicates(["key"]), short)
    known = item_prints(items.dropDuplicates(["key"])).select("print", F.col("key").alias("item_key"), F.col("at").alias("place"))
    hits = texts.join(known, "print")
    contents = items.dropDuplicates(["key"]).select(F.col("key").alias("item_key"), "item", "words")
    hits = hits.join(contents, "item_key").groupBy(F.col("key").alias("bench_key")).agg(
        F.collect_list(F.struct("at", "item", "words", "place")).alias("bench_hits")
    )
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = batch.select(names)
            for texts in texts_of(batch.column("text")):
                words = words_of(texts.lowered(), PLAIN)
                hashes, results = words.hashes(), []
                for i in range(len(texts)):
                    rows = batch.column("bench_hits")[texts.first + i].as_py() or []
                    found = [(h["at"], h["item"], np.frombuffer(h["words"], dtype=U64), h["place"]) for h in rows]
                    results.append(judged(hashes[words.bounds[i] : words.bounds[i + 1]], found)[:3])
                yield with_results(plain.slice(texts.first, len(texts)), words.counts(), results)

    joined = keyed.join(hits, "bench_key", "left").select(*documents.columns, "bench_hits")
    return joined.mapInArrow(run, with_added(documents))


def judge(documents: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All rows with their words, words under benchmark windows, items found, digest of the sorted ids, and verdict."""
    added = [field.split()[0] for field in ADDED.split(",")]
    documents = documents.drop(*added, "bench_key", "bench_hits").withColumn("text", F.col("text").cast("string"))
    items = written(items_of(benchmark), "benchmark-items")
    # A word takes 8 bytes here, and on the task at most a fingerprint of 24 more.
    size = items.agg(F.sum(F.length("words") * 4 + F.length("item") + 64)).first()[0] or 0
    if size > broadcast_bytes:
        return shuffled(documents, items)
    rows = items.collect()
    return narrow(documents, Benchmark([(r["item"], np.frombuffer(r["words"], dtype=U64)) for r in rows]))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The judgement of every document by ``doc_id``."""
    names = [field.split()[0] for field in ADDED.split(",")]
    return judge(documents.select(F.col("doc_id").cast("long"), "text"), benchmark).select("doc_id", *names)


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that hold no benchmark window, as they are."""
    return judge(documents, benchmark).filter(~F.col("contaminated")).select(*documents.columns)
