"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates.

Words are runs of letters and digits, and runs of other visible characters (so that marks and symbols are words too), in
lower case; runs of capitals alone are words apart. N-grams of one and two words are hashed to ``BUCKETS`` weights, and so
is the pair of a word with itself, whatever the word. A feature counts 1 + log2 of its occurrences, and a text's features are scaled to length 1. A
score is the sigmoid of a sparse dot product; texts without words score the sigmoid of the bias.

Training is FTRL-Proximal: each feature has its own learning rate and its weight stays 0 until the evidence exceeds
``L1``. All labelled rows train. They are dealt by hash to shards of about ``SHARD_ROWS`` rows and at most about
``SHARD_BYTES`` of text; every shard is trained by one task, ``PASSES`` times over its rows in the order of a hash, and
the weights of the shards are averaged, weighted by rows (parameter mixing). Features are shuffled once and never
written. The driver holds ``BUCKETS`` weights, a task those and its shard, whatever the size of the input.

Labels are used only of rows whose crc32 of ``doc_id`` modulo ``FOLDS`` is not ``HELD_OUT``. Several labels of one
document count as 0 if any is 0; null labels and ids are ignored. Only texts and labels are looked at. Without labels of
both classes every score is the share of labels that are 1 (0 if there are none). Null texts are empty. Rows of one id
are trained and scored each for itself, repeated rows too. Rows without id are scored and not held out. Texts of any
length are taken whole. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distributary.llm.shared import BROADCAST_BYTES, arrow_schema, written
from distributary.llm.text import U64, Texts, batch_of, constants, range_hashes, spread_bits, texts_of

FOLDS, HELD_OUT = 4, 2
LEAST_SCORE = 0.7
BUCKETS = 1 << 18
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.3, 0.05
PASSES = 4
SHARD_ROWS = 20_000
SHARD_BYTES = 64 << 20

SPACE, LETTER, MARK = 0, 1, 2
PAIR = constants(1, 301)[0]
CAPITALS = constants(1, 302)[0]
AGAIN = constants(1, 303)[0]

EXAMPLES = "label int, features binary, weights binary"


def kinds_of_bytes() -> np.ndarray:
    """White space and controls, letters and digits (all beyond ASCII too), other visible characters."""
    table = np.full(256, MARK, dtype=np.uint8)
    table[:0x21] = SPACE
    table[0x7F] = SPACE
    for low, high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        table[low:high] = LETTER
    return table


KINDS = kinds_of_bytes()
UPPER = np.isin(np.arange(256), np.arange(0x41, 0x5B))
LOWER = np.isin(np.arange(256), np.arange(0x61, 0x7B))


def held_out(doc_id: Column) -> Column:
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


@dataclass
class Features:
    """Sparse vectors of the texts of a chunk: ``buckets`` and ``weights`` between consecutive ``bounds``."""

    buckets: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.bounds[i], self.bounds[i + 1])
        return self.buckets[part], self.weights[part]


def word_values(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word of a chunk, in order."""
    kind = KINDS[texts.data]
    edge = np.ones(len(kind), dtype=bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge[texts.offsets[(texts.offsets < len(kind))]] = True
    start = np.flatnonzero(edge)
    end = np.append(start[1:], len(kind))[: len(start)]
    seen = kind[start] != SPACE
    start, end = start[seen], end[seen]
    value = range_hashes(texts.lowered().data, start, end)
    upper, lower = (np.concatenate([[0], np.cumsum(mask[texts.data])]) for mask in (UPPER, LOWER))
    capitals = (upper[end] - upper[start] > 1) & (lower[end] == lower[start])
    return np.where(capitals, value ^ CAPITALS, value), np.searchsorted(texts.offsets, start, side="right") - 1


def features_of(texts: Texts, buckets: int = BUCKETS) -> Features:
    value, row = word_values(texts)
    pairs = np.flatnonzero(row[1:] == row[:-1])
    again = pairs[value[pairs] == value[pairs + 1]]
    gram = np.concatenate([value, spread_bits(value[pairs] * PAIR + value[pairs + 1]), np.full(len(again), AGAIN)])
    rows = np.concatenate([row, row[pairs], row[again]]).astype(np.int64)
    keys, counts = np.unique(rows * buckets + (gram % U64(buckets)).astype(np.int64), return_counts=True)
    weight = 1 + np.log2(counts)
    owner = keys // buckets
    norm = np.sqrt(np.bincount(owner, weights=weight**2, minlength=len(texts)))
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return Features((keys % buckets).astype(np.int32), (weight / norm[owner]).astype(np.float32), bounds)


@dataclass
class State:
    """Sums of FTRL-Proximal; the last entry is the bias."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def fresh(cls, buckets: int) -> State:
        return cls(np.zeros(buckets + 1), np.zeros(buckets + 1))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """One example: features at distinct places ``at``, the bias among them."""
        w = self.weights(at)
        slope = (sigmoid(float(w @ x)) - label) * x
        n = self.n[at]
        self.z[at] += slope - (np.sqrt(n + slope**2) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + slope**2


def sigmoid(value: float | np.ndarray) -> float | np.ndarray:
    return 1 / (1 + np.exp(-np.clip(value, -40, 40)))


@dataclass
class Model:
    """Weights by bucket, and the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, features: Features) -> np.ndarray:
        """Sigmoid of the sparse dot product of each text."""
        parts = np.concatenate([[0.0], np.cumsum(self.weights[features.buckets].astype(np.float64) * features.weights)])
        return sigmoid(self.bias + parts[features.bounds[1:]] - parts[features.bounds[:-1]])


def training_labels(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``label`` (0/1) of the labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.filter("doc_id is not null and label is not null").filter(~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.min((F.col("label") != 0).cast("int")).alias("label"))


def labelled_texts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``place`` (a hash of id and text), ``label`` and ``text`` of every labelled row."""
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return documents.join(labels, "doc_id").select(F.xxhash64("doc_id", "text").alias("place"), "label", "text")


def labelled_examples(texts: DataFrame, buckets: int) -> DataFrame:
    """The features of labelled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(f"place long, {EXAMPLES}")
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                found = features_of(texts, buckets)
                packed = [found.of(i) for i in range(len(texts))]
                columns = [batch.column(name).slice(texts.first, len(texts)) for name in ("place", "label")]
                yield batch_of(schema, [*columns, [b.tobytes() for b, _ in packed], [w.tobytes() for _, w in packed]])

    return texts.mapInArrow(run, f"place long, {EXAMPLES}")


def train_shard(state: State, examples: list[tuple[int, np.ndarray, np.ndarray]], passes: int = PASSES) -> State:
    """Learns from the examples in turn, ``passes`` times."""
    bias = np.array([len(state.z) - 1])
    for _ in range(passes):
        for label, at, x in examples:
            state.learn(np.concatenate([at, bias]), np.append(x, 1.0).astype(np.float64), label)
    return state


def mixed(examples: DataFrame, buckets: int, shards: int) -> np.ndarray:
    """Mean of the weights of all shards, by rows; the last is the bias."""
    schema = "bucket int, weight double, rows long"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("label", "ascending")])
        rows = zip(*(table.column(c).to_pylist() for c in ("label", "features", "weights")), strict=True)
        rows = [(y, np.frombuffer(f, np.int32), np.frombuffer(w, np.float32)) for y, f, w in rows]
        weights = train_shard(State.fresh(buckets), rows).weights(slice(None))
        at = np.union1d(np.flatnonzero(weights), [buckets])
        return pa.Table.from_batches([batch_of(arrow_schema(schema), [at, weights[at] * len(rows), np.full(len(at), len(rows))])])

    shard = F.pmod(F.col("place"), F.lit(shards)).alias("shard")
    parts = examples.select(shard, "*").groupBy("shard").applyInArrow(run, schema)
    found = parts.groupBy("bucket").agg(F.sum("weight").alias("weight"), F.sum("rows").alias("rows")).toArrow()
    weights = np.zeros(buckets + 1)
    rows = found.column("rows").to_numpy().max()  # every shard gives the bias
    weights[found.column("bucket").to_numpy()] = found.column("weight").to_numpy() / rows
    return weights


def train(documents: DataFrame, labels: DataFrame, buckets: int = BUCKETS, shard_rows: int = SHARD_ROWS) -> Model:
    """Fits the model to all labels that are not held out."""
    known = written(training_labels(labels), "quality-labels")
    known = F.broadcast(known) if known.count() * 64 <= BROADCAST_BYTES else known
    texts = labelled_texts(documents, known)
    size = F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("size")
    sums = {r["label"]: r for r in texts.groupBy("label").agg(F.count("*").alias("n"), size).collect()}
    ones, zeros = (sums[y]["n"] if y in sums else 0 for y in (1, 0))
    if not ones or not zeros:
        share = min(max(ones / max(ones + zeros, 1), 1e-12), 1 - 1e-12)
        return Model(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))))
    shards = max(-(-(ones + zeros) // shard_rows), -(-sum(r["size"] for r in sums.values()) // SHARD_BYTES))
    weights = mixed(labelled_examples(texts, buckets), buckets, shards)
    return Model(weights[:-1].astype(np.float32), float(weights[-1]))


SCORES = "doc_id long, score double"


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted``. One narrow pass."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, own = arrow_schema(SCORES), held.value
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                ids = batch.column("doc_id").slice(texts.first, len(texts))
                yield batch_of(schema, [ids, own.scores(features_of(texts, len(own.weights)))])

    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    predicted = (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted")
    return plain.mapInArrow(run, SCORES).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Trains on the labels and scores all documents."""
    return score(documents, train(documents, labels))
