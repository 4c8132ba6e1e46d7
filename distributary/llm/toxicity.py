"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A document is a bag of sentences. A sentence is offensive with probability sigmoid(b + sum of the weights of its
features), features being words and beginnings of words, whose endings vary; a document is toxic unless all its sentences are harmless, so P = 1 - (1 - leak) * product of (1 - P(sentence))
(noisy-or). Weights are fitted to document labels alone by gradient descent on that likelihood, and then say which
sentences offend.

The classifier is fitted on a bounded sample: at most ``SAMPLE`` labelled documents, those of smallest hash of their
id, of each class half if there are enough. Features enter if their document frequencies in both classes differ clearly
(``LEAST_CHI2``), at most ``WORDS`` of them. Scoring reads every document once, in place.

Labels are used only of rows whose crc32 of ``doc_id`` is not divisible by ``FOLDS``. Several labels of one document
count as toxic if any says so; null labels are ignored. Null, empty and wordless texts get the leak probability, as
any text without known words does. Without labels of both classes every score is the share of toxic labels (0 if
there are none). Texts of any length are taken whole; rows of equal ``doc_id`` are scored each for itself. Rows
without id are scored and not held out. Other columns are not looked at. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distributary.llm.shared import arrow_schema, written
from distributary.llm.text import PLAIN, U64, Texts, Words, batch_of, range_hashes, texts_of, words_of

FOLDS = 5
SAMPLE = 20_000
WORDS = 4096
LEAST_CHI2 = 30.0
BEGINNINGS = (4, 5, 6, 7, 8)
STEPS = 400
RATE = 0.1
PENALTY = 0.002

ENDS = np.isin(np.arange(256), list(b".!?\n"))


def held_out(doc_id: Column) -> Column:
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == 0, F.lit(False))


def sentences(texts: Texts, words: Words) -> np.ndarray:
    """Number of the sentence of each word, over the whole chunk; sentences end at . ! ? and line ends."""
    ends = np.concatenate([[0], np.cumsum(ENDS[texts.data])])
    number = ends[words.start] + words.rows()  # texts are sentences apart
    return np.cumsum(np.concatenate([[0], (np.diff(number) > 0)])) if len(number) else number


def features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words with the hash of a feature of theirs: the word itself, and its beginnings of some lengths in bytes."""
    yield np.arange(len(words)), words.hashes()
    for size in BEGINNINGS:
        longer = np.flatnonzero(words.end - words.start > size)
        start = words.start[longer]
        yield longer, range_hashes(words.texts.data, start, start + size) ^ U64(0x5851F42D4C957F2D)


def known_features(words: Words, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and place in the sorted list of all listed features, in the order of the words."""
    found = []
    for at, value in features(words):
        place = np.minimum(np.searchsorted(listed, value), len(listed) - 1)
        known = listed[place] == value
        found.append((at[known], place[known]))
    at, place = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(at, kind="stable")
    return at[order], place[order]


@dataclass
class Model:
    """Sorted feature hashes with their weights; ``bias`` of a sentence and ``leak`` of a document."""

    words: np.ndarray
    weights: np.ndarray
    bias: float
    leak: float

    def sentence_scores(self, words: Words, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sentence, row and probability of all sentences with known features; each counts as often as it occurs."""
        if not len(self.words) or not len(words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        word, place = known_features(words, self.words)
        listed, index = np.unique(sentence[word], return_inverse=True)
        value = self.bias + np.bincount(index, weights=self.weights[place], minlength=len(listed))
        row = words.rows()[np.searchsorted(sentence, listed)]
        return listed, row, 1 / (1 + np.exp(-value))

    def scores(self, words: Words, sentence: np.ndarray, rows: int) -> np.ndarray:
        """Noisy-or of the sentences of each text."""
        _, row, p = self.sentence_scores(words, sentence)
        harmless = np.bincount(row, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=rows)
        return np.clip(1 - (1 - self.leak) * np.exp(harmless), 0.0, 1.0)


def training_labels(labels: DataFrame, sample: int) -> DataFrame:
    """The bounded sample: ``doc_id`` and ``toxic`` (0/1) of labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    first = F.xxhash64("doc_id")
    halves = [known.filter(F.col("toxic") == t).orderBy(first, "doc_id").limit(sample // 2) for t in (0, 1)]
    return halves[0].union(halves[1])


def word_classes(sample: DataFrame) -> DataFrame:
    """Documents of both classes that have each word."""
    schema = "word long, toxic int, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for texts in texts_of(batch.column("text")):
                words = words_of(texts.lowered(), PLAIN)
                own, all_rows = toxic[texts.first : texts.first + len(texts)], words.rows()
                at, hashes = (np.concatenate(x) for x in zip(*features(words), strict=True))
                rows = all_rows[at]
                order = np.lexsort((hashes, rows))
                new = np.ones(len(order), dtype=bool)
                new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
                for t in (0, 1):
                    value, n = np.unique(hashes[order][new & (own[rows[order]] == t)], return_counts=True)
                    yield batch_of(arrow_schema(schema), [value.view(np.int64), np.full(len(value), t), n])

    counts = sample.mapInArrow(run, schema)
    one = F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0))
    return counts.groupBy("word").agg(one.alias("ones"), (F.sum("n") - one).alias("zeros"))


def telling_words(sample: DataFrame, n_one: int, n_zero: int) -> np.ndarray:
    """Sorted hashes of the words whose document frequencies differ most between the classes."""
    a, c = F.col("ones").cast("double"), F.col("zeros").cast("double")
    b, d = n_one - a, n_zero - c
    chi2 = (n_one + n_zero) * (a * d - b * c) ** 2 / (float(n_one) * n_zero * (a + c) * (b + d) + 1e-9)
    found = word_classes(sample).withColumn("chi2", chi2).filter(F.col("chi2") >= LEAST_CHI2)
    rows = found.orderBy(F.desc("chi2"), "word").limit(WORDS).select("word").collect()
    return np.sort(np.array([r["word"] for r in rows], dtype=np.int64).view(U64))


def sentence_words(sample: DataFrame, listed: np.ndarray) -> DataFrame:
    """Per document its label, and its known words with the sentence they are in."""
    schema = "toxic int, sentences binary, words binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                lowered = texts.lowered()
                words = words_of(lowered, PLAIN)
                at, place = known_features(words, listed)
                number = sentences(lowered, words)[at]
                cuts = np.searchsorted(at, words.bounds)
                bags = [slice(a, b) for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
                toxic = batch.column("toxic").slice(texts.first, len(texts))
                packed = [[x[bag].astype(np.int32).tobytes() for bag in bags] for x in (number, place)]
                yield batch_of(arrow_schema(schema), [toxic, *packed])

    return sample.mapInArrow(run, schema)


def fit(bags: list[tuple[int, np.ndarray, np.ndarray]], words: np.ndarray, weight_one: float, weight_zero: float) -> Model:
    """Gradient descent (Adam) on the noisy-or likelihood; classes weigh as much as in all labels."""
    label = np.array([b[0] for b in bags], dtype=np.float64)
    doc, sentence, word, count = [], [], [], 0
    for i, (_, numbers, places) in enumerate(bags):
        _, local = np.unique(numbers, return_inverse=True)
        sentence.append(count + local)
        word.append(places)
        n = int(local.max()) + 1 if len(local) else 0
        doc.append(np.full(n, i))
        count += n
    doc, sentence, word = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (doc, sentence, word))
    importance = np.where(label == 1, weight_one, weight_zero)
    value = np.zeros(len(words) + 2)
    value[-2], value[-1] = -2.0, -4.0  # bias of a sentence, logit of the leak
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-(value[-2] + np.bincount(sentence, weights=value[word], minlength=count))))
        leak = 1 / (1 + np.exp(-value[-1]))
        harmless = np.log1p(-leak) + np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(bags))
        q = np.clip(1 - np.exp(harmless), 1e-9, 1 - 1e-9)
        # Derivative of the log-likelihood by log(1 - q), and of that by each logit.
        by_harmless = importance * np.where(label == 1, -(1 - q) / q, 1.0)
        by_sentence = by_harmless[doc] * -p
        slope = np.concatenate([
            np.bincount(word, weights=by_sentence[sentence], minlength=len(words)),
            [by_sentence.sum(), (by_harmless * -leak).sum()],
        ]) / max(importance.sum(), 1e-9)
        slope[:-2] -= PENALTY * value[:-2]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        value = value + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(words, value[:-2], float(value[-2]), float(1 / (1 + np.exp(-value[-1]))))


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits the sentence model to the labels of the documents."""
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    chosen = training_labels(labels, sample)  # at most ``sample`` rows of two numbers
    bags = written(documents.join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "labelled-sample")
    counts = {r["toxic"]: r["n"] for r in bags.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    share = labels.filter(~held_out(F.col("doc_id"))).agg(F.avg((F.col("toxic") != 0).cast("double"))).first()[0] or 0.0
    nothing = np.zeros(0, U64)
    if not ones or not zeros:
        return Model(nothing, np.zeros(0), 0.0, share)
    words = telling_words(bags, ones, zeros)
    if not len(words):
        return Model(nothing, np.zeros(0), 0.0, share)
    rows = sentence_words(bags, words).collect()
    data = [(r["toxic"], np.frombuffer(r["sentences"], np.int32), np.frombuffer(r["words"], np.int32)) for r in rows]
    return fit(data, words, share / ones * len(rows), (1 - share) / zeros * len(rows))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score``, ``predicted``, and the number of offending sentences."""
    schema_of = "doc_id long, score double, n_offending long"
    schema = arrow_schema(schema_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                lowered = texts.lowered()
                words = words_of(lowered, PLAIN)
                number = sentences(lowered, words)
                _, row, p = model.sentence_scores(words, number)
                offending = np.bincount(row[p >= 0.5], minlength=len(texts))
                ids = batch.column("doc_id").slice(texts.first, len(texts))
                yield batch_of(schema, [ids, model.scores(words, number, len(texts)), offending])

    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = plain.mapInArrow(run, schema_of)
    predicted = (F.col("score") >= 0.5).cast("int")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"), "n_offending")


def offending_sentences(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The sentences that make a document toxic: their text, from first to last word, and their probability."""
    schema_of = "doc_id long, sentence string, p double"
    schema = arrow_schema(schema_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for texts in texts_of(batch.column("text")):
                lowered = texts.lowered()
                words = words_of(lowered, PLAIN)
                number = sentences(lowered, words)
                listed, row, p = model.sentence_scores(words, number)
                rows = []
                for s, i, value in zip(listed[p >= least], row[p >= least], p[p >= least], strict=True):
                    low, high = np.searchsorted(number, [s, s + 1])
                    raw = texts.data[words.start[low] : words.end[high - 1]].tobytes()
                    rows.append((ids[texts.first + i], raw.decode(), float(value)))
                if rows:
                    yield batch_of(schema, list(zip(*rows, strict=True)))

    plain = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, schema_of)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Trains on the labels and scores all documents."""
    return score(documents, train(documents, labels))
