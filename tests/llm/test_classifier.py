"""The quality classifier: features and updates against plain versions, and accuracy on held-out labels."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from distributary.llm import classifier
from distributary.llm.text import texts_of
from tests.conftest import SF_DIR
from tests.llm import cases

LABELS = "doc_id long, quality int, toxic int"


def plain_features(text):
    """Counts of words, pairs of words and doubled words."""
    found = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[!-/:-@\[-`{-~]+", text)
    words = []
    for w in found:
        capitals = len(re.findall("[A-Z]", w)) > 1 and not re.search("[a-z]", w)
        words.append((re.sub("[A-Z]", lambda m: m[0].lower(), w), capitals))
    grams = Counter(words)
    grams.update(zip(words, words[1:], strict=False))
    grams["again"] = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return +grams


def test_features_equal_plain_counts():
    texts = [r[1] or "" for r in cases.awkward()] + ["HE SAID: NO!! no!! No", "a a a b", "ÄÖ ä", "x\x00y\x7fz"]
    chunk = next(texts_of(pa.array(texts)))
    found = classifier.features_of(chunk, 1 << 40)  # no two share a bucket
    for i, text in enumerate(texts):
        weights = [1 + math.log2(n) for n in plain_features(text).values()]
        norm = math.sqrt(sum(w * w for w in weights))
        assert np.allclose(sorted(found.of(i)[1]), sorted(w / norm for w in weights), rtol=1e-5)
    same = classifier.features_of(next(texts_of(pa.array(["", "one two", "One two", "three"]))))
    assert same.of(1)[0].tolist() == same.of(2)[0].tolist() != same.of(3)[0].tolist()


def test_updates_equal_the_written_formulas():
    rng = random.Random(6)
    size = 12
    examples = []
    for _ in range(200):
        at = rng.sample(range(size), 4)
        examples.append((int(3 in at or rng.random() < 0.1), np.array(at, np.int32), np.array([rng.random() for _ in at], np.float32)))
    state = classifier.train_shard(classifier.State.fresh(size), examples, passes=2)
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(i):
        if abs(z[i]) <= classifier.L1:
            return 0.0
        return (math.copysign(classifier.L1, z[i]) - z[i]) / ((classifier.BETA + math.sqrt(n[i])) / classifier.ALPHA + classifier.L2)

    for label, at, x in examples * 2:
        pairs = [*zip(at.tolist(), x.tolist(), strict=True), (size, 1.0)]
        w = {i: weight(i) for i, _ in pairs}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in pairs)))
        for i, v in pairs:
            g = (p - label) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / classifier.ALPHA * w[i]
            n[i] += g * g
    assert np.allclose(state.z, z) and np.allclose(state.n, n)
    assert np.allclose(state.weights(slice(None)), [weight(i) for i in range(size + 1)])


def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = classifier.quality(documents, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) > 0.9 * len(held)
    good = [r["score"] for r in held if r["quality"]]
    bad = [r["score"] for r in held if not r["quality"]]
    assert sum(g > b for g in good for b in bad) > 0.95 * len(good) * len(bad)


def test_shards_are_mixed(spark):
    documents, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    texts = classifier.labelled_texts(documents, classifier.training_labels(labels))
    examples = classifier.labelled_examples(texts, 1 << 12)
    rows = sorted(examples.collect(), key=lambda r: (r["place"], r["label"]))
    rows = [(r["place"], (r["label"], np.frombuffer(r["features"], np.int32), np.frombuffer(r["weights"], np.float32))) for r in rows]
    for shards in (1, 3):
        parts = [[x for place, x in rows if place % shards == i] for i in range(shards)]
        models = [classifier.train_shard(classifier.State.fresh(1 << 12), part).weights(slice(None)) for part in parts]
        wanted = sum(len(p) * m for p, m in zip(parts, models, strict=True)) / len(rows)
        assert np.allclose(classifier.mixed(examples, 1 << 12, shards), wanted)


@pytest.mark.parametrize("labelled", [[], [(2, 1, 0), (10, 1, 0)], [(2, 1, 0), (11, 0, 0), (11, 1, 0), (8, None, 0), (None, 0, 0), (999, 0, 0)]])
def test_awkward_rows(spark, labelled):
    rows = cases.awkward()
    frame = cases.clashing(cases.frame(spark, rows)).withColumns({n: F.lit("mine") for n in ("label", "score", "place", "quality")})
    found = classifier.quality(frame, spark.createDataFrame(labelled, LABELS)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_no_documents(spark):
    assert classifier.quality(cases.empty(spark), spark.createDataFrame([(1, 1, 0)], LABELS)).collect() == []
