"""Fill-in-middle against a plain version over code points."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from distributary.llm import fill_middle
from distributary.llm.text import texts_of
from tests.llm import cases


def expected(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_rows():
    rng = random.Random(8)
    texts = ["\n", "\n\n\n", "a", "a\n", "\na", "x<P>y", "<M>", "<\nP>", "a<", "P>b", "<S", "é\n" * 3000, "東" * 5000 + "\n京", "<<P\n>"]
    texts += ["".join(rng.choice("ab é東\n\n😀<>PSM") for _ in range(rng.randrange(1, 5000))) for _ in range(60)]
    return [(100 + i, t, "en", "s", len(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "rate", "spm"), [(7, 100, 50), (3, 40, 10)])
def test_forms_and_round_trip(spark, seed, rate, spm):
    rows = cases.awkward() + odd_rows()
    frame = cases.clashing(cases.frame(spark, rows)).withColumns({n: F.lit("mine") for n in ("n", "form", "fim_digest", "fim_rate")})
    made = fill_middle.transform(frame, seed=seed, rate=rate, spm=spm)
    back = made.withColumn("back", fill_middle.restored(F.col("form"), F.col("output"))).collect()
    found = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in back]
    assert sorted(map(repr, found)) == sorted(repr((d, *expected(d, t, seed, rate, spm))) for d, t, *_ in rows)
    assert all(r["back"] == (r["text"] or "") and r["key"] == "mine" for r in back)


def test_cuts_at_every_unit(monkeypatch):
    monkeypatch.setattr(fill_middle, "BLOCK", 8)
    texts = [t for _, t, *_ in odd_rows() if len(t) < 900]
    chunk = next(texts_of(pa.array(texts)))
    trees = fill_middle.BlockTrees.over(chunk, 8)
    units = [re.findall("[^\n]*\n|[^\n]+", t) for t in texts]
    assert trees.line_counts().tolist() == list(map(len, units))
    for k in range(max(map(len, units)) + 1):
        wanted = np.minimum(k, trees.line_counts())
        at, points = trees.cut(wanted)
        heads = ["".join(u[:k]) for u in units]
        assert points.tolist() == list(map(len, heads))
        assert (at - chunk.offsets[:-1]).tolist() == [len(h.encode()) for h in heads]


def test_no_documents(spark):
    assert fill_middle.fill_in_middle(cases.empty(spark)).collect() == []
