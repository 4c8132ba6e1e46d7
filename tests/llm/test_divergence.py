"""The divergence audit against plain dictionaries."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from distributary.llm import divergence
from tests.llm import cases


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def expected(rows, least, top):
    counts, docs, groups = Counter(), Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered(text or ""))
        counts.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    kept = defaultdict(list)
    for (lang, term), n in docs.items():
        if n >= least:
            kept[lang].append(term)
    found = []

    def ranked(lang, source, part, items, limit=None):
        ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
        found.extend((lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ordered))

    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, source in groups:
        terms = kept[lang]
        sources = sorted(s for x, s in groups if x == lang)
        n = {s: sum(counts[lang, s, t] for t in terms) for s in sources}
        p = {s: {t: 1 + 10**9 * (counts[lang, s, t] + 2) // (n[s] + 2 * len(terms)) for t in terms} for s in sources}
        every = {t: sum(counts[lang, s, t] for s in sources) for t in terms}
        q = {t: 1 + 10**9 * (every[t] + 2) // (sum(every.values()) + 2 * len(terms)) for t in terms}
        own = p[source]
        ranked(lang, source, "pair", [(s, sum(f(own[t], p[s][t]) for t in terms)) for s in sources if s != source])
        ranked(lang, source, "term", [(t, f(own[t], q[t])) for t in terms if counts[lang, source, t] and own[t] > q[t]], top)
    return sorted(found)


def varied(rows):
    """Sources of their own, terms of all lengths, ties."""
    longer = ["x" * 16, "y" * 17, "z" * 17, "é" * 8, "é" * 9, "Unwahrscheinlichkeit", "abcdefgh", "abcdefghi", "w" * 300]
    made = []
    for i, (doc_id, text, lang, source, n) in enumerate(rows):
        extra = " ".join(longer[j] for j in range(len(longer)) if (i + j) % 3)
        made.append((doc_id, None if text is None else f"{text} {extra}", lang, f"{source}{i % 5}" if source else source, n))
    return [*made, (None, None, "zz", "lonely", 0), (None, "rare words", "yy", "one", 0), (None, "", "yy", "two", 0)]


@pytest.mark.parametrize(("least", "top", "broadcast"), [(10, 10, True), (2, 3, False)])
def test_equals_dictionaries(spark, monkeypatch, least, top, broadcast):
    if not broadcast:
        monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    rows = varied(cases.awkward() + cases.random_documents())
    frame = cases.clashing(cases.frame(spark, rows)).withColumns({n: F.lit("mine") for n in ("term", "p", "value", "rank")})
    found = sorted(tuple(r) for r in divergence.audit(frame, least, top).collect())
    assert found == expected(rows, least, top)


def blocks(rows, kinds):
    import pyarrow as pa

    return pa.Table.from_pylist([dict(zip(kinds, r, strict=True)) for r in rows])


def test_blocks_and_tiles_add_up(monkeypatch):
    """What blocks of terms and tiles of sources add is what one block of all adds."""
    import random

    rng = random.Random(2)
    least = [rng.randrange(1, 50) for _ in range(7)]
    cells = {(s, t): rng.randrange(1, 10**9) for s in range(7) for t in "abcdefghij" if rng.random() < 0.5}
    f = lambda p, q: (p - q) ** 2 // (p + q)
    terms = {t for _, t in cells}
    wanted = {
        (i, j): sum(f(cells.get((i, t), least[i]), cells.get((j, t), least[j])) - f(least[i], least[j]) for t in terms)
        for i in range(7) for j in range(i + 1, 7)
    }
    for tile_size in (100, 3, 2):
        monkeypatch.setattr(divergence, "TILE", tile_size)
        sums = Counter()
        for block in ("abc", "defghij"):
            rows = [(s, t, p) for (s, t), p in cells.items() if t in block] + [(s, None, least[s]) for s in range(7)]
            for tile in range(-(-7 // tile_size)):
                for other in range(tile, -(-7 // tile_size)):
                    sent = [("x", tile, other, t, s, least[s], p) for s, t, p in rows if s // tile_size in (tile, other)]
                    table = blocks(sent, ["lang", "tile", "other", "term", "number", "least", "p"])
                    for r in divergence.block_pairs(table).to_pylist():
                        sums[r["one"], r["two"]] += r["added"]
        assert dict(sums) == wanted


def test_counts_merge_and_start_anew():
    import pyarrow as pa

    from distributary.llm.text import texts_of

    rows = varied(cases.random_documents(120, 9))
    counts, found, wanted = divergence.Counts(), Counter(), Counter()
    for k in range(0, len(rows), 10):
        part = rows[k : k + 10]
        for texts in texts_of(pa.array([r[1] for r in part], pa.string())):
            own = part[texts.first : texts.first + len(texts)]
            counts.add(texts, counts.group_numbers([r[2] or "" for r in own], [r[3] or "" for r in own]))
        if k % 20:
            counts.merge()
        if k % 50 == 0:
            for batch in counts.batches():
                for row in batch.to_pylist():
                    found[row["lang"], row["source"], row["term"]] += row["n"]
    for batch in counts.batches():
        for row in batch.to_pylist():
            found[row["lang"], row["source"], row["term"]] += row["n"]
    for _, text, lang, source, *_ in rows:
        wanted.update((lang or "", source or "", t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered(text or "")))
    assert found == wanted


def test_packed_terms_come_back():
    import numpy as np
    import pyarrow as pa

    from distributary.llm.text import texts_of, words_of

    terms = ["a", "ab", "abcdefgh", "é", "東京", "abcdefghi", "abcdefghijklmnop", "zz"]
    words = words_of(next(texts_of(pa.array([" ".join(terms)]))), divergence.LETTERS)
    for numbers, limit in ((1, 8), (2, 16)):
        chosen = np.flatnonzero(words.end - words.start <= limit)
        found = divergence.unpacked(divergence.packed(words, chosen, numbers)).to_pylist()
        assert found == [t for t in terms if len(t.encode()) <= limit]
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64) % np.uint64(97) << np.uint64(40)
    assert (divergence.radix_order([keys]) == np.argsort(keys, kind="stable")).all()


def test_no_documents(spark):
    assert divergence.audit(cases.empty(spark)).collect() == []
