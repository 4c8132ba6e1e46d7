"""Decontamination, quality rules, toxicity, licenses, languages and URL filters."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from distributary.llm import decontaminate, language, licenses, quality, toxicity, url_filter
from distributary.llm.text import SPACED as SPACED_BYTES
from distributary.llm.text import texts_of, words_of
from tests.llm import cases

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    return PLAIN.findall((text or "").translate(UPPER))


def benchmark_rows(rows):
    texts = [t for d, t, *_ in rows if t]
    whole = " ".join(plain(texts[0])[3:30])
    return [
        (1, whole), (2, whole.upper()), (2, "short item here"), (3, " ".join(plain(texts[-1])[:10])), (4, None), (5, ""),
        (6, "never seen words of no document at all in this place ever"), (None, whole), (7, "changed"), (8, "river"),
    ]


def brute_contamination(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        words = plain(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words and item is not None else 0):
            windows[tuple(words[i : i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    result = []
    for d, t, *_ in rows:
        words, hit, found = plain(t), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                names = windows.get(tuple(words[i : i + size]))
                if names:
                    hit.update(range(i, i + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        result.append((str(d), len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(result)


@pytest.mark.parametrize("broadcast", [decontaminate.BROADCAST_BYTES, 0])
def test_contamination(spark, broadcast):
    """In place and by joins."""
    rows = cases.awkward() + cases.random_documents(60)
    items = benchmark_rows(rows)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit("mine"))
    found = decontaminate.judge(cases.clashing(cases.frame(spark, rows)), bench, broadcast)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((str(r[0]), *r[1:]) for r in found.select(*names).collect()) == brute_contamination(rows, items)
    assert decontaminate.judge(cases.empty(spark), bench, broadcast).collect() == []
    nothing = decontaminate.judge(cases.frame(spark, rows), bench.filter("false"), broadcast)
    assert nothing.filter("contaminated").count() == 0


def test_clean_documents_stay_as_they_are(spark):
    rows = cases.awkward()
    bench = spark.createDataFrame([(1, rows[0][1])], "item_id long, text string")
    left = decontaminate.clean_documents(cases.frame(spark, rows), bench).collect()
    expected = [r for r in rows if r[1] != rows[0][1]]
    assert Counter(map(tuple, left)) == Counter(expected)


def brute_rules(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    marked = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i : i + 8])] > 1:
            marked.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(marked) > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked), failed


def test_quality_counts(spark):
    rows = cases.awkward() + [(90, "a\na\n\na|b#\r\nx\na|b#\r", "en", "s", 1)]
    frame = cases.clashing(cases.frame(spark, rows))
    found = quality.quality_rules(frame).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in found) == sorted(
        (str(d), *brute_rules(t)) for d, t, *_ in rows
    )
    assert not any(r["kept"] and r["base_failed"] for r in found)
    assert quality.quality_rules(cases.empty(spark)).collect() == []


def test_lines_of_texts_that_begin_with_a_newline():
    """The counts of a text do not depend on the texts before it in its chunk."""
    texts = ["x", "\nfoo\nfoo", "foo", "", "\n", "\n\nfoo\n\nfoo", None, "foo\n", "\nfoo\nfoo\n", "a\na"]
    for column in (texts, texts[1:], texts[::-1], ["\n"], [""]):
        chunk = next(texts_of(pa.array(column, pa.string())))
        found = quality.base_counts(chunk, words_of(chunk, SPACED_BYTES))
        assert list(zip(*(x.tolist() for x in found), strict=True)) == [brute_rules(t)[:5] for t in column]


def normal(text):
    data = re.sub(rb"[\x20\x09-\x0D]+", b" ", (text or "").encode())
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    return b" " + data if data else b""


def brute_model(texts, order):
    """Modified Kneser-Ney by dictionaries."""
    counts = {order: Counter(t[i : i + order] for t in texts for i in range(len(t) - order + 1))}
    for size in range(order - 1, 0, -1):
        counts[size] = Counter(g[1:] for g in counts[size + 1])
    levels = {}
    for size, grams in counts.items():
        kinds = [max(1, sum(n == k for n in grams.values())) for k in (1, 2, 3, 4)]
        y = kinds[0] / (kinds[0] + 2 * kinds[1])
        raw = {1: 1 - 2 * y * kinds[1] / kinds[0], 2: 2 - 3 * y * kinds[2] / kinds[1], 3: 3 - 4 * y * kinds[3] / kinds[2]}
        off = lambda n, raw=raw: min(max(raw[min(n, 3)], 0.05), 0.95 * n)
        total, mass = defaultdict(float), defaultdict(float)
        for g, n in grams.items():
            total[g[:-1]] += n
            mass[g[:-1]] += off(n)
        levels[size] = (grams, off, total, mass)

    def p(gram):
        if not gram:
            return 1 / 256
        grams, off, total, mass = levels[len(gram)]
        history = gram[:-1]
        if history not in total:
            return p(gram[1:])
        n = grams.get(gram, 0)
        return max(n - off(n), 0) / total[history] + mass[history] / total[history] * p(gram[1:]) if n else mass[
            history
        ] / total[history] * p(gram[1:])

    return p


def test_perplexity_against_brute_force_and_both_ways(spark):
    rows = [r for r in cases.random_documents(40) if r[2] == "en"]
    frame = cases.frame(spark, rows).withColumn("language", F.lit("en"))
    order = 3
    counts = quality.gram_counts(frame, order)
    model = quality.kneser_ney(counts, order).cache()
    asked = spark.createDataFrame(
        [(i, t, "en") for i, t in enumerate(["the river zq stone", rows[0][1], "x", "", "東京 é"])],
        "doc_id long, text string, language string",
    )
    near = quality.scored_in_place(asked, quality.Model(model.toArrow(), order)).collect()
    far = quality.scored_by_join(asked, model, order).collect()
    p = brute_model([normal(t) for _, t, *_ in rows], order)
    for r in near:
        text = normal(r["text"])
        expected = sum(math.log(p(text[i : i + order])) for i in range(len(text) - order + 1))
        assert math.isclose(r["log_sum"], expected, rel_tol=1e-5, abs_tol=1e-6)
    far = {r["doc_id"]: r for r in far}
    for r in near:
        assert math.isclose(far[r["doc_id"]]["log_sum"], r["log_sum"], rel_tol=1e-5, abs_tol=1e-6)
        assert far[r["doc_id"]]["n_grams"] == r["n_grams"]


@pytest.mark.parametrize("model_bytes", [1 << 30, 0])
def test_no_text_predicts_itself(spark, model_bytes):
    """Noise and foreign alphabets go, their copies too, and clean texts stay; in place and by joins."""
    rng = random.Random(6)
    noise = " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(rng.randrange(3, 9))) for _ in range(300))
    greek = " ".join("".join(chr(rng.randrange(0x3B1, 0x3CA)) for _ in range(rng.randrange(3, 9))) for _ in range(300))
    odd = [(1000, noise), (1001, greek), (1002, noise.upper().replace(" ", "\n")), (1003, noise.lower())]
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    clean = [(i, " ".join(rng.choices(words, k=rng.randrange(60, 300)))) for i in range(300)]
    frame = cases.frame(spark, [(i, t, "en", "s", 1) for i, t in clean + odd])
    found = quality.assess(frame, ["doc_id"], model_bytes=model_bytes).filter("kept").collect()
    assert sorted(r["doc_id"] for r in found) == [i for i, _ in clean]


def test_good_documents_stay_as_they_are(spark):
    rows = cases.random_documents(60)
    left = quality.good_documents(cases.clashing(cases.frame(spark, rows))).collect()
    kept = {r["doc_id"] for r in quality.quality_rules(cases.frame(spark, rows)).filter("kept").collect()}
    assert {r["doc_id"] for r in left} == kept
    assert all(tuple(r)[:5] in set(rows) and r["n_words"] == r["language"] == "mine" for r in left)


def test_toxicity_learns_sentences(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(400):
        sentences = [" ".join(rng.choice(cases.WORDS, 8)) + "." for _ in range(rng.integers(1, 9))]
        toxic = i % 4 == 0
        if toxic:
            sentences.insert(rng.integers(0, len(sentences) + 1), f"You awful {rng.choice(['cretin', 'cretins'])}!")
        rows.append((i, " ".join(sentences), "en", "s", 1))
        labels.append((i, int(toxic)))
    labels += [(3, None), (None, 1), (5_000, 1)]
    documents = cases.clashing(cases.frame(spark, rows))
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(documents, known)
    found = {r["doc_id"]: r for r in toxicity.score(documents, model).collect()}
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(400))
    held = [(found[i]["predicted"], t) for i, t in labels[:400] if found[i]["held_out"]]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    located = toxicity.offending_sentences(documents, model).collect()
    assert located and all("cretin" in r["sentence"] for r in located)
    odd = toxicity.score(cases.frame(spark, cases.awkward()), model).collect()
    assert len(odd) == len(cases.awkward()) and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score(cases.empty(spark), model).collect() == []
    untaught = toxicity.train(documents, known.filter("false"))
    assert {r["score"] for r in toxicity.score(documents, untaught).collect()} == {0.0}


def test_license_automata():
    automaton = licenses.Automaton("permission <<beginOptional>>is hereby<<endOptional>> granted to <<var;match=2>> freely")
    accepts = lambda t: automaton.accepts(t.split(), 0)
    assert accepts("permission granted to freely now") == 4
    assert accepts("permission is hereby granted to all people freely") == 8
    assert accepts("permission is granted to all freely") == 0
    assert accepts("permission granted to far too many freely") == 0
    with pytest.raises(ValueError):
        licenses.Automaton("<<beginOptional>>all<<endOptional>>")


def written_out(template, filler=""):
    """A template with all optional wording and ``filler`` in the replaceable regions."""
    return licenses.MARKUP.sub(lambda m: f" {filler} " if m[1].startswith("var") else " ", template)


def accepted_by(text):
    words = plain(text)
    return {licenses.label_of(label) for label, t in licenses.TEMPLATES.items() if any(licenses.Automaton(t).accepts(words, i) for i in range(len(words)))}


def test_whole_licenses():
    """Every template accepts its own wording; a changed or missing mandatory word, also in the conditions, is refused."""
    for label, template in licenses.TEMPLATES.items():
        assert licenses.label_of(label) in accepted_by(f"before {written_out(template, 'x')} after")
    for label in ("bsd-2-clause", "bsd-3-clause", "isc", "mit"):
        words = plain(written_out(licenses.TEMPLATES[label], "x y"))
        assert accepted_by(" ".join(words)) == {label}
        assert accepted_by(" ".join(words[: len(words) // 2])) == set()
        last = len(words) - 2
        assert accepted_by(" ".join([*words[:last], "changed", *words[last + 1 :]])) == set()


def test_a_number_alone_names_no_license():
    assert accepted_by("licensed under 4.0") == accepted_by("licensed under a 4.0") == set()
    assert accepted_by("Licensed under CC BY 4.0.") == {"cc-by-4.0"}
    assert accepted_by("licensed under a Creative Commons Attribution 4.0 licence") == {"cc-by-4.0"}


def test_license_scan(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0.", "licensed under the apache license 2.0", "Apache License only",
        "Copyright (c) 2020 by Some One, Inc. All rights reserved. all rights reserved", "CC-BY, cc by cc by", None, "",
        "GNU General Public License as published by the Free Software Foundation, either version 3", "general public",
        "GNU General Public License, version 4", "all\nrights\treserved",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and documentation"
        " to deal in the Software without restriction", "licensed under 4.0", "licensed under CC-BY 4.0",
        written_out(licenses.TEMPLATES["mit"], "it"), written_out(licenses.TEMPLATES["bsd-3-clause"], "Some One, Inc."),
    ]
    rows = cases.awkward() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(texts)]
    found = licenses.license_scan(cases.clashing(cases.frame(spark, rows))).collect()
    expected = []
    for d, t, *_ in rows:
        words = plain(t)
        places = [(i, p[1]) for p in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p[0].split())] == p[0].split()]
        spaced = " " + "".join(w + " " for w in words)
        accepted = {licenses.label_of(label) for label, x in licenses.TEMPLATES.items() if re.search(" " + licenses.pattern(x), spaced)}
        base = {label for _, label in places}
        expected.append((
            str(d), len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted(base)), ",".join(sorted(base | accepted)), 1.0 if accepted else 0.5 if base else 0.0,
        ))
    assert sorted(map(str, [(str(r[0]), *r[1:]) for r in found])) == sorted(map(str, expected))
    assert licenses.license_scan(cases.empty(spark)).collect() == []


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)


def test_languages(spark):
    rng = np.random.default_rng(2)
    words = {"en": "the house and garden with water".split(), "de": "das haus und garten mit wasser".split()}
    text = lambda k, n: " ".join(rng.choice(words[k], n))
    documents = spark.createDataFrame(
        [(i, text(k, 40), k) for i in range(30) for k in words] + [(99, None, "en"), (98, "x", None)],
        "doc_id long, text string, lang string",
    )
    rows = []
    for i in range(60):
        k = "de" if i % 2 else "en"
        rows.append((i, f"http://h{i % 4}.example.{'de' if k == 'de' else 'com'}/a", f'<html lang="{k}"><body>{text(k, 30)}</body>'))
    rows += [
        (100, "http://h1.example.de/x", '<html lang="en"><p>'),  # no text: address and host against the declaration
        (101, None, None), (102, "", ""), (103, "http://h0.example.com/", f"<script>{text('de', 50)}</script>{text('en', 9)}"),
        (None, "http://x.example.de", text("de", 30)), (104, "http://x.example.de", f"<!-- {text('en', 80)}"),
    ]
    pages = pages_of(spark, rows).withColumns({"lang": F.lit("mine"), "host": F.lit("mine"), "salt": F.lit("mine")})
    found = {r["page_id"]: r for r in language.identify(pages, documents).collect()}
    assert all(found[i]["language"] == ("de" if i % 2 else "en") for i in range(60))
    assert found[103]["language"] == "en" and found[None]["language"] == "de"
    assert found[101]["text_language"] is None and 0 < found[101]["score"] <= 1 and found[104]["text_language"] is None
    assert found[104]["language"] == "de"  # by its address alone
    assert language.identify(pages.filter("false"), documents).collect() == []
    assert {r["language"] for r in language.identify(pages, documents.filter("false")).collect()} == {None}


def brute_languages(texts, evidence):
    """Language and probability of pages by the formula; ``evidence`` has declared language, suffix, domain, host and text."""
    def grams(text):
        letters = [b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in text.lower().encode()]
        letters = [b for i, b in enumerate(letters) if b != 0x20 or i == 0 or letters[i - 1] != 0x20]
        codes = [a << 16 | b << 8 | c for a, b, c in zip(letters, letters[1:], letters[2:])]
        return [(c * 0x9E3779B1 >> 13) % language.TRIGRAMS for c in codes]

    names = sorted({name for name, _ in texts})
    counts = {name: Counter() for name in names}
    for name, text in texts:
        counts[name].update(grams(text))
    sizes = {name: c.total() + language.SMOOTHING * language.TRIGRAMS for name, c in counts.items()}
    logs, posts = [], []
    for *_, text in evidence:
        found = grams(text)
        weight = min(len(found), language.EFFECTIVE) / max(len(found), 1)
        log = [weight * sum(math.log((counts[x][g] + language.SMOOTHING) / sizes[x]) for g in found) for x in names]
        log = [v - max(log) for v in log]
        logs.append(log)
        posts.append([math.exp(v) / sum(map(math.exp, log)) for v in log])
    result = []
    for i, page in enumerate(evidence):
        def others(n):
            """Sum of the posteriors of the other pages that agree in their first ``n`` keys (suffix, domain, host)."""
            alike = [p for e, p in zip(evidence, posts) if e[1 : 1 + n] == page[1 : 1 + n]]  # noqa: B023
            return [max(sum(p[x] for p in alike) - posts[i][x], 0.0) for x in range(len(names))]  # noqa: B023

        everywhere, suffix = others(0), others(1)
        prior = [(n + language.SMOOTHING) / (sum(everywhere) + language.SMOOTHING * len(names)) for n in everywhere]
        for level in (suffix, others(2), others(3)):
            prior = [(n + language.PRIOR_PAGES * p) / (sum(level) + language.PRIOR_PAGES) for n, p in zip(level, prior)]
        alike = [p for e, p in zip(evidence, posts) if e[0] == page[0]]
        declared = [max(sum(p[x] for p in alike) - posts[i][x], 0.0) for x in range(len(names))]
        kinds = len({e[0] for e in evidence}), len({e[1] for e in evidence})
        total = [
            logs[i][x] + math.log(prior[x])
            + math.log((declared[x] + language.SMOOTHING) / (everywhere[x] + language.SMOOTHING * kinds[0]))
            + math.log((suffix[x] + language.SMOOTHING) / (everywhere[x] + language.SMOOTHING * kinds[1]))
            for x in range(len(names))
        ]
        best = max(range(len(names)), key=lambda x: total[x])  # noqa: B023
        result.append((names[best], 1 / sum(math.exp(v - total[best]) for v in total)))
    return result


@pytest.mark.parametrize("languages", [3, 60])
def test_languages_against_brute_force(spark, languages):
    """Also with many languages, ties of empty pages and of languages with equal documents, and long pages."""
    rng = random.Random(6)
    vocabulary = {f"l{chr(97 + i // 10)}{chr(97 + i % 10)}": ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(12)] for i in range(languages)}
    texts = [(name, " ".join(rng.choices(words, k=60))) for name, words in vocabulary.items() for _ in range(2)]
    texts += [("twin", text) for name, text in texts if name == "laa"]
    rows, evidence = [], []
    for i in range(90):
        name = rng.choice(list(vocabulary))
        text = " ".join(rng.choices(vocabulary[name], k=rng.choice([0, 1, 3, 30, 2000])))
        declared, suffix = rng.choice([name, name, "lab", ""]), rng.choice(["aa", "bb", "cc"])
        domain = f"d{rng.randrange(3)}.{suffix}"
        host = f"h{rng.randrange(2)}.{domain}"
        rows.append((i, f"https://{host}/p", f'<html lang="{declared}"><p>{text}'))
        evidence.append((declared, suffix, domain, host, f" {text}"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    documents = spark.createDataFrame(texts, "lang string, text string")
    found = {r["page_id"]: r for r in language.identify(pages, documents).collect()}
    for i, (name, score) in enumerate(brute_languages(texts, evidence)):
        assert found[i]["score"] == pytest.approx(score, rel=1e-6)
        assert found[i]["language"] == name or score < 0.5 + 1e-6


def test_bloom_cascade():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    for n in (0, 1, 500, 19_000, 20_000):
        levels = url_filter.cascade(keys[:n], keys[n:])
        assert url_filter.listed_by(levels, keys).tolist() == [True] * n + [False] * (20_000 - n)


URLS = [
    "http://www.example.com/en/1", "http://a.example.com/en/1?ref=2", "http://A.Example.COM/en/1", "https://example.com/fr",
    "http://b.net/es/x", "http://b.net/fr/x#f", "http://b.net/de/x", "http://net/es/", "b.org/x", None, "", "x://", "x:///p",
    "http://c.org/a?x=1&ref=3", "http://c.org/a", "http://c.org/b", "http://u@d.org:80/a?b", "http://d.org#/a", "a://b://c/d",
    "http://e.org/line\nbreak?q", "http://notexample.com/en/",
]


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return host.translate(UPPER), path


@pytest.mark.parametrize(("segment", "block"), [(1_000_000, 1 << 20), (4, 1)])
def test_url_filter(spark, segment, block, monkeypatch):
    """With all cascades at hand, and with passes of one segment each."""
    monkeypatch.setattr(url_filter.with_membership, "__defaults__", (segment, block))
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(0, URLS[0], "again"), (None, URLS[1], None)]
    pages = pages_of(spark, rows).withColumns({"host": F.lit("mine"), "key": F.lit("mine"), "listed": F.lit("mine")})
    listed = url_filter.referral_keys(pages)
    found = url_filter.judge(pages, listed, url_filter.RULES, segment).collect()
    referred = {brute_url(u) for u in URLS if u and re.search(r"[?&]ref=", u)}
    expected = []
    for i, u, _ in rows:
        host, path = brute_url(u)
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, default=(0, None, "block" if (host, path) in referred else "allow"))
        expected.append((str(i), host, path, rule[1], rule[2]))
    assert sorted(map(str, ((str(r[0]), *r[1:]) for r in found))) == sorted(map(str, expected))
    assert url_filter.url_verdicts(pages.filter("false")).collect() == []


def test_null_slots_with_bytes_are_empty():
    column = pa.array(["ab", "cd", "e"]).filter(pa.array([True, True, True]))
    broken = pa.Array.from_buffers(pa.string(), 3, [pa.py_buffer(b"\x05"), *column.buffers()[1:]])
    texts = next(texts_of(broken))
    assert [texts.raw(i) for i in range(3)] == [b"ab", b"", b"e"]


def test_bands_joined_both_ways(spark, monkeypatch):
    found = []
    for limit in (100_000, 0):
        monkeypatch.setattr(quality, "BROADCAST_BANDS", limit)
        rows = quality.quality_rules(cases.clashing(cases.frame(spark, cases.random_documents(60))))
        found.append(sorted(map(repr, map(tuple, rows.collect()))))
    assert found[0] == found[1] and len(found[0]) == 60
