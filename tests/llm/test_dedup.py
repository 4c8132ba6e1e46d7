"""Near duplicates and repeated passages against brute force."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pytest

from distributary.llm import near_dup, substrings
from distributary.llm.shared import ARROW_BYTES, read_table
from tests.llm import cases

SPACES = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    for c in SPACES[1:]:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def shingles(text, k):
    words = words_of((text or "").translate(UPPER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_components(rows, k):
    sets = [(d, shingles(t, k)) for d, t, *_ in rows]
    root = {d: d for d, _ in sets}

    def find(d):
        return d if root[d] == d else find(root[d])

    for (a, s), (b, t) in combinations([x for x in sets if x[0] is not None and x[1]], 2):
        if 100 * len(s & t) >= 80 * len(s | t):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return sorted(
        (str(d), len(s), str(None if d is None else find(d) if s else d), d is None or (find(d) if s else d) == d)
        for d, s in sets
    )


def found_components(frame, k):
    rows = near_dup.near_duplicates(frame, k).collect()
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in rows)


@pytest.mark.parametrize(("rows", "k"), [(cases.awkward(), 4), (cases.random_documents(), 4), (cases.random_documents(), 5)])
def test_near_duplicates(spark, rows, k):
    assert found_components(cases.clashing(cases.frame(spark, rows)), k) == brute_components(rows, k)


def test_dense_region_with_several_components(spark, monkeypatch):
    """With hardly any neighbours and one tree's worth of luck, the exact search must find what is left."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for j in range(i % 4):
            words[(7 * i + 13 * j) % 60] = f"new{i}x{j}"
        rows.append((i, " ".join(words), "en", "s", 0))
    monkeypatch.setattr(near_dup, "NEIGHBOURS", 1)
    assert found_components(cases.frame(spark, rows), 4) == brute_components(rows, 4)


def test_an_id_with_two_texts_joins_the_copies_of_both(spark):
    one, other = ([f"{x}{i}" for i in range(50)] for x in "ab")
    rows = [(i, " ".join(words), "en", "s", 0) for i, words in ((5, one), (5, other), (7, [*one, "z"]), (9, ["z", *other]))]
    found = near_dup.near_duplicates(cases.frame(spark, rows), 4).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in found} == {(5, 5, True), (7, 5, False), (9, 5, False)}


def test_blocks_of_a_cluster(spark, monkeypatch):
    """A cluster of several blocks gives the same components."""
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 300)
    rows = cases.random_documents(120, seed=8)
    assert found_components(cases.frame(spark, rows), 4) == brute_components(rows, 4)


def test_near_duplicates_of_few_texts_over_many_partitions(spark):
    """Without adaptive execution, tasks get fewer entries than a text has neighbours."""
    rows = cases.random_documents(2, seed=9)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert found_components(cases.frame(spark, rows), 4) == brute_components(rows, 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_no_near_duplicates_in_an_empty_table(spark):
    assert near_dup.near_duplicates(cases.empty(spark), 4).collect() == []


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (4, 5), (5, 1), (20, 21)]
    found = {r["node"]: r["root"] for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n: r for n, r in found.items() if n != r} == {2: 1, 3: 1, 4: 1, 5: 1, 8: 7, 9: 7, 21: 20}


def test_one_python_process_for_each_task(spark, monkeypatch):
    """No stage of the near-duplicate search runs two functions over batches in one task."""
    plans, write = [], near_dup.written

    def seen(frame, name):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return write(frame, name)

    monkeypatch.setattr(near_dup, "written", seen)
    plans.append(near_dup.near_duplicates(cases.frame(spark, cases.random_documents(60)), 4)._jdf.queryExecution().optimizedPlan().toString())
    assert len(plans) > 8
    for plan in plans:
        stages = [[]]  # by depth: a function over batches above another without an exchange in between
        for line in plan.splitlines():
            depth = len(line) - len(line.lstrip(" :+-"))
            stages = [s for s in stages if not s or s[0] < depth]
            if any(x in line for x in ("Repartition", "Aggregate", "Join")):
                stages.append([depth, False])
            elif "MapInArrow" in line:
                assert not (stages[-1] and stages[-1][1]), plan
                stages.append([depth, True])


def test_batches_hold_bounded_bytes(spark, tmp_path):
    """Texts reach Python in batches of a few megabytes, however many rows that is."""
    rows = [(i, f"{i} " * 5000, "en", "s", 0) for i in range(1500)]
    cases.frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    held = read_table(spark, str(tmp_path), "documents").mapInArrow(sizes, "n long").collect()
    assert max(r.n for r in held) <= 2 * ARROW_BYTES and sum(r.n for r in held) > 30 << 20


def brute_repeats(rows, window):
    first = {}
    for d, t, *_ in rows:
        words = words_of(t)
        for i in range(len(words) - window + 1 if d is not None else 0):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, d), d)
    result = []
    for d, t, *_ in rows:
        words = words_of(t)
        gone = set()
        for i in range(len(words) - window + 1 if d is not None else 0):
            if first[tuple(words[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        result.append((str(d), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(result)


@pytest.mark.parametrize("group", [substrings.GROUP_SUFFIXES, 40])
@pytest.mark.parametrize("rows", [cases.awkward(), cases.random_documents()])
def test_substrings(spark, rows, group):
    """Groups of 40 suffixes make prefixes grow, up to windows that are frequent at full depth."""
    frame = substrings.without_repeats(cases.clashing(cases.frame(spark, rows)), group_suffixes=group, as_text=False)
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in frame.collect())
    assert found == brute_repeats(rows, substrings.WINDOW)


def test_no_group_grows_with_a_frequent_passage(spark):
    """A passage in a third of the rows, frequent at full depth, is spread over the groups."""
    rng, size = random.Random(4), 200
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{cases.prose(rng, 20)} {passage if i % 3 == 0 else ''}", "en", "s", 0) for i in range(600)]
    tagged = substrings.tagged(cases.frame(spark, rows))
    hot, total = substrings.hot_prefixes(tagged, substrings.WINDOW, size)
    assert len(hot) == substrings.WINDOW
    sizes = Counter()
    for part in substrings.dealt_suffixes(tagged, substrings.WINDOW, hot, -(-total // size)).collect():
        sizes[part["group_id"]] += len(substrings.unpack(part["places"])[0])
    assert sum(sizes.values()) > total / 2 and max(sizes.values()) < 4 * size
    frame = substrings.without_repeats(cases.frame(spark, rows), group_suffixes=size, as_text=False)
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in frame.collect())
    assert found == brute_repeats(rows, substrings.WINDOW)


def test_substrings_as_text(spark):
    rows = cases.random_documents()
    frame = cases.frame(spark, rows)
    left = substrings.without_repeats(frame)
    assert left.columns[:5] == frame.columns
    digest = lambda r: hashlib.sha256(" ".join(words_of(r["text"])).encode()).hexdigest()
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], digest(r)) for r in left.collect())
    assert found == brute_repeats(rows, substrings.WINDOW)
    texts = {r[1] for r in rows}
    assert all(r["text"] in texts for r in left.filter("n_removed = 0").collect())
    spans = left.filter("n_removed > 0").selectExpr(
        "n_removed", "aggregate(removed_spans, 0, (a, x) -> a + x.after - x.first) as n"
    )
    assert all(r["n_removed"] == r["n"] for r in spans.collect())


def test_no_repeats_in_an_empty_table(spark):
    assert substrings.kept_digests(cases.empty(spark)).collect() == []
