"""The pipeline stage by stage, each against its own input."""

from pathlib import Path

import corpus_pipeline
from distributary.llm import decontaminate, near_dup, quality, substrings
from distributary.llm.shared import read_table, shared_folder, written
from tests.conftest import SF_DIR
from tests.llm import cases
from tests.llm.test_dedup import brute_components, brute_repeats
from tests.llm.test_filters import brute_contamination

K = corpus_pipeline.SHINGLE


def rows_of(frame):
    return [tuple(r) for r in frame.select(*corpus_pipeline.COLUMNS).collect()]


def test_stages(spark):
    docs = read_table(spark, SF_DIR, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "substring_dedup", "decontamination", "bpe"]
    left = {}
    before = {}
    for name, stage in stages.items():
        before[name] = docs
        docs = left[name] = written(stage(spark, docs, SF_DIR), name)
        if name != "bpe":
            assert docs.columns == corpus_pipeline.COLUMNS

    kept = {r["doc_id"] for r in quality.quality_rules(before["quality_rules"]).filter("kept").collect()}
    assert set(rows_of(left["quality_rules"])) == {r for r in rows_of(before["quality_rules"]) if r[0] in kept}

    rows = rows_of(before["near_duplicates"])
    first = {d for d, _, _, is_first in brute_components(rows, K) if is_first}
    assert set(rows_of(left["near_duplicates"])) == {r for r in rows if str(r[0]) in first}

    rows = rows_of(before["substring_dedup"])
    digests = {(d, n) for d, n, *_ in brute_repeats(rows, substrings.WINDOW)}
    removed = {d: (n, gone) for d, n, gone, _ in brute_repeats(rows, substrings.WINDOW)}
    assert len(digests) == len(rows)
    for doc_id, text, _, _, n_chars in rows_of(left["substring_dedup"]):
        words, gone = removed[str(doc_id)]
        assert len(text.split()) == words - gone
        assert n_chars == len(text) or not gone

    rows = rows_of(before["decontamination"])
    items = [tuple(r) for r in read_table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    dirty = {d for d, *_, bad in brute_contamination(rows, items) if bad}
    assert set(rows_of(left["decontamination"])) == {r for r in rows if str(r[0]) not in dirty}

    assert left["bpe"].count() == left["decontamination"].count()
    assert decontaminate.WINDOW == 10 and near_dup.PERCENT == 80


def test_one_row_of_each_group_whatever_its_ids(spark):
    text = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"else{i}" for i in range(40))
    rows = [(None, text)] * 2 + [(4, text)] * 2 + [(9, text), (4, other), (None, other), (7, None), (7, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], cases.KINDS).repartition(3)
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each(spark, cases.clashing(docs), SF_DIR).collect()]
    assert [t for _, t in left].count(text) == 1 and [t for _, t in left].count(other) == 1
    assert (9, text) in left and len(left) == 5  # rows without words are alike to none
    assert corpus_pipeline.one_of_each(spark, cases.empty(spark), SF_DIR).collect() == []


def test_texts_stay_where_they_are_if_few_are_dropped(spark, monkeypatch):
    docs = cases.frame(spark, cases.random_documents())
    sizes = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(sizes)
    spark.conf.set(sizes, "-1")
    try:
        few = corpus_pipeline.one_of_each(spark, docs, SF_DIR)
        plan = few._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        monkeypatch.setattr(corpus_pipeline, "BROADCAST_BYTES", -1)
        many = corpus_pipeline.one_of_each(spark, docs, SF_DIR)
        assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
        assert sorted(rows_of(few), key=repr) == sorted(rows_of(many), key=repr)
        assert 0 < few.count() < docs.count()
    finally:
        spark.conf.set(sizes, before)


def test_spent_tables_are_deleted(spark):
    kept = lambda: {p.name for p in Path(shared_folder(spark)).glob("*")}
    left = lambda before: sorted(name.rsplit("-", 1)[0] for name in kept() - before)
    docs = cases.frame(spark, cases.random_documents())
    before = kept()
    good = corpus_pipeline.quality_rules(spark, docs, SF_DIR)
    assert left(before) == ["bands", "scored"]
    assert {r["doc_id"] for r in good.collect()} <= {r["doc_id"] for r in docs.collect()}

    before = kept()
    first = near_dup.near_duplicates(docs, K)
    assert left(before) == ["near-duplicates"]
    assert first.count() == docs.count()

    before = kept()
    tokens = corpus_pipeline.run(spark, SF_DIR)
    names = left(before)
    assert names == ["decontamination"]
    assert tokens.count() > 0
