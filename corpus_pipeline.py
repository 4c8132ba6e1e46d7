"""A training corpus from raw documents: filtered, deduplicated, decontaminated and tokenized.

Every stage works on all rows that the one before kept, and its decisions take effect. All stages but the last return
the columns of ``documents``; the last returns a row per document that is left.

Null texts have no words and go in the first stage, as empty and very short texts do; texts of any length are taken
whole. Equal rows, rows without id and rows that share an id are documents of their own, of which the near-duplicate
stage keeps one if their texts are alike. Columns beyond those of ``documents`` are dropped, whatever their names. Empty
tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distributary.llm import bpe, decontaminate, near_dup, quality, substrings
from distributary.llm.queries import TOKENIZER
from distributary.llm.shared import BROADCAST_BYTES, deleted, read_table, spent_tables, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE = 5
FIRST_OWN_ID = 1 << 62

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and the perplexity bands."""
    return quality.good_documents(docs.select(*COLUMNS))


def with_own_ids(docs: DataFrame) -> DataFrame:
    """Adds ``own_id``: ``doc_id`` where it names one row, else a number above all such ids, fixed by being written."""
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("rows_of_id")).filter("rows_of_id > 1 or doc_id is null")
    if shared.isEmpty():
        return docs.withColumn("own_id", F.col("doc_id"))
    shared = written(shared.select(F.col("doc_id").alias("shared_id"), F.lit(True).alias("is_shared")), "shared-ids")
    told = docs.join(shared, docs["doc_id"].eqNullSafe(shared["shared_id"]), "left")
    own = F.when(F.col("is_shared"), F.lit(FIRST_OWN_ID) + F.monotonically_increasing_id()).otherwise(F.col("doc_id"))
    return written(told.select(*docs.columns, own.alias("own_id")), "own-ids")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near duplicates, the one of smallest id; rows of shared or no id are told apart.

    Ids of the others go to all tasks if a count finds them few, so that whole texts need not be moved.
    """
    numbered = with_own_ids(docs.select(*COLUMNS))
    judged = near_dup.near_duplicates(numbered.select(F.col("own_id").alias("doc_id"), "text"), SHINGLE)
    others = judged.filter("not kept").select(F.col("doc_id").alias("own_id"))
    if 8 * others.count() <= BROADCAST_BYTES:
        others = F.broadcast(others)
    return numbered.join(others, "own_id", "left_anti").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stood in an earlier document; ``n_chars`` follows the text."""
    left = substrings.without_repeats(docs.select(*COLUMNS))
    shorter = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", shorter).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean_documents(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the tokens of every document, and the digest of the text they decode to."""
    return bpe.token_digests(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", one_of_each),
    ("substring_dedup", without_repeats),
    ("decontamination", decontaminated),
    ("bpe", tokens),
]

# SQL can express neither the perplexity bands nor the token ids.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next; what a stage read is deleted then."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with spent_tables(spark) as folders:
            docs = written(stage(spark, docs, sf_dir), name)
            result = folders.pop()
        if before:
            deleted(spark, before)
        before = result
    return STAGES[-1][1](spark, docs, sf_dir)
