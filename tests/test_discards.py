"""Counts of discarded rows in the state of a stream."""

import time

from pyspark.sql import functions as F

from distributary.streaming.discards import discard_reports


def write_lines(spark, folder, name, n):
    spark.range(n).select(F.col("id").cast("string")).repartition(4).write.text(f"{folder}/in/{name}")


def run(spark, folder, reports, period, enough):
    """Runs the stream until ``enough`` says so of its progress, then stops it."""
    lines = spark.readStream.text(f"{folder}/in/*").where("value % 2 = 0")

    def keep(batch, batch_id):
        reports.extend((batch_id, r.discarded) for r in batch.collect())

    query = discard_reports(lines, period).writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint")
    query = query.trigger(processingTime="200 milliseconds").start()
    try:
        deadline = time.monotonic() + 60
        while not enough(query) and time.monotonic() < deadline:
            assert query.exception() is None
            time.sleep(0.1)
        assert enough(query)
    finally:
        query.stop()


def pending(query):
    progress = query.lastProgress
    return progress["stateOperators"][0]["numRowsTotal"] if progress and progress["stateOperators"] else None


def test_counts_are_pending_over_a_restart_and_reported_once(spark, tmp_path):
    folder, reports = str(tmp_path), []
    write_lines(spark, folder, "a", 100)
    run(spark, folder, reports, 8, lambda query: pending(query) == 1)
    assert reports == []
    write_lines(spark, folder, "b", 20)
    run(spark, folder, reports, 8, lambda query: pending(query) == 0)
    assert [n for _, n in reports] == [60]


def test_silence_is_not_reported(spark, tmp_path):
    folder, reports = str(tmp_path), []
    spark.createDataFrame([("1",), ("3",)], "value string").write.text(f"{folder}/in/a")
    run(spark, folder, reports, 0.1, lambda query: (query.lastProgress or {}).get("batchId", 0) >= 2)
    assert reports == []


def test_each_period_has_its_report(spark, tmp_path):
    folder, reports = str(tmp_path), []
    for name, n in (("a", 10), ("b", 7)):
        write_lines(spark, folder, name, n)
        before = len(reports)
        run(spark, folder, reports, 0.5, lambda query: len(reports) > before)  # noqa: B023
    assert [n for _, n in reports] == [5, 4]
