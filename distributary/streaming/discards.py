"""Counts of discarded rows as state of a stream: reported once per period, and never where nothing was discarded.

Tasks count their own rows first, so that the state meets one small row per task, however many rows a batch discards.
The pending count lies in the checkpoint of the stream: a batch that is repeated counts once, and a restart goes on with
what was pending. It is reported when its period is over, also if nothing more arrives (a timer of the processing time).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTED = "counter string, n long"
PENDING = "since long, pending long"
REPORTED = "since long, discarded long"


def discard_reports(bad: DataFrame, period_seconds: float = 30.0) -> DataFrame:
    """Stream of reports, ``period_start`` and ``discarded``, of a stream of rows that are dropped.

    A period starts with the first row that is not yet reported. Write the reports in append mode.
    """
    period = max(1, int(period_seconds * 1000))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(batch.num_rows for batch in batches)
        if n:
            yield pa.RecordBatch.from_pydict({"counter": ["all"], "n": [n]})

    def report(key: tuple, frames: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        since, pending = state.get if state.exists else (now, 0)
        if not state.hasTimedOut:
            pending += sum(int(frame["n"].sum()) for frame in frames)
        left = since + period - now
        if pending and (state.hasTimedOut or left <= 0):
            if state.exists:
                state.remove()
            yield pd.DataFrame({"since": [since], "discarded": [pending]})
        elif pending:
            state.update((since, pending))
            state.setTimeoutDuration(left)

    rows = bad.select(F.lit(1).alias("one")).mapInArrow(counted, COUNTED)
    reports = rows.groupBy("counter").applyInPandasWithState(report, REPORTED, PENDING, "append", "ProcessingTimeTimeout")
    return reports.select(F.timestamp_millis("since").alias("period_start"), "discarded")
