"""Sinks of bad rows. A sink is called with the bad rows of a batch (column ``value``) and its id."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

BadSink = Callable[[DataFrame, int], None]

log = logging.getLogger("distributary")


class DiscardingSink:
    """Counts bad rows and drops them; what was dropped is reported once per period, silence is not.

    A timer reports at the end of the period even if nothing more arrives.
    """

    def __init__(
        self,
        period_seconds: float = 30.0,
        clock: Callable[[], float] = time.monotonic,
        timer: Callable[..., threading.Timer] = threading.Timer,
    ):
        self.period = period_seconds
        self.clock = clock
        self.timer = timer
        self.waiting: threading.Timer | None = None
        self.lock = threading.RLock()
        self.since = clock()
        self.pending = 0
        self.total = 0
        self.reports: list[int] = []

    def __call__(self, bad: DataFrame, batch_id: int) -> None:
        self.add(bad.count())

    def add(self, count: int) -> None:
        with self.lock:
            self.pending += count
            self.total += count
            left = self.since + self.period - self.clock()
            if left <= 0:
                self.report()
            elif self.pending and self.waiting is None:
                self.waiting = self.timer(left, self.report)
                self.waiting.daemon = True
                self.waiting.start()

    def report(self) -> None:
        with self.lock:
            if self.waiting is not None:
                self.waiting.cancel()
                self.waiting = None
            if self.pending:
                log.info("Discarded %d bad rows during the last %gs", self.pending, self.period)
                self.reports.append(self.pending)
            self.pending = 0
            self.since = self.clock()


def text_sink(path: str) -> BadSink:
    """JSON lines appended under a path; what is there is never replaced, whoever wrote it."""

    def write(bad: DataFrame, batch_id: int) -> None:
        bad.select("value").write.mode("append").text(path)

    return write


def broker_sink(
    servers: str, topic: str, max_bytes: int = 5_000_000, linger_ms: int = 200
) -> BadSink:
    """Messages to a topic, sent in batches bounded by size and time; needs Spark's Kafka package."""

    def write(bad: DataFrame, batch_id: int) -> None:
        writer = bad.select("value").write.format("kafka")
        writer = writer.option("kafka.batch.size", str(max_bytes)).option("kafka.linger.ms", str(linger_ms))
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return write
