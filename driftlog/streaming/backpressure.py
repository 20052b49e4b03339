"""Backpressure: the size of micro-batches follows the rate at which they are processed.

Spark's sources take a fixed cap. Here each progress report of a query gives
an estimator the rows of a batch, the time its processing took and the time
around it; from the smoothed rate follows the cap at which the next batch
should last no longer than the trigger interval.

* A source that looks its cap up at each batch (``sources.archive`` with a
  control file) is steered by ``Backpressure``, a listener.
* A source whose cap is fixed while a query runs (Kafka's
  ``maxOffsetsPerTrigger``) is steered by ``run_regulated``, which starts the
  query again from its checkpoint when the cap is off by more than a factor.

Either way only the division into batches changes: every record is read once.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from driftlog.sources.archive import write_control


class RateEstimator:
    """Next cap from the batches seen so far.

    ``trigger_seconds``: how long a batch may last. ``headroom``: share of that
    time to plan for. ``smoothing``: weight of the newest rate. The cap at
    most doubles from batch to batch, may fall at once, and stays within
    ``[least, most]``.
    """

    def __init__(self, trigger_seconds: float, cap: int, least: int = 100, most: int = 1 << 40, headroom: float = 0.8,
                 smoothing: float = 0.5):
        if not (0 < least <= cap <= most) or trigger_seconds <= 0 or not 0 < headroom <= 1 or not 0 < smoothing <= 1:
            raise ValueError("0 < least <= cap <= most, positive trigger_seconds, headroom and smoothing in (0, 1]")
        self.trigger_seconds, self.cap, self.least, self.most = trigger_seconds, cap, least, most
        self.headroom, self.smoothing = headroom, smoothing
        self.rate: float | None = None     # rows a second of processing
        self.around = 0.0                  # seconds a batch takes besides

    def update(self, rows: int, processing: float, whole: float) -> int:
        """Take in a batch (``processing`` of its ``whole`` seconds went into its rows); the cap for the next one."""
        if rows > 0 and processing > 0:
            rate, around = rows / processing, max(0.0, whole - processing)
            new = self.smoothing if self.rate is not None else 1.0
            self.rate = new * rate + (1 - new) * (self.rate or 0.0)
            self.around = new * around + (1 - new) * self.around
            time_left = max(self.headroom * self.trigger_seconds - self.around, 0.0)
            wanted = min(self.rate * time_left, 2.0 * self.cap)
            self.cap = int(min(max(wanted, self.least), self.most))
        return self.cap

    def report(self, progress: dict) -> int:
        """``update`` from a progress report."""
        took = progress.get("durationMs") or {}
        whole = took.get("triggerExecution", 0) / 1000
        return self.update(progress.get("numInputRows") or 0, took.get("addBatch", 0) / 1000, whole)


class Backpressure(StreamingQueryListener):
    """Writes the estimator's cap into the control file after each batch of a named query."""

    def __init__(self, name: str, control: str, estimator: RateEstimator):
        self.name, self.control, self.estimator = name, control, estimator
        self.caps: list[int] = []
        write_control(control, estimator.cap)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name != self.name or not event.progress.numInputRows:
            return
        before = self.estimator.cap
        cap = self.estimator.report(json.loads(event.progress.json))
        self.caps.append(cap)
        if cap != before:
            write_control(self.control, cap)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def regulate(spark: SparkSession, name: str, control: str, estimator: RateEstimator) -> Backpressure:
    """Steer the query called ``name`` through a control file; remove the listener when the query has ended."""
    listener = Backpressure(name, control, estimator)
    spark.streams.addListener(listener)
    return listener


def run_regulated(start: Callable[[int], StreamingQuery], estimator: RateEstimator, factor: float = 1.5,
                  poll_seconds: float = 0.5, ended: Callable[[StreamingQuery], bool] = lambda query: False) -> StreamingQuery:
    """Keep a query running whose source has a fixed cap.

    ``start(cap)`` starts it from its checkpoint. When the estimator's cap has
    moved by more than ``factor``, the query is stopped between two batches
    and started with the new one. Returns the query when it ends by itself or
    ``ended`` says so (it is stopped then); a failed query raises.
    """
    cap = estimator.cap
    query, seen = start(cap), -1
    while True:
        if query.awaitTermination(poll_seconds):
            return query
        for progress in query.recentProgress:
            if progress["batchId"] > seen:
                seen = progress["batchId"]
                estimator.report(progress)
        done = ended(query)
        ratio = estimator.cap / cap
        if done or ratio > factor or ratio < 1 / factor:
            for _ in range(100):     # between batches, if one ends soon; a batch cut short is replayed
                if not query.status["isTriggerActive"]:
                    break
                time.sleep(0.05)
            query.stop()
            if done:
                return query
            cap = estimator.cap
            query = start(cap)
