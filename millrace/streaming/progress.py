"""Progress of streaming queries, kept from their first micro-batch to their last.

A query object remembers its last hundred micro-batches only. A listener gets every one.
"""

from __future__ import annotations

import json
import time
from collections import defaultdict
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """The progress and observed counts of each micro-batch, by run: a few numbers a batch."""

    def __init__(self):
        self.runs: dict[str, list[dict]] = defaultdict(list)
        self.followed: set[str] = set()
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.followed.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        self.runs[str(progress["runId"])].append(progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


_logs: WeakKeyDictionary[SparkSession, ProgressLog] = WeakKeyDictionary()


def follow(spark: SparkSession) -> ProgressLog:
    """The session's progress log; queries started from now on are in it."""
    if spark not in _logs:
        _logs[spark] = ProgressLog()
        spark.streams.addListener(_logs[spark])
    return _logs[spark]


def progress_of(query: StreamingQuery, seconds: float = 30) -> list[dict]:
    """Every micro-batch of a run. Of an ended run it waits until the listener has heard the end."""
    run = str(query.runId)
    log = next((log for log in _logs.values() if run in log.followed), None)
    if log is None:
        return [json.loads(p.json) for p in query.recentProgress]
    until = time.monotonic() + seconds
    while not query.isActive and run not in log.ended and time.monotonic() < until:
        time.sleep(0.02)
    return list(log.runs[run])


def observed_counts(query: StreamingQuery, name: str) -> list[dict]:
    """What a run observed under ``name`` (``DataFrame.observe``), a row for each micro-batch."""
    return [p["observedMetrics"][name] for p in progress_of(query) if name in p.get("observedMetrics", {})]
