"""Row counts of running queries, taken while the rows pass: no extra count job.

Rows that came too late are counted where they are dropped, by the operators that keep state. The
removal of duplicates sees events one by one, so its count is of events; an aggregate drops rows that each
task has already added up, so its count is of groups.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


def counted(df: DataFrame, name: str) -> DataFrame:
    """The same rows; their number appears under ``name`` in each progress report."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def counted_batch(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, and where their number (``rows``) appears once a batch job has run."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's newest batches dropped as later than the watermark. A query remembers as many
    batches as ``spark.sql.streaming.numRecentProgressUpdates``; ``RunMetrics`` counts all."""
    return sum(
        state.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for state in progress.stateOperators
    )


class RunMetrics(StreamingQueryListener):
    """Running totals per observed name, and late rows per query (its name, else its id), since the
    listener was added."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self.totals: dict[str, int] = {}
        self.late: dict[str, int] = {}
        self.failures: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            for name, row in event.progress.observedMetrics.items():
                self.totals[name] = self.totals.get(name, 0) + (row["rows"] or 0)
            dropped = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
            query = event.progress.name or str(event.progress.id)
            self.late[query] = self.late.get(query, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            with self._lock:
                self.failures.append(event.exception)
