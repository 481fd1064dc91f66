"""Waiting for queries and restarting them from their checkpoints."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)
RETRY_SECONDS = 5.0
LOOK_SECONDS = 60  # how long a failure just before the wait may go unseen


def await_any(spark: SparkSession) -> None:
    """Block until one of the session's queries ends; raises if it failed."""
    spark.streams.awaitAnyTermination()


def await_all(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()


def keep_running(
    start: Callable[[], StreamingQuery],
    max_restarts: int | None = None,
    delay_seconds: float = RETRY_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Run a query to its end, starting it anew after each failure; returns the restarts.

    ``start`` must use the same checkpoint each time, so that a restart goes on where the
    last committed batch ended.
    """
    restarts = 0
    while True:
        try:
            start().awaitTermination()
            return restarts
        except StreamingQueryException as failure:
            if max_restarts is not None and restarts >= max_restarts:
                raise
            restarts += 1
            log.warning("query failed, restart %d in %ss: %s", restarts, delay_seconds, failure)
            sleep(delay_seconds)


def keep_all_running(
    spark: SparkSession,
    start: Callable[[], Sequence[StreamingQuery]],
    max_restarts: int | None = None,
    delay_seconds: float = RETRY_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Run queries that belong together until all end. When one fails the others are stopped too, and all
    start anew from their checkpoints; returns the restarts."""
    restarts = 0
    while True:
        queries = []
        try:
            queries = list(start())
            while any(query.isActive for query in queries):
                await_all([query for query in queries if not query.isActive])  # raises if one failed
                spark.streams.resetTerminated()
                spark.streams.awaitAnyTermination(LOOK_SECONDS)
            await_all(queries)
            return restarts
        except StreamingQueryException as failure:
            for query in queries:
                query.stop()
            if max_restarts is not None and restarts >= max_restarts:
                raise
            restarts += 1
            log.warning("a query failed, restart %d in %ss: %s", restarts, delay_seconds, failure)
            sleep(delay_seconds)
