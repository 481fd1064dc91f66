"""Raw pages to stream records: explode, flatten, drop duplicates, enrich, wrap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemeter.functions.codec import encode_records
from forgemeter.operators.dedup import dedup_events, dedup_stream
from forgemeter.operators.flatten import flatten_events
from forgemeter.operators.lookups import hot_repo_languages, lookup_repo_language
from forgemeter.sources.landing import explode_pages


def flatten_pages(pages: DataFrame, staging: str | None = None) -> DataFrame:
    """Batch: the flat events of landed pages, still with duplicates and without language.

    With ``staging`` (a folder all executors share) they are stored and read back, so that
    the pages are parsed once however often the events are used, and an executor lost
    later costs a re-read.
    """
    flat = flatten_events(explode_pages(pages))
    if staging is None:
        return flat
    flat.write.mode("overwrite").parquet(staging)
    return pages.sparkSession.read.schema(flat.schema).parquet(staging)


def enrich_events(
    flat: DataFrame, repo_languages: DataFrame, spread_hot_repos: bool = False
) -> DataFrame:
    """Batch: the 17-field enriched events, one per event id.

    Of copies the first to arrive stays, where ``arrival`` is known. Duplicates go first, so
    later steps see each event once and its id can spread the rows
    of busy repositories. ``spread_hot_repos`` finds those repositories in a narrow pass of
    its own over ``flat``, which should be stored then. It is for a ``repo_languages`` too
    large to broadcast.
    """
    hot = hot_repo_languages(flat, repo_languages) if spread_hot_repos else None
    if "arrival" in flat.columns:
        once = dedup_events(flat, first_by="arrival").drop("arrival")
    else:
        once = dedup_events(flat)
    return lookup_repo_language(once, repo_languages, hot)


def ingest_pages(
    pages: DataFrame, repo_languages: DataFrame, staging: str | None = None
) -> DataFrame:
    """Batch: ``(key, value)`` records of landed pages; busy repositories are spread when
    there is a ``staging`` folder to find them in."""
    flat = flatten_pages(pages, staging)
    return encode_records(enrich_events(flat, repo_languages, staging is not None))


def ingest_stream(
    pages: DataFrame,
    repo_languages: DataFrame,
    hot: DataFrame | None = None,
    dedup_delay: str = "10 minutes",
) -> DataFrame:
    """Streaming: records of pages as they land.

    An id is remembered for ``dedup_delay`` after it arrived. The clock is that of the batch, which
    the offset log keeps, so no event is ever late, whatever its own time says.
    """
    flat = flatten_events(explode_pages(pages)).withColumn("_seen_at", F.current_timestamp())
    once = dedup_stream(flat, "_seen_at", dedup_delay)
    enriched = lookup_repo_language(once, repo_languages, hot)
    return encode_records(enriched.drop("_seen_at"))
