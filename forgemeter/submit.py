"""Jobs for ``spark-submit``: ``submit.py ingest|clean|stats [options]``.

* ``ingest``: landed pages to flat events, each id once over all runs (``sources.seen``);
* ``clean``: stream records to clean events, parsed once, from a topic or from ``--records`` files;
* ``stats``: the three statistics over clean events, and with ``--feeds`` their messages.

With ``--once`` a job works on what is there and ends; otherwise it goes on, and starts anew from its
checkpoints after a failure.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from forgemeter import schemas
from forgemeter.plans import statistics
from forgemeter.session import build_session
from forgemeter.sources import changelog, dimensions, kafka, landing, seen
from forgemeter.streaming import feed, jobs, supervise

FEEDS = {changelog.NEW_REPOS: "NewWindow", changelog.PUSH_SPEED: "PushSpeedNewWindow"}
Start = Callable[[], list[StreamingQuery]]


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="submit.py")
    parser.add_argument("job", choices=("ingest", "clean", "stats"))
    parser.add_argument("--input", help="pages of ingest, clean events of stats")
    parser.add_argument("--records", help="landed records in place of the topic")
    parser.add_argument("--output", required=True, help="flat or clean events, or the result tables")
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--rankings", help="language rankings as CSV, by default the fixed ones")
    parser.add_argument("--buckets", type=int, default=seen.BUCKETS)
    parser.add_argument("--files", type=int, help="most files a micro-batch")
    parser.add_argument("--feeds", action="store_true")
    parser.add_argument("--once", action="store_true")
    return parser


def _steps(spark: SparkSession, args: argparse.Namespace) -> list[Start]:
    """What to start, in order; with ``--once`` each waits for the one before."""
    config = jobs.JobConfig(
        tables=args.output,
        checkpoints=args.checkpoints,
        trigger=jobs.BACKFILL if args.once else jobs.LIVE,
    )
    if args.job == "ingest":
        pages = landing.stream_pages(spark, args.input, args.files)
        return [lambda: [jobs.start_page_job(pages, args.output, config, args.buckets)]]
    if args.job == "clean":
        if args.records:
            records = landing.stream_records(spark, args.records, args.files)
        else:
            records = kafka.read_topic(spark)
        events = statistics.clean_events(records)
        return [lambda: [jobs.land_clean_events(events, args.output, config, "clean")]]
    reader = spark.readStream.schema(schemas.CLEAN)
    if args.files:
        reader = reader.option("maxFilesPerTrigger", args.files)
    events = reader.parquet(args.input)
    if args.rankings:
        rankings = dimensions.read_language_rankings(spark, args.rankings)
    else:
        rankings = dimensions.language_rankings(spark)
    steps: list[Start] = [lambda: jobs.start_all(events, rankings, config, publish=args.feeds)]
    if args.feeds:
        steps.append(
            lambda: [
                *[feed.start_feed(spark, args.output, t, kind, config) for t, kind in FEEDS.items()],
                feed.start_language_feed(spark, args.output, config),
            ]
        )
    return steps


def run(spark: SparkSession, args: Sequence[str], max_restarts: int | None = None) -> None:
    options = _parser().parse_args(args)
    if options.job != "clean" and not options.input:
        raise SystemExit(f"{options.job} needs --input")
    steps = _steps(spark, options)
    if options.once:
        for start in steps:
            supervise.await_all(start())
    else:
        supervise.keep_all_running(
            spark, lambda: [query for start in steps for query in start()], max_restarts
        )


def main() -> None:
    run(build_session(), None)


if __name__ == "__main__":
    main()
