"""Every operator as a query over the given tables: ``name -> (spark, folder) -> DataFrame``.

All queries read whole tables. Times leave as epoch numbers, so results do not depend on
the session time zone. Where a statistic is approximate, the exact form is the one listed,
and a query of its own checks the approximate form against it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgemeter import schemas
from forgemeter.functions import cells, codec, labels
from forgemeter.operators import (
    aggregates,
    dedup,
    flatten,
    lookups,
    messages,
    panes,
    ranking,
    validate,
)
from forgemeter.plans import dashboard, ingest, statistics
from forgemeter.session import new_run_folder
from forgemeter.sources import canonical, changelog, dimensions, landing, seen, tables
from forgemeter.streaming import feed, gate, jobs, metrics, outbox

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the listed queries.
REPO_SCAN, REPO_SHOWN = 40, 20
ACTOR_SCAN, ACTOR_SHOWN = 100, 50
SINCE = 1_705_276_800_000  # 2024-01-15T00:00:00Z
TOLERANCE = 5 * schemas.DISTINCT_RSD
# Ranges in epoch ms: all times, two weeks, one day in them, and half a day from five past an hour.
RANGES = {
    "all": (0, 4_102_444_800_000),
    "fortnight": (1_704_672_000_000, 1_705_881_600_000),
    "day": (1_705_276_800_000, 1_705_363_200_000),
    "half_day": (1_705_280_700_000, 1_705_323_900_000),
}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------------------
# Inputs
# ---------------------------------------------------------------------------


def _canonical(spark: SparkSession, folder: str, types=None) -> DataFrame:
    return canonical.canonical_events(tables.read_table(spark, folder, "events"), types)


def _valid(spark: SparkSession, folder: str) -> DataFrame:
    return validate.keep_valid(_canonical(spark, folder, schemas.KNOWN_TYPES))


def _micros(events: DataFrame) -> DataFrame:
    return events.withColumn("event_us", F.unix_micros("event_ts")).drop("event_ts")


def _records(canon: DataFrame) -> DataFrame:
    """Canonical events as stream records with their time as the record timestamp."""
    envelope = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.lit(schemas.ENVELOPE_SOURCE).alias("source"),
        F.to_json(F.struct(*schemas.PAYLOAD.names)).alias("payload"),
        F.unix_millis("event_ts").alias("timestamp"),
    )
    return canon.select(
        F.col("event_id").cast("string").alias("key"),
        F.to_json(envelope).alias("value"),
        F.col("event_ts").alias("timestamp"),
    )


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """API pages made of the events table: each holds the event and a companion event."""
    events = tables.read_table(spark, folder, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("long")
    )
    number = F.col("event_id").cast("string")
    repo = F.concat(F.lit("org/repo"), F.col("k").cast("string"))
    created = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = F.coalesce(
        F.try_element_at(
            F.create_map(*[F.lit(x) for pair in canonical.TYPE_MAP.items() for x in pair]),
            F.col("event_type"),
        ),
        F.lit("OtherEvent"),
    )

    def event(id_: Column, type_: Column, payload: Column) -> Column:
        return F.struct(
            id_.alias("id"),
            type_.alias("type"),
            F.struct(
                F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login"),
                F.col("user_id").alias("id"),
            ).alias("actor"),
            F.struct(F.col("k").alias("id"), repo.alias("name")).alias("repo"),
            payload.alias("payload"),
            created.alias("created_at"),
        )

    payload = F.struct(
        F.floor("value").cast("int").alias("size"),
        F.concat(F.lit("refs/heads/b"), F.col("k").cast("string")).alias("ref"),
        F.when(F.col("k") % 2 == 0, "branch").otherwise("tag").alias("ref_type"),
        F.when(F.col("k") % 3 == 0, "opened").otherwise("closed").alias("action"),
        F.struct(F.concat(F.lit("fork/"), number).alias("full_name")).alias("forkee"),
        F.struct(F.concat(F.lit("v"), number).alias("tag_name")).alias("release"),
    )
    companion = F.when(F.col("k") % 2 == 0, "CreateEvent").otherwise("IssuesEvent")
    both = F.array(
        event(number, kind, payload),
        event(F.concat(F.lit("c"), number), companion, payload),
    )
    return events.select(F.to_json(both).alias("body"))


def _repo_languages(canon: DataFrame) -> DataFrame:
    return dimensions.repo_languages(canon)


# ---------------------------------------------------------------------------
# Parsing, filters, ingest
# ---------------------------------------------------------------------------


@_query
def clean_events(spark: SparkSession, folder: str) -> DataFrame:
    return _micros(_valid(spark, folder)).select(
        "event_id", "event_type", "actor_login", "repo_name", "trend_weight", "language", "event_us"
    )


@_query
def anomaly_counts(spark: SparkSession, folder: str) -> DataFrame:
    return validate.anomaly_counts(_canonical(spark, folder))


@_query
def envelope_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    records = _records(_canonical(spark, folder))
    decoded = codec.decode_records(records)
    return _micros(decoded)


@_query
def envelope_clean_events(spark: SparkSession, folder: str) -> DataFrame:
    """Decode by the envelope's own time (milliseconds) and validate."""
    records = _records(_canonical(spark, folder))
    clean = statistics.clean_events(records, event_time="envelope")
    return clean.withColumn("event_ms", F.unix_millis("event_ts")).drop("event_ts")


@_query
def raw_event_flatten(spark: SparkSession, folder: str) -> DataFrame:
    flat = flatten.flatten_events(landing.explode_pages(_pages(spark, folder)))
    return flat.drop("ingest_time").withColumns(
        {c: F.col(c).cast("long") for c in ("trend_weight", "push_size")}
    )


@_query
def ingest_records(spark: SparkSession, folder: str) -> DataFrame:
    """Pages to records and back: explode, flatten, dedup, language lookup, envelope."""
    pages = _pages(spark, folder)
    languages = _repo_languages(
        _canonical(spark, folder).withColumn(
            "repo_name", F.regexp_replace("repo_name", "^org[0-9]/", "org/")
        )
    )
    twice = pages.unionByName(pages)
    records = ingest.ingest_pages(twice, languages, new_run_folder(spark, "flat"))
    decoded = records.select(
        "key", F.from_json("value", schemas.ENVELOPE).alias("env")
    ).select("key", F.from_json("env.payload", schemas.ENRICHED).alias("e"))
    return decoded.select(
        "key",
        F.col("e.event_type").alias("event_type"),
        F.col("e.repo_name").alias("repo_name"),
        F.col("e.language").alias("language"),
        F.col("e.trend_weight").cast("long").alias("trend_weight"),
    )


@_query
def trend_weight_lookup(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.read_table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("source_type")
    )
    canon = _canonical(spark, folder).select("event_id", "event_type")
    both = canon.unionByName(events.withColumnRenamed("source_type", "event_type"))
    return both.select(
        "event_id",
        "event_type",
        dimensions.trend_weight(F.col("event_type")).cast("long").alias("weight"),
    )


@_query
def repo_language_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Blank repositories are never looked up, even if the dimension lists one."""
    canon = _canonical(spark, folder)
    blank = spark.range(1).select(
        F.lit("").alias("repo_name"), F.lit("Ghost").alias("language")
    )
    languages = _repo_languages(canon).unionByName(blank)
    events = canon.select(
        "event_id",
        F.when(F.col("actor_login") == "", "").otherwise(F.col("repo_name")).alias("repo_name"),
    )
    hot = lookups.hot_repo_languages(events, languages)
    return lookups.lookup_repo_language(events, languages, hot)


@_query
def dedup_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives twice, the second time changed; the first arrival wins."""
    canon = _micros(_canonical(spark, folder)).withColumn("ingest_us", F.col("event_us"))
    again = canon.withColumns(
        {"ingest_us": F.col("event_us") + 1, "language": F.concat("language", F.lit("-late"))}
    )
    return dedup.dedup_events(again.unionByName(canon), first_by="ingest_us")


@_query
def next_page_link(spark: SparkSession, folder: str) -> DataFrame:
    """Link headers made of the page addresses; every second page is a last page."""
    pages = tables.read_table(spark, folder, "pages").select("page_id", "url")
    more = F.concat(
        F.lit("<"),
        F.col("url"),
        F.lit('?page=1>; rel="prev", <'),
        F.col("url"),
        F.lit('?page=3>; rel="next", <'),
        F.col("url"),
        F.lit('?page=9>; rel="last"'),
    )
    last = F.concat(F.lit("<"), F.col("url"), F.lit('?page=1>; rel="first"'))
    header = F.when(F.length("url") % 2 == 0, more).otherwise(last)
    return pages.select("page_id", labels.next_page_link(header).alias("next_url"))


# ---------------------------------------------------------------------------
# Statistics
# ---------------------------------------------------------------------------


@_query
def repo_stats(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.repo_stats(_valid(spark, folder), exact=True)


def _within_tolerance(approx: str, exact: str, tolerance: float = TOLERANCE) -> Column:
    gap = F.abs(F.col(approx) - F.col(exact))
    return gap <= F.greatest(F.lit(1.0), F.lit(tolerance) * F.col(exact))


@_query
def repo_contributors_approx(spark: SparkSession, folder: str) -> DataFrame:
    """The approximate contributor count is within five standard errors of the exact one."""
    events = _valid(spark, folder)
    counted = events.groupBy("repo_name").agg(
        F.approx_count_distinct("actor_login", schemas.DISTINCT_RSD).alias("approx"),
        F.count_distinct("actor_login").alias("contributor_count"),
    )
    return counted.select(
        "repo_name",
        "contributor_count",
        _within_tolerance("approx", "contributor_count").alias("approx_ok"),
    )


@_query
def actor_stats(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.actor_stats(_valid(spark, folder))


@_query
def window_activity(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.window_activity(_valid(spark, folder), exact=True)


@_query
def window_repos_approx(spark: SparkSession, folder: str) -> DataFrame:
    events = _valid(spark, folder)
    window = F.window("event_ts", schemas.WINDOW_SIZE, schemas.WINDOW_SLIDE)
    counted = events.groupBy(window).agg(
        F.approx_count_distinct("repo_name", schemas.DISTINCT_RSD).alias("approx"),
        F.count_distinct("repo_name").alias("repo_count"),
    )
    return counted.select(
        F.unix_millis("window.start").alias("window_start"),
        "repo_count",
        _within_tolerance("approx", "repo_count").alias("approx_ok"),
    )


@_query
def window_activity_panes(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of an hour every five minutes as merges of twelve panes."""
    return panes.window_activity_panes(
        _valid(spark, folder), exact=True, size="1 hour", slide="5 minutes"
    )


@_query
def new_repos_per_window(spark: SparkSession, folder: str) -> DataFrame:
    activity = aggregates.window_activity(_valid(spark, folder), exact=True)
    return statistics.window_table(activity, "repo_count")


@_query
def push_speed_per_window(spark: SparkSession, folder: str) -> DataFrame:
    activity = aggregates.window_activity(_valid(spark, folder))
    return statistics.window_table(activity, "push_count")


@_query
def language_stats(spark: SparkSession, folder: str) -> DataFrame:
    repos = aggregates.repo_activity(_valid(spark, folder))
    return aggregates.language_stats(repos, dimensions.language_rankings(spark))


@_query
def string_cells_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Actor counts as text cells and back, with the text beside the number."""
    counts = aggregates.actor_stats(_valid(spark, folder))
    text = cells.encode_cells(counts, ["activity_count"]).withColumn(
        "activity_text", F.col("activity_count")
    )
    missing = text.withColumn("absent_count", F.lit(None).cast("string")).withColumn(
        "absent_text", F.lit(None).cast("string")
    )
    return cells.decode_cells(
        missing, numbers=["activity_count", "absent_count"], texts=["absent_text"]
    )


@_query
def result_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The batch job: all five tables written, compacted and read back, as row counts."""
    root = new_run_folder(spark, "tables")
    statistics.build_tables(
        spark, _valid(spark, folder), dimensions.language_rankings(spark), root, exact=True
    )
    changelog.compact(spark, root, changelog.REPO)
    counts = [
        changelog.read_table(spark, root, table)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, table in changelog.RESULT_TABLES.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


# ---------------------------------------------------------------------------
# Serving
# ---------------------------------------------------------------------------


def _repos(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.repo_counters(_valid(spark, folder), exact=True).where("repo_name <> ''")


def _actors(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.actor_stats(_valid(spark, folder)).where("actor_login <> ''")


@_query
def top_repos_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_repos(_repos(spark, folder), REPO_SCAN, REPO_SHOWN)


@_query
def top_repos_global(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_repos(_repos(spark, folder))


@_query
def top_actors_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_actors(_actors(spark, folder), ACTOR_SCAN, ACTOR_SHOWN)


@_query
def top_actors_global(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_actors(_actors(spark, folder))


@_query
def recent_new_repo_windows(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.recent_windows(new_repos_per_window(spark, folder))


@_query
def recent_push_windows(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.recent_windows(push_speed_per_window(spark, folder))


@_query
def windows_since(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.windows_since(push_speed_per_window(spark, folder), SINCE)


def _repo_panel(sort_key: str) -> Query:
    def panel(spark: SparkSession, folder: str) -> DataFrame:
        snapshot = ranking.top_repos(_repos(spark, folder))
        return ranking.repo_panel(snapshot, sort_key)

    panel.__name__ = f"top10_repos_{sort_key}"
    return _query(panel)


for _key in ranking.REPO_ORDERS:
    _repo_panel(_key)


@_query
def top10_contributors(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.contributor_panel(ranking.top_actors(_actors(spark, folder)))


@_query
def top10_languages(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.language_panel(language_stats(spark, folder))


@_query
def overview_totals(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.overview_totals(ranking.top_repos(_repos(spark, folder)))


@_query
def window_panel_new_repos(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.window_panel(new_repos_per_window(spark, folder), zone="UTC")


@_query
def window_panel_push_speed(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.window_panel(push_speed_per_window(spark, folder), zone="UTC")


@_query
def gate_history(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.gate_history(_valid(spark, folder), "1 day")


@_query
def gate_history_fine(spark: SparkSession, folder: str) -> DataFrame:
    """The same for a refresh every five seconds: nearly every event has an interval of its own."""
    return dashboard.gate_history(_valid(spark, folder), "5 seconds")


@_query
def long_language_messages(spark: SparkSession, folder: str) -> DataFrame:
    """A list of languages, two for each event, sent in parts: what each part holds."""
    events = _canonical(spark, folder).withColumn("repo_name", F.col("event_id").cast("string"))
    names = F.explode(F.array(*[F.concat(F.lit(p), F.col("repo_name")) for p in ("lang", "Lang")]))
    named = events.withColumn("language", names).withColumn("repo_name", F.col("language"))
    totals = aggregates.language_stats(
        aggregates.repo_activity(named), dimensions.language_rankings(spark)
    )
    sent = messages.list_messages(
        totals, "LanguageStatsSnapshot", ["language"], new_run_folder(spark, "long")
    )
    shape = "part long, parts long, languages array<struct<language string, totalActivity long>>"
    return sent.select(F.from_json("body", shape).alias("m")).select(
        "m.part",
        "m.parts",
        F.size("m.languages").cast("long").alias("row_count"),
        F.element_at("m.languages.language", 1).alias("first_language"),
        F.element_at("m.languages.language", -1).alias("last_language"),
        F.aggregate(
            "m.languages.totalActivity", F.lit(0).cast("long"), lambda total, n: total + n
        ).alias("total_activity"),
    )


@_query
def server_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The five snapshots as tagged JSON, read from the stored tables."""
    root = new_run_folder(spark, "messages")
    statistics.build_tables(
        spark, _valid(spark, folder), dimensions.language_rankings(spark), root, exact=True
    )
    return dashboard.snapshot_messages(spark, root)


@_query
def window_messages(spark: SparkSession, folder: str) -> DataFrame:
    """One message per window, both kinds, as an incremental reader gets them."""
    activity = aggregates.window_activity(_valid(spark, folder), exact=True)
    kinds = (("NewWindow", "repo_count"), ("PushSpeedNewWindow", "push_count"))
    return messages.all_messages(
        *[
            messages.item_messages(statistics.window_table(activity, measure), kind)
            for kind, measure in kinds
        ]
    )


@_query
def decoded_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Push windows out of a mixed message feed; other kinds are passed over."""
    return messages.decode_messages(window_messages(spark, folder), "PushSpeedNewWindow")


# ---------------------------------------------------------------------------
# Streaming: each runs a real query over the whole table and reads what it stored
# ---------------------------------------------------------------------------


def _stream(spark: SparkSession, folder: str, types=None) -> DataFrame:
    return canonical.canonical_events(tables.stream_table(spark, folder, "events"), types)


def _valid_stream(spark: SparkSession, folder: str) -> DataFrame:
    return validate.keep_valid(_stream(spark, folder, schemas.KNOWN_TYPES))


def _config(spark: SparkSession, name: str) -> jobs.JobConfig:
    run = new_run_folder(spark, name)
    return jobs.JobConfig(
        tables=f"{run}/tables", checkpoints=f"{run}/checkpoints", trigger=jobs.BACKFILL
    )


def _window_run(spark: SparkSession, folder: str) -> jobs.JobConfig:
    config = _config(spark, "windows")
    clean = statistics.clean_events(_records(_stream(spark, folder)))
    jobs.start_window_job(clean, config).awaitTermination()
    return config


@_query
def stream_window_activity(spark: SparkSession, folder: str) -> DataFrame:
    config = _window_run(spark, folder)
    return changelog.read_table(spark, config.tables, changelog.PUSH_SPEED)


def _repo_run(spark: SparkSession, folder: str, **options) -> jobs.JobConfig:
    config = _config(spark, "repos")
    events = _valid_stream(spark, folder)
    rankings = dimensions.language_rankings(spark)
    for _ in range(2):  # the second run finds nothing new on the same checkpoint
        jobs.start_repo_job(events, rankings, config, **options).awaitTermination()
    return config


@_query
def stream_repo_stats(spark: SparkSession, folder: str) -> DataFrame:
    config = _repo_run(spark, folder, language_every=0)
    return changelog.read_latest(spark, config.tables, changelog.REPO).drop("contributor_count")


@_query
def stream_language_stats(spark: SparkSession, folder: str) -> DataFrame:
    config = _repo_run(spark, folder)
    return changelog.read_table(spark, config.tables, changelog.LANGUAGE)


@_query
def stream_repo_updates(spark: SparkSession, folder: str) -> DataFrame:
    """The top list as the gate published it."""
    config = _repo_run(spark, folder, publish=True, language_every=0)
    out = f"{config.tables}/repo_updates"
    newest = gate.published(spark, out)[-1]
    return gate.read_published(spark, out, newest).drop("contributor_count")


@_query
def stream_actor_stats(spark: SparkSession, folder: str) -> DataFrame:
    config = _config(spark, "actors")
    events = _valid_stream(spark, folder)
    jobs.start_actor_job(events, config).awaitTermination()
    return changelog.read_table(spark, config.tables, changelog.ACTOR)


@_query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives twice in one stream and is stored once."""
    config = _config(spark, "dedup")
    twice = _stream(spark, folder).unionByName(_stream(spark, folder))
    once = dedup.dedup_stream(twice, "event_ts", schemas.WATERMARK)
    jobs.land_clean_events(once, f"{config.tables}/once", config).awaitTermination()
    stored = spark.read.schema(once.schema).parquet(f"{config.tables}/once")
    return _micros(stored)


@_query
def stream_incremental_windows(spark: SparkSession, folder: str) -> DataFrame:
    """All windows fed once: the second round finds none after the mark."""
    config = _window_run(spark, folder)
    out = f"{config.tables}/feed"
    for _ in range(2):
        feed.send_new_windows(spark, config.tables, changelog.PUSH_SPEED, out)
    return feed.read_feed(spark, out, changelog.PUSH_SPEED)


@_query
def stream_window_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Push windows as update messages: job, feed and outbox are three chained streams."""
    config = _window_run(spark, folder)
    for _ in range(2):  # the second round has nothing new to send
        feed.start_feed(
            spark, config.tables, changelog.PUSH_SPEED, "PushSpeedNewWindow", config
        ).awaitTermination()
    received = f"{config.tables}/received"
    jobs.land_clean_events(
        outbox.stream_outbox(spark, config.tables), received, config
    ).awaitTermination()
    return spark.read.schema(outbox.SCHEMA).parquet(received).select("type", "body")


@_query
def stream_repo_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The published top list as one message, without the approximate column."""
    config = _repo_run(spark, folder, publish=True, language_every=0)
    sent = outbox.read_outbox(spark, config.tables)
    return messages.decode_messages(sent, "RepoStatsUpdated").drop("contributor_count")


@_query
def stream_all_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All five feeds over one set of tables, received as one stream: per row its kind, key and count
    (that of repositories in a window is approximate, so it is left out)."""
    config = _window_run(spark, folder)
    events, rankings = _valid_stream(spark, folder), dimensions.language_rankings(spark)
    jobs.start_repo_job(events, rankings, config, publish=True).awaitTermination()
    jobs.start_actor_job(events, config, publish=True).awaitTermination()
    for _ in range(2):  # the second round has nothing new to send
        for table, kind in ((changelog.NEW_REPOS, "NewWindow"), (changelog.PUSH_SPEED, "PushSpeedNewWindow")):
            feed.start_feed(spark, config.tables, table, kind, config).awaitTermination()
        feed.start_language_feed(spark, config.tables, config).awaitTermination()
    path = f"{config.tables}/received"
    jobs.land_clean_events(
        outbox.stream_outbox(spark, config.tables), path, config
    ).awaitTermination()
    received = spark.read.schema(outbox.SCHEMA).parquet(path)
    kinds = {
        "NewWindow": ("window_start", F.lit(None).cast("long")),
        "PushSpeedNewWindow": ("window_start", F.col("count")),
        "RepoStatsUpdated": ("repo_name", F.col("activity_count")),
        "ActorStatsUpdated": ("actor_login", F.col("activity_count")),
        "LanguageStatsSnapshot": ("language", F.col("total_activity")),
    }
    found = [
        messages.decode_messages(received, kind).select(
            F.lit(kind).alias("type"), F.col(key).cast("string").alias("key"), count.alias("count")
        )
        for kind, (key, count) in kinds.items()
    ]
    return reduce(DataFrame.unionByName, found)


def _run_in_parts(
    spark: SparkSession,
    events: DataFrame,
    start: Callable[[DataFrame], StreamingQuery],
    parts: int,
) -> None:
    """Land the events in so many parts and run the query after each: one micro-batch a part."""
    landed = new_run_folder(spark, "parts")
    for part in range(parts):
        events.where(F.pmod("event_id", F.lit(parts)) == part).write.mode("append").parquet(landed)
        start(spark.readStream.schema(events.schema).parquet(landed)).awaitTermination()


@_query
def stream_changes_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Every committed change once: four batches, a replay of the last, rows that were never
    committed, and a new checkpoint that counts from the start on the same tables."""
    config = _config(spark, "changes")
    events, table = _valid(spark, folder), changelog.ACTOR
    _run_in_parts(spark, events, lambda s: jobs.start_actor_job(s, config), 4)
    newest = changelog.last_batch(spark, config.tables, table)
    last = changelog.read_batch(spark, config.tables, table, newest, blank_key=True)
    changelog.write_batch(last, config.tables, table, newest)
    changelog.prepare_batch(last, config.tables, table, newest + 1)
    again = replace(config, checkpoints=f"{config.checkpoints}-again")
    _run_in_parts(spark, events, lambda s: jobs.start_actor_job(s, again), 1)
    changes = changelog.stream_changes(spark, config.tables, table)
    jobs.land_clean_events(changes, f"{config.tables}/received", config).awaitTermination()
    return spark.read.schema(changes.schema).parquet(f"{config.tables}/received")


@_query
def stream_language_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Language totals after four batches in which repositories move to other languages, kept by taking
    old rows out and adding new ones, over a base that is folded every second batch."""
    config = replace(_config(spark, "languages"), compact_every=2)
    part = F.col("event_id") % 4
    moved = (
        F.when((part == 2) & F.col("repo_name").endswith("3"), F.lit("Swift"))
        .when((part == 3) & F.col("repo_name").endswith("1"), F.lit("TypeScript"))
        .otherwise(F.col("language"))
    )
    events = _valid(spark, folder).withColumn("language", moved)
    rankings = dimensions.language_rankings(spark)
    _run_in_parts(spark, events, lambda s: jobs.start_repo_job(s, rankings, config), 4)
    return changelog.read_table(spark, config.tables, changelog.LANGUAGE)


def _long_numbers(flat: DataFrame) -> DataFrame:
    return flat.withColumns({c: F.col(c).cast("long") for c in ("trend_weight", "push_size")})


@_query
def ingest_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Pages landed in two runs that share a third of their events, each page twice in its run, and the
    second run again with a new checkpoint. Per id its event and the run that stored it."""
    config = _config(spark, "pages")
    pages, root = _pages(spark, folder), f"{config.tables}/flat"
    number = F.get_json_object("body", "$[0].id").cast("long")
    landed = [new_run_folder(spark, "landed") for _ in range(2)]
    for left_out, path in enumerate(landed):
        part = pages.where(number % 3 != left_out)
        part.unionAll(part).write.parquet(path)
    for run, path in enumerate([*landed, landed[1]]):
        source = spark.readStream.schema(pages.schema).parquet(path)
        settings = replace(config, checkpoints=f"{config.checkpoints}-{run}")
        jobs.start_page_job(source, root, settings, buckets=8).awaitTermination()
    schema = flatten.flatten_events(landing.explode_pages(pages)).schema
    return _long_numbers(seen.read_runs(spark, root, schema).drop("ingest_time"))


@_query
def stream_late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in order of time in three batches, then a tenth of them again under new ids: those older than
    the watermark are dropped and counted. Per day the events stored, and in one row the late ones."""
    config = replace(_config(spark, "late"), watermark="1 day")
    events = _canonical(spark, folder).select("event_id", "event_ts")
    landed, path = new_run_folder(spark, "landed"), f"{config.tables}/accepted"
    again = events.where("event_id % 10 = 0").withColumn("event_id", -1 - F.col("event_id"))
    early, middle = (F.col("event_ts") < F.lit(f"2024-01-{d} 00:00:00").cast("timestamp") for d in (11, 21))
    late = 0
    for part in (events.where(early), events.where(~early & middle), events.where(~middle), again):
        part.write.mode("append").parquet(landed)
        once = dedup.dedup_stream(
            spark.readStream.schema(events.schema).parquet(landed), "event_ts", config.watermark
        )
        query = jobs.land_clean_events(once, path, config, "accepted")
        query.awaitTermination()
        late += metrics.late_rows(query)
    stored = spark.read.schema(events.schema).parquet(path)
    day = F.date_format("event_ts", "yyyy-MM-dd")
    counts = stored.groupBy(day.alias("day")).agg(F.count("*").alias("event_count"))
    dropped = spark.range(1).select(F.lit("late").alias("day"), F.lit(late).cast("long"))
    return counts.unionAll(dropped)


@_query
def contributors_by_range(spark: SparkSession, folder: str) -> DataFrame:
    """Contributors and repositories of overlapping ranges from the sketches that a stream of four
    batches stored, next to the exact counts: within five standard errors, or one."""
    config = _config(spark, "ranges")
    events = _valid(spark, folder)
    _run_in_parts(
        spark, events, lambda s: jobs.start_pane_job(s, replace(config, watermark="3650 days")), 4
    )
    ranges = spark.createDataFrame(
        [(name, start, end) for name, (start, end) in RANGES.items()],
        "range_id string, range_start long, range_end long",
    )
    stored = changelog.read_table(spark, config.tables, changelog.PANES)
    found = panes.estimated(panes.range_states(stored, ranges)).select(
        "range_id", "event_count", "push_count",
        F.col("repo_count").alias("repo_approx"), F.col("contributor_count").alias("actor_approx"),
    )
    inside = events.withColumn("at", F.unix_millis("event_ts")).join(
        F.broadcast(ranges), F.expr("at >= range_start and at < range_end")
    )
    exact = inside.groupBy("range_id").agg(
        F.count_distinct("repo_name").alias("repo_count"),
        F.count_distinct("actor_login").alias("contributor_count"),
    )
    slack = 5 * panes.SKETCH_RSD
    return found.join(exact, "range_id").select(
        "range_id", "event_count", "push_count", "repo_count", "contributor_count",
        (
            _within_tolerance("repo_approx", "repo_count", slack)
            & _within_tolerance("actor_approx", "contributor_count", slack)
        ).alias("approx_ok"),
    )


@_query
def compacted_reads(spark: SparkSession, folder: str) -> DataFrame:
    """Repository totals of a stream of twelve batches, read when threes of them are merged in levels,
    when vacuum has left the merged ones alone, under a lease that vacuum waits for, and when all is
    one base."""
    config = replace(_config(spark, "tiers"), tier_fan=3)
    landed, root, table = new_run_folder(spark, "landed"), config.tables, changelog.REPO
    _valid(spark, folder).repartition(12).write.parquet(landed)
    schema = _valid(spark, folder).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    rankings = dimensions.language_rankings(spark)
    jobs.start_repo_job(stream, rankings, config, language_every=0).awaitTermination()

    def read(state: str, upto: int | None = None) -> DataFrame:
        shown = changelog.read_latest(spark, root, table, upto).drop("contributor_count")
        stored = f"{root}/reads/{state}"
        shown.select(F.lit(state).alias("state"), "*").write.parquet(stored)
        return spark.read.parquet(stored)

    found = [read("merged")]
    for _ in range(2):
        changelog.vacuum(spark, root, table)
    found.append(read("vacuumed"))
    with changelog.lease(spark, root, table) as batch:
        changelog.compact(spark, root, table)
        changelog.vacuum(spark, root, table, keep_bases=1)
        found.append(read("leased", batch))
    changelog.vacuum(spark, root, table, keep_bases=1)
    found.append(read("folded"))
    return reduce(DataFrame.unionByName, found)


@_query
def rebuilt_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Three tables after a run over all events, compaction, and a run with new checkpoints over half
    of them: a key that the second run has shows its rows, any other those of the first."""
    config = _config(spark, "rebuilt")
    events, rankings = _valid(spark, folder), dimensions.language_rankings(spark)
    served = (changelog.REPO, changelog.ACTOR, changelog.LANGUAGE)

    def run(rows: DataFrame, settings: jobs.JobConfig, parts: int) -> None:
        _run_in_parts(spark, rows, lambda s: jobs.start_repo_job(s, rankings, settings), parts)
        _run_in_parts(spark, rows, lambda s: jobs.start_actor_job(s, settings), parts)

    run(events, config, 2)
    for table in served:
        changelog.compact(spark, config.tables, table)
        changelog.vacuum(spark, config.tables, table, keep_bases=1)
    run(
        events.where("event_id % 2 = 0"),
        replace(config, checkpoints=f"{config.checkpoints}-again"),
        1,
    )
    repos, actors, languages = (changelog.read_table(spark, config.tables, t) for t in served)
    none = F.lit(None).cast("long")
    return (
        repos.select(
            F.lit("repo_stats").alias("table_name"), F.col("repo_name").alias("key"),
            "star_count", "fork_count", "push_count", "activity_count",
        )
        .unionAll(actors.select(F.lit("actor_stats"), "actor_login", none, none, none, "activity_count"))
        .unionAll(
            languages.select(
                F.lit("language_stats"), "language", "total_stars", "total_forks", "total_pushes",
                "total_activity",
            )
        )
    )
