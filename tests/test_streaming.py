"""Streams against batch results, late data, replay, gate, feed and supervision."""

import json
import os
import random
import time
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from forgemeter import schemas
from forgemeter.operators import aggregates, dedup, lookups, messages, ranking
from forgemeter.plans import ingest, statistics
from forgemeter.plans.catalogue import _records, _valid
from forgemeter.sources import changelog, dimensions, landing
from forgemeter.streaming import feed, gate, jobs, metrics, outbox, supervise
from tests.conftest import SMALL, rows


def config(folder, **kw):
    return jobs.JobConfig(
        tables=f"{folder}/tables",
        checkpoints=f"{folder}/checkpoints",
        trigger=kw.pop("trigger", jobs.BACKFILL),
        **kw,
    )


def at(text):
    return datetime.fromisoformat(f"2024-01-01T{text}+00:00")


_clock = [1_700_000_000]


def land(spark, folder, values):
    """One file of (actor, repo, time) pushes; later calls give later file times."""
    df = spark.createDataFrame(
        [("PushEvent", a, r, 1, "Go", at(t)) for a, r, t in values], schemas.CLEAN
    )
    before = set(_files(folder))
    df.coalesce(1).write.mode("append").parquet(folder)
    _clock[0] += 10
    for new in set(_files(folder)) - before:
        os.utime(new, (_clock[0], _clock[0]))


def _files(folder):
    if not os.path.isdir(folder):
        return []
    return [os.path.join(folder, f) for f in os.listdir(folder) if f.startswith("part-")]


def clean_stream(spark, folder, per_batch=1):
    return (
        spark.readStream.schema(schemas.CLEAN)
        .option("maxFilesPerTrigger", per_batch)
        .parquet(folder)
    )


def run(query):
    query.awaitTermination()


def test_late_windows_are_dropped(spark, folder):
    source = f"{folder}/in"
    land(spark, source, [("a", "r", "01:00:00")])
    land(spark, source, [("a", "r", "01:01:00")])
    land(spark, source, [("a", "r", "00:50:00"), ("b", "s", "00:47:59"), ("c", "t", "00:52:00")])
    cfg = config(folder)
    run(jobs.start_window_job(clean_stream(spark, source), cfg))
    batches = changelog.committed_batches(spark, cfg.tables, changelog.PUSH_SPEED)
    log = spark.read.parquet(f"{cfg.tables}/push_speed_per_window/log")
    ms = lambda t: int(at(t).timestamp() * 1000)
    third = log.where(f"batch_id = {batches[2]}")
    assert rows(third, "window_start", "count") == [(ms("00:50:00"), 2)]
    # the repository count of the same window went to the other table
    other = changelog.read_table(spark, cfg.tables, changelog.NEW_REPOS)
    assert rows(other.where(F.col("window_start") == ms("00:50:00")), "count") == [(2,)]


def ordered_files(spark, folder, parts=3):
    """The small table as clean events in time-ordered files."""
    events = _valid(spark, SMALL).select(*schemas.CLEAN.names)
    bounds = events.selectExpr("min(event_ts) lo", "max(event_ts) hi").first()
    step = (bounds.hi - bounds.lo) / parts
    for i in range(parts):
        last = i == parts - 1
        chunk = events.where(F.col("event_ts") >= F.lit(bounds.lo + i * step))
        if not last:
            chunk = chunk.where(F.col("event_ts") < F.lit(bounds.lo + (i + 1) * step))
        before = set(_files(folder))
        chunk.orderBy("event_ts").coalesce(1).write.mode("append").parquet(folder)
        _clock[0] += 10
        for new in set(_files(folder)) - before:
            os.utime(new, (_clock[0], _clock[0]))
    return events


def test_stream_equals_batch_over_several_batches(spark, folder):
    source = f"{folder}/in"
    events = ordered_files(spark, source)
    rankings = dimensions.language_rankings(spark)
    cfg = config(folder)
    for query in jobs.start_all(clean_stream(spark, source), rankings, cfg):
        run(query)
    batch = f"{folder}/batch"
    statistics.build_tables(spark, events, rankings, batch)
    assert len(changelog.committed_batches(spark, cfg.tables, changelog.REPO)) == 3
    for table in changelog.RESULT_TABLES.values():
        got = changelog.read_table(spark, cfg.tables, table)
        want = changelog.read_table(spark, batch, table)
        assert rows(got) == rows(want), table.name
        changelog.compact(spark, cfg.tables, table)
        assert rows(changelog.read_table(spark, cfg.tables, table)) == rows(want), table.name


def test_complete_mode_gives_the_same_tables(spark, folder):
    source = f"{folder}/in"
    events = ordered_files(spark, source, parts=2)
    rankings = dimensions.language_rankings(spark)
    cfg = config(folder, output_mode="complete")
    run(jobs.start_repo_job(clean_stream(spark, source), rankings, cfg))
    run(jobs.start_actor_job(clean_stream(spark, source), cfg))
    repos = aggregates.repo_stats(events)
    assert rows(changelog.read_latest(spark, cfg.tables, changelog.REPO)) == rows(repos)
    want = aggregates.language_stats(repos, rankings)
    assert rows(changelog.read_table(spark, cfg.tables, changelog.LANGUAGE)) == rows(want)


def test_restart_emits_nothing_new_and_goes_on(spark, folder):
    source = f"{folder}/in"
    land(spark, source, [("a", "r", "01:00:00")])
    cfg = config(folder)
    start = lambda: jobs.start_actor_job(clean_stream(spark, source), cfg)
    run(start())
    run(start())
    assert changelog.committed_batches(spark, cfg.tables, changelog.ACTOR) == [0]
    land(spark, source, [("a", "r", "01:00:00"), ("b", "r", "01:00:01")])
    run(start())
    assert rows(changelog.read_table(spark, cfg.tables, changelog.ACTOR)) == [("a", 2), ("b", 1)]


def test_failed_sink_is_replayed(spark, folder, monkeypatch):
    source = f"{folder}/in"
    land(spark, source, [("a", "r", "01:00:00")])
    cfg = config(folder)
    real, calls = changelog.write_batch, []

    def flaky(batch, root, table, batch_id):
        calls.append(table.name)
        if len(calls) == 2:
            raise OSError("store unavailable")
        real(batch, root, table, batch_id)

    monkeypatch.setattr(changelog, "write_batch", flaky)
    waits = []
    restarts = supervise.keep_running(
        lambda: jobs.start_window_job(clean_stream(spark, source), cfg),
        max_restarts=2,
        sleep=waits.append,
    )
    assert restarts == 1 and waits == [supervise.RETRY_SECONDS]
    # the first table was written twice under one batch id, and counts once
    for table in (changelog.NEW_REPOS, changelog.PUSH_SPEED):
        assert changelog.committed_batches(spark, cfg.tables, table) == [0]
        assert changelog.read_table(spark, cfg.tables, table).count() == 2


def test_supervision_gives_up(spark, folder):
    source = f"{folder}/in"
    land(spark, source, [("a", "r", "01:00:00")])

    def broken(batch, batch_id):
        raise OSError("never works")

    start = lambda: jobs.start_query(
        clean_stream(spark, source), config(folder), "broken", "append", broken
    )
    waits = []
    with pytest.raises(StreamingQueryException):
        supervise.keep_running(start, max_restarts=2, sleep=waits.append)
    assert len(waits) == 2


def test_empty_batches_write_nothing(spark, folder):
    source = f"{folder}/in"
    land(spark, source, [])
    land(spark, source, [("a", "r", "01:00:00")])
    cfg = config(folder)
    run(jobs.start_window_job(clean_stream(spark, source, 1), cfg))
    assert changelog.read_table(spark, cfg.tables, changelog.PUSH_SPEED).count() == 2


@pytest.mark.parametrize("spread", [False, True])
def test_stream_dedup_across_batches(spark, folder, spread):
    source = f"{folder}/in"
    schema = "event_id STRING, event_ts TIMESTAMP"
    for batch in (["1", "1", "2"], ["2", "3"]):
        df = spark.createDataFrame([(i, at("01:00:00")) for i in batch], schema)
        df.coalesce(1).write.mode("append").parquet(source)
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    )
    once = dedup.dedup_stream(stream, "event_ts", "10 minutes", spread_copies=spread)
    assert once.columns == stream.columns
    run(jobs.land_clean_events(once, f"{folder}/out", config(folder)))
    assert rows(spark.read.parquet(f"{folder}/out"), "event_id") == [("1",), ("2",), ("3",)]


def test_ingest_stream(spark, folder):
    os.makedirs(f"{folder}/pages")
    for i in range(2):
        page = [
            {
                "id": str(j),
                "type": "PushEvent",
                "created_at": "2024-01-01T00:00:00Z" if j else "",
                "actor": {"login": "ann"},
                "repo": {"name": "o/r" if j % 2 else ""},
            }
            for j in range(4)
        ]
        with open(f"{folder}/pages/{i}.json", "w") as out:
            json.dump(page, out)
    languages = spark.createDataFrame([("o/r", "Go")], schemas.REPO_LANGUAGES)
    hot = lookups.hot_repo_languages(
        spark.createDataFrame([("o/r",)], "repo_name STRING"), languages
    )
    for turn, known in enumerate((None, hot)):
        stream = landing.stream_pages(spark, f"{folder}/pages", max_files_per_trigger=1)
        records = ingest.ingest_stream(stream, languages, known)
        run(
            records.writeStream.format("parquet")
            .option("path", f"{folder}/records{turn}")
            .option("checkpointLocation", f"{folder}/chk{turn}")
            .trigger(availableNow=True)
            .start()
        )
        got = spark.read.parquet(f"{folder}/records{turn}").collect()
        events = {r.key: json.loads(json.loads(r.value)["payload"]) for r in got}
        assert len(got) == 4 == len(events)
        assert [events[str(j)]["language"] for j in range(4)] == ["", "Go", "", "Go"]


def test_record_files_feed_the_statistics(spark, folder):
    from forgemeter.plans.catalogue import _canonical

    landing.write_records(_records(_canonical(spark, SMALL)), f"{folder}/records")
    assert landing.read_records(spark, f"{folder}/records").count() == 1000
    stream = landing.stream_records(spark, f"{folder}/records", max_files_per_trigger=100)
    cfg = config(folder)
    run(jobs.land_clean_events(statistics.clean_events(stream), f"{folder}/clean", cfg))
    landed = spark.read.schema(schemas.CLEAN).parquet(f"{folder}/clean")
    assert rows(landed) == rows(_valid(spark, SMALL).select(*schemas.CLEAN.names))


# -- gate and feed ---------------------------------------------------------


def tops(spark, **counts):
    return spark.createDataFrame(list(counts.items()), schemas.ACTOR_STATS)


def test_gate_sends_only_growth(spark, folder):
    out = f"{folder}/updates"
    send = lambda batch, **c: gate.publish_if_grown(tops(spark, **c), out, batch)
    assert not send(0)  # nothing to show
    assert send(1, ann=3, bob=1)
    assert not send(2, ann=3, bob=3)  # others grew, the greatest did not
    assert send(3, ann=3, bob=4)
    assert send(1, ann=3, bob=1)  # a replay decides as before
    assert gate.published(spark, out) == [1, 3]
    assert rows(gate.read_published(spark, out, 3)) == [("ann", 3), ("bob", 4)]


def test_published_updates_follow_the_stream(spark, folder):
    source = f"{folder}/in"
    land(spark, source, [("a", "r", "01:00:00"), ("a", "r", "01:00:00")])
    land(spark, source, [("a", "s", "01:00:00")])
    land(spark, source, [("a", "r", "01:00:00")])
    cfg = config(folder)
    rankings = dimensions.language_rankings(spark)
    run(jobs.start_repo_job(clean_stream(spark, source), rankings, cfg, publish=True))
    run(jobs.start_actor_job(clean_stream(spark, source), cfg, publish=True, scan_limit=2))
    assert gate.published(spark, f"{cfg.tables}/repo_updates") == [0, 2]
    newest = gate.read_published(spark, f"{cfg.tables}/repo_updates", 2)
    assert rows(newest, "repo_name", "activity_count") == [("r", 3), ("s", 1)]
    assert gate.published(spark, f"{cfg.tables}/actor_updates") == [0, 1, 2]


def test_rolling_top_equals_the_whole_table(spark, folder):
    """Random growing counts with ties: the rolling list is the list over all keys."""
    rng = random.Random(7)
    totals = {}
    for batch in range(6):
        changed = {f"u{rng.randint(0, 30):02d}": rng.randint(1, 3) for _ in range(8)}
        for name, n in changed.items():
            totals[name] = totals.get(name, 0) + n
        rank = lambda df: ranking.top_actors(df, None, 5)
        got = gate.rolling_top(
            tops(spark, **{n: totals[n] for n in changed}),
            f"{folder}/top",
            batch,
            "actor_login",
            rank,
            lambda: tops(spark, **totals),
            keep=2,
        )
        want = sorted(totals.items(), key=lambda e: (e[1], e[0]), reverse=True)[:5]
        assert rows(got) == sorted(want, key=repr)
    assert len(gate.published(spark, f"{folder}/top")) <= 4


def window(spark, start, count):
    df = spark.createDataFrame(
        [(start, start + 600_000, count)], "window_start BIGINT, window_end BIGINT, n BIGINT"
    )
    return statistics.window_table(df, "n")


def test_feed_sends_each_window_once(spark, folder):
    out, table = f"{folder}/feed", changelog.NEW_REPOS
    assert feed.send_new_windows(spark, folder, table, out) is None
    assert feed.read_feed(spark, out, table).count() == 0
    changelog.write_batch(window(spark, 300_000, 1), folder, table, 0)
    assert feed.send_new_windows(spark, folder, table, out) == 0
    changelog.write_batch(window(spark, 300_000, 9), folder, table, 1)  # grew: not sent again
    assert feed.send_new_windows(spark, folder, table, out) is None
    changelog.write_batch(window(spark, 600_000, 2), folder, table, 2)
    assert feed.send_new_windows(spark, folder, table, out) == 1
    assert feed.send_new_windows(spark, folder, table, out, turn=1) == 1  # a replay
    got = feed.read_feed(spark, out, table)
    assert rows(got, "round", "window_start", "count") == [(0, 300_000, 1), (1, 600_000, 2)]
    assert feed.last_seen(spark, out) == 600_000


def test_outbox_joins_all_feeds(spark, folder):
    source = f"{folder}/in"
    land(spark, source, [("a", "r", "01:00:00")])
    land(spark, source, [("a", "r", "01:00:01"), ("b", "r", "01:05:00")])
    cfg = config(folder)
    for query in jobs.start_all(clean_stream(spark, source), dimensions.language_rankings(spark), cfg):
        run(query)
    for table, kind in (
        (changelog.NEW_REPOS, "NewWindow"),
        (changelog.PUSH_SPEED, "PushSpeedNewWindow"),
    ):
        run(feed.start_feed(spark, cfg.tables, table, kind, cfg))
    query = (
        outbox.stream_outbox(spark, cfg.tables)
        .writeStream.format("memory")
        .queryName("outbox_seen")
        .trigger(availableNow=True)
        .start()
    )
    run(query)
    seen = spark.table("outbox_seen")
    kinds = {r.type: r["count"] for r in seen.groupBy("type").count().collect()}
    assert kinds == {
        "NewWindow": 3,
        "PushSpeedNewWindow": 3,
        "RepoStatsUpdated": 2,
        "ActorStatsUpdated": 2,
    }
    lists = messages.decode_messages(
        seen.where("batch_id = 1"), "ActorStatsUpdated"
    )
    assert rows(lists) == [("a", 2), ("b", 1)]


def test_language_refresh_on_its_own_schedule(spark, folder):
    source = f"{folder}/in"
    rankings = dimensions.language_rankings(spark)
    assert jobs.refresh_languages(spark, f"{folder}/tables", rankings) is None
    land(spark, source, [("a", "r", "01:00:00")])
    cfg = config(folder)
    run(jobs.start_repo_job(clean_stream(spark, source), rankings, cfg, language_every=0))
    assert changelog.read_table(spark, cfg.tables, changelog.LANGUAGE).count() == 0
    assert jobs.refresh_languages(spark, cfg.tables, rankings) == 0
    row = changelog.read_table(spark, cfg.tables, changelog.LANGUAGE).first()
    assert (row.language, row.tier, row.total_pushes, row.repo_count) == ("Go", "1", 1, 1)


# -- metrics and waiting ---------------------------------------------------


def test_run_metrics(spark, folder):
    source = f"{folder}/in"
    land(spark, source, [("a", "r", "01:00:00")])
    land(spark, source, [("b", "r", "01:00:00"), ("c", "r", "01:00:00")])
    listener = metrics.RunMetrics()
    spark.streams.addListener(listener)
    try:
        stream = metrics.counted(clean_stream(spark, source), "sent")
        run(jobs.land_clean_events(stream, f"{folder}/out", config(folder)))
        deadline = time.time() + 20
        while listener.totals.get("sent", 0) < 3 and time.time() < deadline:
            time.sleep(0.1)
        assert listener.totals["sent"] == 3
    finally:
        spark.streams.removeListener(listener)


def test_batch_metrics(spark):
    df, seen = metrics.counted_batch(spark.range(7))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7}


def test_live_trigger_and_await_any(spark, folder):
    source = f"{folder}/in"
    land(spark, source, [("a", "r", "01:00:00")])
    cfg = config(folder, trigger={"processingTime": "1 second"})
    query = jobs.start_actor_job(clean_stream(spark, source), cfg)
    try:
        query.processAllAvailable()
        assert rows(changelog.read_table(spark, cfg.tables, changelog.ACTOR)) == [("a", 1)]
    finally:
        query.stop()
    spark.streams.resetTerminated()
    done = jobs.start_actor_job(clean_stream(spark, source), config(folder))
    supervise.await_any(spark)
    assert not done.isActive
    supervise.await_all([done])
