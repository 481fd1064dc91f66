"""Running folds over ranges, lists in parts, and the feed of language totals."""

import json

import pytest
from pyspark.sql import functions as F

from forgemeter import schemas
from forgemeter.operators import messages
from forgemeter.operators.scan import with_earlier
from forgemeter.plans import dashboard
from forgemeter.sources import changelog
from forgemeter.streaming import feed, jobs, outbox
from tests.conftest import rows
from tests.test_streaming import config


def numbers(spark):
    # Group "hot" has most rows, one group is null, and a measure is null.
    values = [("hot", i, (i * 7919) % 1000) for i in range(500)]
    values += [(None, i, i) for i in range(5)] + [("one", 3, 9), ("two", 1, None), ("two", 2, 4), ("two", 3, -8)]
    return spark.createDataFrame(values, "g string, at int, n long").repartition(3)


@pytest.mark.parametrize("how", ["sum", "max"])
@pytest.mark.parametrize("descending", [False, True])
def test_running_folds(spark, folder, how, descending):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    order = F.desc("at") if descending else F.asc("at")
    try:
        got = rows(with_earlier(numbers(spark), [order], "n", how, f"{folder}/s", by=["g"]))
        ranges = spark.read.parquet(f"{folder}/s").where("g = 'hot'").select("_range").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranges > 1
    fold, want = {"sum": sum, "max": max}[how], []
    found = rows(numbers(spark))
    for g, at, n in found:
        before = [m for h, b, m in found if h == g and m is not None and (b > at if descending else b < at)]
        want.append((g, at, n, fold(before) if before else None))
    assert got == sorted(want, key=repr)


def test_no_rows(spark, folder):
    none = spark.createDataFrame([], "at int, n long")
    assert rows(with_earlier(none, [F.col("at")], "n", "max", f"{folder}/s")) == []


def languages(spark, count):
    names = spark.range(count).select(F.concat(F.lit("L"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("language"))
    fields = [f for f in schemas.LANGUAGE_STATS if f.name != "language"]
    return names.select("language", *[F.lit("1").cast(f.dataType).alias(f.name) for f in fields])


@pytest.mark.parametrize(("count", "sizes"), [(0, [0]), (4, [4]), (5, [4, 1]), (12, [4, 4, 4])])
def test_lists_in_parts(spark, folder, count, sizes):
    sent = messages.list_messages(languages(spark, count), "LanguageStatsSnapshot", ["language"], f"{folder}/s", part_rows=4)
    found = sorted((json.loads(r.body) for r in sent.collect()), key=lambda m: m.get("part", 1))
    assert [len(m["languages"]) for m in found] == sizes
    names = [e["language"] for m in found for e in m["languages"]]
    assert names == [f"L{i:05d}" for i in range(count)]
    if len(sizes) > 1:
        assert [(m["part"], m["parts"]) for m in found] == [(i + 1, len(sizes)) for i in range(len(sizes))]
    else:
        whole = messages.list_message(languages(spark, count), "LanguageStatsSnapshot", ["language"])
        assert [r.body for r in sent.collect()] == [whole.first().body]
    assert messages.decode_messages(sent, "LanguageStatsSnapshot").count() == count


def test_ties_and_descending(spark, folder):
    rows_ = spark.createDataFrame([("b", 1), ("a", 1), ("a", 1), ("c", 2)], schemas.ACTOR_STATS)
    sent = messages.list_messages(rows_, "ActorStatsSnapshot", ["activity_count"], f"{folder}/s", True, part_rows=3)
    found = sorted((json.loads(r.body) for r in sent.collect()), key=lambda m: m["part"])
    assert [[e["actorLogin"] for e in m["actors"]] for m in found] == [["c", "b", "a"], ["a"]]


def test_a_snapshot_over_the_bound_is_sent(spark, folder):
    changelog.write_batch(languages(spark, 10_001), folder, changelog.LANGUAGE, 0)
    for table in changelog.RESULT_TABLES.values():
        if table is not changelog.LANGUAGE:
            changelog.write_batch(spark.createDataFrame([], table.stored), folder, table, 0)
    sent = dashboard.snapshot_messages(spark, folder).where("type = 'LanguageStatsSnapshot'")
    assert sorted(len(json.loads(r.body)["languages"]) for r in sent.collect()) == [1, 10_000]


def test_language_feed_sends_each_table_once(spark, folder):
    cfg = config(folder)
    root = cfg.tables

    def tick():
        feed.start_language_feed(spark, root, cfg).awaitTermination()

    tick()  # there is no table yet
    changelog.write_batch(languages(spark, 2), root, changelog.LANGUAGE, 3)
    tick()
    tick()
    assert rows(outbox.read_outbox(spark, root), "source", "batch_id") == [(feed.LANGUAGE_FEED, 3)]
    changelog.write_batch(languages(spark, 3), root, changelog.LANGUAGE, 4)
    tick()
    assert rows(outbox.read_outbox(spark, root), "batch_id") == [(3,), (4,)]
    last = outbox.read_outbox(spark, root).where("batch_id = 4")
    assert messages.decode_messages(last, "LanguageStatsSnapshot").count() == 3


def test_language_feed_ticks_by_the_clock(spark, folder):
    cfg = config(folder, trigger={"processingTime": "200 milliseconds"})
    changelog.write_batch(languages(spark, 2), cfg.tables, changelog.LANGUAGE, 0)
    query = feed.start_language_feed(spark, cfg.tables, cfg)
    try:
        import time

        until = time.time() + 60
        while query.lastProgress is None or query.lastProgress["batchId"] < 1:
            assert query.isActive and time.time() < until
            time.sleep(0.2)
    finally:
        query.stop()
    assert rows(outbox.read_outbox(spark, cfg.tables), "source", "batch_id") == [(feed.LANGUAGE_FEED, 0)]
