"""Cases found in review: each lost or changed rows before."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from forgemeter.operators.messages import decode_messages
from forgemeter.operators.flatten import flatten_events
from forgemeter.operators.ranking import top_actors
from forgemeter.plans import ingest
from forgemeter.sources import changelog, landing
from forgemeter.sources.canonical import utc_instant
from forgemeter.streaming.gate import rolling_top
from tests.conftest import rows


def event(i, created_at="2024-01-01T00:00:00Z", login="a"):
    return {"id": str(i), "type": "PushEvent", "created_at": created_at, "actor": {"login": login}}


def test_stream_keeps_events_of_any_age(spark, folder, tmp_path):
    batches = [
        [event(1), event(2, "2024-01-01T00:30:00Z")],
        [event(3, "2023-12-31T00:00:00Z"), event(1)],
        [event(4, "no time")],
        [event(5, "2024-01-01T00:15:00Z"), event(2)],
    ]
    pages = tmp_path / "pages"
    pages.mkdir()
    for i, page in enumerate(batches):
        (pages / f"{i}.json").write_text(json.dumps(page))
    languages = spark.createDataFrame([("x", "Rust")], "repo_name string, language string")
    stream = landing.stream_pages(spark, f"file://{pages}", max_files_per_trigger=1)
    query = (
        ingest.ingest_stream(stream, languages)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination(120)
    got = [r.key for r in spark.read.parquet(f"{folder}/out").collect()]
    assert sorted(got) == ["1", "2", "3", "4", "5"]


def test_odd_elements_and_bodies(spark):
    bodies = [
        '[{"id":"1","type":"PushEvent"}, 5, null, "x", [], {"id":"2"}]',
        '{"id":"9","type":"PushEvent"}',
        "[",
        None,
        ' \n[{"id":"3","actor":7},{"id":"4"}]',
    ]
    pages = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = rows(flatten_events(landing.explode_pages(pages)), "event_id")
    assert [r[0] for r in got if r[0] != "3"] == ["1", "2", "4"]


def test_first_copy_stays(spark, tmp_path):
    for name, login in (("a", "first"), ("b", "second")):
        (tmp_path / f"{name}.json").write_text(json.dumps([event(1, login=login), event(1, login="x")]))
    flat = ingest.flatten_pages(landing.read_pages(spark, f"file://{tmp_path}"))
    at = F.struct(F.lit(0).alias("landed_at"), F.col("arrival.page"), F.col("arrival.place"))
    languages = spark.createDataFrame([("x", "Rust")], "repo_name string, language string")
    kept = ingest.enrich_events(flat.withColumn("arrival", at), languages)
    assert rows(kept, "event_id", "actor_login") == [("1", "first")]


def test_message_without_its_item(spark):
    found = spark.createDataFrame([('{"type":"PushSpeedNewWindow"}',)], "body string")
    assert decode_messages(found, "PushSpeedNewWindow").isEmpty()


def test_instants_where_an_hour_comes_twice(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        wall = spark.sql(
            "select explode(array(timestamp_ntz'2024-11-03 05:30:00', timestamp_ntz'2024-11-03 06:30:00')) t"
        )
        got = wall.select(F.unix_micros(utc_instant(F.col("t"), "America/New_York")).alias("m")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    start = int(dt.datetime(2024, 11, 3, 5, 30, tzinfo=dt.UTC).timestamp()) * 1_000_000
    assert sorted(r.m for r in got) == [start, start + 3_600_000_000]


def actors(spark, *pairs):
    return spark.createDataFrame(pairs, "actor_login string, activity_count long")


def test_reading_before_the_oldest_base_is_an_error(spark, folder):
    table = changelog.ACTOR
    for i in range(3):
        changelog.write_batch(actors(spark, ("a", i + 1), (f"b{i}", 1)), folder, table, i)
        changelog.compact(spark, folder, table)
    assert changelog.read_latest(spark, folder, table, upto=0).count() == 2
    changelog.vacuum(spark, folder, table, keep_bases=1)
    with pytest.raises(ValueError):
        changelog.read_latest(spark, folder, table, upto=1)
    assert changelog.read_latest(spark, folder, table).count() == 4


def test_top_list_after_a_gap(spark, folder):
    whole = actors(spark, ("a", 2), ("b", 50))

    def top(batch_id, changed, table, committed):
        return rolling_top(
            changed, f"{folder}/top", batch_id, "actor_login", top_actors, lambda: table,
            committed=committed,
        )

    top(0, actors(spark, ("a", 1)), actors(spark, ("a", 1)), [0])
    got = top(2, actors(spark, ("a", 2)), whole, [0, 1, 2])
    assert rows(got, "actor_login", "activity_count") == [("a", 2), ("b", 50)]


def test_rebuilt_tables_are_served(spark, folder):
    table = changelog.ACTOR
    changelog.write_batch(actors(spark, ("u", 1)), folder, table, changelog.next_batch(spark, folder))
    changelog.write_batch(actors(spark, ("u", 1)), folder, table, changelog.next_batch(spark, folder))
    changelog.compact(spark, folder, table)
    with pytest.raises(ValueError):
        changelog.write_batch(actors(spark, ("u", 5)), folder, table, 0)
    for _ in range(2):
        new = changelog.next_batch(spark, folder)
        changelog.write_batch(actors(spark, ("u", 2), ("v", 9)), folder, table, new)
        changelog.compact(spark, folder, table)
    got = rows(changelog.read_table(spark, folder, table), "actor_login", "activity_count")
    assert got == [("u", 2), ("v", 9)]
