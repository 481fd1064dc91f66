"""The jobs that spark-submit starts, on landed files."""

import json

import pytest
from pyspark.sql import functions as F

from forgemeter import submit
from forgemeter.plans import catalogue
from forgemeter.sources import changelog, seen
from forgemeter.streaming import supervise
from tests.conftest import SMALL, rows


def test_records_to_tables_and_messages(spark, folder):
    records = catalogue._records(catalogue._canonical(spark, SMALL))
    records.write.parquet(f"{folder}/records")
    where = ["--checkpoints", f"{folder}/checkpoints", "--once"]
    clean = ["clean", "--records", f"{folder}/records", "--output", f"{folder}/clean", *where]
    stats = ["stats", "--input", f"{folder}/clean", "--output", f"{folder}/tables", "--feeds", *where]
    for _ in range(2):  # the second time finds nothing new
        submit.run(spark, clean)
        submit.run(spark, stats)
    found = changelog.read_table(spark, f"{folder}/tables", changelog.ACTOR)
    want = catalogue._actors(spark, SMALL).where("actor_login <> ''")
    assert rows(found) == rows(want, *found.columns)
    sent = spark.read.parquet(f"{folder}/tables/outbox").select("type").distinct()
    assert {r.type for r in sent.collect()} == {
        "NewWindow", "PushSpeedNewWindow", "RepoStatsUpdated", "ActorStatsUpdated",
        "LanguageStatsSnapshot",
    }


def test_pages_to_flat_events(spark, folder, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()

    def land(name, *ids):
        (pages / name).write_text(json.dumps([{"id": i, "type": "PushEvent"} for i in ids]))
        submit.run(spark, [
            "ingest", "--input", str(pages), "--output", f"{folder}/flat", "--buckets", "2",
            "--checkpoints", f"{folder}/checkpoints", "--once",
        ])

    land("one.json", "a", "b", "a")
    land("two.json", "b", "c")
    stored = seen.read_runs(spark, f"{folder}/flat", spark.createDataFrame([], "event_id string").schema)
    assert [i for i, _ in rows(stored, "event_id", "run")] == ["a", "b", "c"]


def test_input_is_asked_for(spark, folder):
    with pytest.raises(SystemExit):
        submit.run(spark, ["stats", "--output", folder, "--checkpoints", folder])


def test_all_start_anew_after_a_failure(spark, folder):
    spark.range(3).write.parquet(f"{folder}/in")
    turns = []

    def start():
        turns.append(len(turns))

        def query(name, fails):
            source = spark.readStream.schema("id long").parquet(f"{folder}/in")
            broken = F.when(F.lit(fails), F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
            return (
                source.select(broken.cast("long").alias("id"))
                .writeStream.option("checkpointLocation", f"{folder}/c-{name}")
                .trigger(availableNow=True)
                .start(f"{folder}/{name}", "parquet")
            )

        return [query("good", False), query("bad", len(turns) == 1)]

    assert supervise.keep_all_running(spark, start, max_restarts=2, sleep=lambda s: None) == 1
    assert turns == [0, 1]
    for name in ("good", "bad"):
        assert sorted(r.id for r in spark.read.parquet(f"{folder}/{name}").collect()) == [0, 1, 2]
