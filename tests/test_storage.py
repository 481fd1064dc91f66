"""Keyed tables, catalog and topic options."""

import os

import pytest

from forgemeter import schemas, session
from forgemeter.plans import statistics
from forgemeter.sources import catalog, changelog, kafka, storage
from tests.conftest import rows


def actors(spark, **counts):
    return spark.createDataFrame(list(counts.items()), schemas.ACTOR_STATS)


def read(spark, root, table=changelog.ACTOR, **kw):
    return rows(changelog.read_table(spark, root, table, **kw))


def test_last_write_of_a_key_wins(spark, folder):
    write = lambda batch, **c: changelog.write_batch(actors(spark, **c), folder, changelog.ACTOR, batch)
    assert read(spark, folder) == []
    write(0, ann=1, bob=1)
    write(2, ann=5)
    write(10, cid=7)  # numeric, not text, order of batches
    assert read(spark, folder) == [("ann", 5), ("bob", 1), ("cid", 7)]
    assert read(spark, folder, upto=1) == [("ann", 1), ("bob", 1)]
    assert changelog.committed_batches(spark, folder, changelog.ACTOR) == [0, 2, 10]


def test_replay_replaces_its_own_rows_only(spark, folder):
    changelog.write_batch(actors(spark, ann=1, bob=1), folder, changelog.ACTOR, 0)
    changelog.write_batch(actors(spark, ann=2), folder, changelog.ACTOR, 1)
    changelog.write_batch(actors(spark, ann=2), folder, changelog.ACTOR, 1)
    changelog.write_batch(actors(spark, ann=1, bob=1), folder, changelog.ACTOR, 0)
    assert read(spark, folder) == [("ann", 2), ("bob", 1)]


def test_half_written_batch_is_not_seen(spark, folder):
    changelog.write_batch(actors(spark, ann=1), folder, changelog.ACTOR, 0)
    changelog.write_batch(actors(spark, ann=9), folder, changelog.ACTOR, 1)
    os.remove(f"{folder}/actor_stats/log/batch_id=1/_SUCCESS")
    assert read(spark, folder) == [("ann", 1)]


def test_blank_key_is_stored_but_not_shown(spark, folder):
    changelog.write_batch(actors(spark, **{"": 3, "ann": 1}), folder, changelog.ACTOR, 0)
    assert read(spark, folder) == [("ann", 1)]
    assert changelog.read_latest(spark, folder, changelog.ACTOR).count() == 2


def test_null_cell_overwrites(spark, folder):
    cols = [*schemas.REPO_STATS.names, "event_language"]
    row = lambda lang: spark.createDataFrame([("a", 1, 1, 1, 1, 1, 1, lang)], schemas.REPO_LOG).select(*cols)
    changelog.write_batch(row("Go"), folder, changelog.REPO, 0)
    changelog.write_batch(row(None), folder, changelog.REPO, 1)
    assert changelog.read_latest(spark, folder, changelog.REPO).first().event_language is None


def languages(spark, *names):
    return spark.createDataFrame(
        [(n, "1", "p", "t", 1, 1, 1, 1, 1) for n in names], schemas.LANGUAGE_STATS
    )


def test_replacing_table_holds_the_newest_batch_only(spark, folder):
    for batch, names in ((0, ("Go", "Java")), (1, ("Go",))):
        changelog.write_batch(languages(spark, *names), folder, changelog.LANGUAGE, batch)
    assert [r[0] for r in read(spark, folder, changelog.LANGUAGE)] == ["Go"]
    changelog.compact(spark, folder, changelog.LANGUAGE)
    assert [r[0] for r in read(spark, folder, changelog.LANGUAGE)] == ["Go"]


def test_compaction_and_vacuum_change_no_result(spark, folder):
    write = lambda batch, **c: changelog.write_batch(actors(spark, **c), folder, changelog.ACTOR, batch)
    write(0, ann=1, bob=1)
    write(1, ann=2)
    assert changelog.compact(spark, folder, changelog.ACTOR) == 1
    assert changelog.compact(spark, folder, changelog.ACTOR) == 1
    assert read(spark, folder) == [("ann", 2), ("bob", 1)]
    write(2, bob=4)
    assert read(spark, folder) == [("ann", 2), ("bob", 4)]
    write(1, ann=2)  # a replay of a batch that is in the base
    changelog.vacuum(spark, folder, changelog.ACTOR, keep_bases=1)
    assert changelog.committed_batches(spark, folder, changelog.ACTOR) == [2]
    assert read(spark, folder) == [("ann", 2), ("bob", 4)]
    changelog.compact(spark, folder, changelog.ACTOR)
    changelog.vacuum(spark, folder, changelog.ACTOR, keep_bases=1)
    assert os.listdir(f"{folder}/actor_stats/base") == ["upto=2"]
    assert changelog.last_batch(spark, folder, changelog.ACTOR) == 2
    assert read(spark, folder) == [("ann", 2), ("bob", 4)]


def windows(spark, *starts):
    df = spark.createDataFrame(
        [(s, s + 600_000, 1, 2) for s in starts],
        "window_start BIGINT, window_end BIGINT, repo_count BIGINT, push_count BIGINT",
    )
    return statistics.window_table(df, "push_count")


def test_range_and_prefix_reads(spark, folder):
    changelog.write_batch(windows(spark, 300_000, 600_000), folder, changelog.PUSH_SPEED, 0)
    changelog.write_batch(windows(spark, 900_000), folder, changelog.PUSH_SPEED, 1)
    since = lambda ms: [
        r.window_start
        for r in changelog.read_since(spark, folder, changelog.PUSH_SPEED, ms)
        .orderBy("row_key")
        .collect()
    ]
    assert since(0) == [300_000, 600_000, 900_000]
    assert since(300_000) == [600_000, 900_000]
    assert since(899_999) == [900_000]
    assert since(900_000) == []
    first = changelog.read_prefix(spark, folder, changelog.PUSH_SPEED, 2)
    assert [r.window_start for r in first.collect()] == [300_000, 600_000]
    plan = changelog.read_since(spark, folder, changelog.PUSH_SPEED, 300_000)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,0000000000300001)" in text


def test_snapshot_then_changes(spark, folder):
    changelog.write_batch(actors(spark, ann=1), folder, changelog.ACTOR, 0)
    snapshot, changes = changelog.snapshot_then_changes(spark, folder, changelog.ACTOR)
    changelog.write_batch(actors(spark, ann=2, bob=1), folder, changelog.ACTOR, 1)
    assert rows(snapshot) == [("ann", 1)]
    query = (
        changes.writeStream.format("memory")
        .queryName("changes_seen")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert rows(spark.table("changes_seen")) == [("ann", 2, 1), ("bob", 1, 1)]


def test_build_tables(spark, folder):
    from forgemeter.plans.catalogue import _valid
    from forgemeter.sources import dimensions
    from tests.conftest import SMALL

    statistics.build_tables(
        spark, _valid(spark, SMALL), dimensions.language_rankings(spark), folder
    )
    for table in changelog.RESULT_TABLES.values():
        shown = changelog.read_table(spark, folder, table)
        assert shown.schema.names == table.shown.names
        assert shown.count() > 0


def test_catalog(spark, folder):
    assert catalog.ensure_database(spark, "activity")
    assert catalog.ensure_database(spark, "activity")
    name = "activity.actor_stats"
    assert catalog.table_or_empty(spark, name, schemas.ACTOR_STATS).count() == 0
    for _ in range(2):
        assert catalog.ensure_table(spark, name, schemas.ACTOR_STATS, f"{folder}/t")
    actors(spark, ann=3).write.insertInto(name)
    assert rows(catalog.table_or_empty(spark, name, schemas.ACTOR_STATS)) == [("ann", 3)]
    catalog.register_view(actors(spark, bob=1), "people")
    assert spark.sql("SELECT actor_login FROM people").first()[0] == "bob"


PLAIN = {"KAFKA_BOOTSTRAP_SERVERS": "h:1"}
LOGIN = PLAIN | {
    "KAFKA_SECURITY_PROTOCOL": "SASL_SSL",
    "KAFKA_SASL_USERNAME": "u",
    "KAFKA_SASL_PASSWORD": "p",
    "KAFKA_TOPIC": "t",
}


def test_topic_options():
    assert kafka.source_options(PLAIN) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "github-events",
        "startingOffsets": "earliest",
    }
    options = kafka.source_options(LOGIN, max_offsets_per_trigger=10)
    assert options["subscribe"] == "t" and options["maxOffsetsPerTrigger"] == "10"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert options["kafka.sasl.jaas.config"].endswith('required username="u" password="p";')
    sink = kafka.sink_options(PLAIN | {"KAFKA_SECURITY_PROTOCOL": ""})
    assert sink["topic"] == "github-events" and sink["kafka.acks"] == "all"
    assert "kafka.security.protocol" not in sink
    with pytest.raises(KeyError):
        kafka.source_options({})


class FakeSession:
    """Just the two things the folder rule looks at."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(FakeSession("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    assert session.shared_folder(FakeSession(None, "local[8]")).endswith("forgemeter")
    with pytest.raises(RuntimeError):
        session.shared_folder(FakeSession(None, "spark://host:7077"))
    named = session.shared_folder(spark)
    one, two = (session.new_run_folder(spark, "x") for _ in range(2))
    assert one != two and one.startswith(named)


def test_changes_can_be_awaited_before_the_first_write(spark, folder):
    stream = changelog.stream_changes(spark, folder, changelog.ACTOR)
    query = stream.writeStream.format("noop").trigger(availableNow=True).start()
    query.awaitTermination()
    snapshot, _ = changelog.snapshot_then_changes(spark, folder, changelog.ACTOR)
    assert snapshot.count() == 0
