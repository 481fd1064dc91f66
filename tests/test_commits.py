"""What readers and the stream of changes see of batches: uncommitted, replayed, of a new checkpoint."""

import os
from dataclasses import replace

import pytest

from forgemeter import schemas
from forgemeter.operators.ranking import top_actors
from forgemeter.sources import changelog
from forgemeter.streaming import jobs
from forgemeter.streaming.gate import rolling_top
from tests.conftest import rows
from tests.test_streaming import clean_stream, config, land

TABLE = changelog.ACTOR


def actors(spark, **counts):
    return spark.createDataFrame(list(counts.items()), schemas.ACTOR_STATS)


def changes(spark, root, name):
    stream = changelog.stream_changes(spark, root, TABLE)
    stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    return rows(spark.table(name))


def test_an_uncommitted_batch_is_no_change(spark, folder):
    changelog.write_batch(actors(spark, ann=1), folder, TABLE, 0)
    pending = changelog.prepare_batch(actors(spark, ann=9), folder, TABLE, 1)
    assert changes(spark, folder, "uncommitted") == [("ann", 1, 0)]
    assert rows(changelog.read_table(spark, folder, TABLE)) == [("ann", 1)]
    changelog.commit_batch(spark, folder, TABLE, 1, pending)
    assert changes(spark, folder, "then_committed") == [("ann", 1, 0), ("ann", 9, 1)]
    assert not os.path.exists(pending)


def test_a_replay_is_one_change_and_other_rows_replace(spark, folder):
    for _ in range(3):
        changelog.write_batch(actors(spark, ann=1, bob=2), folder, TABLE, 0)
    assert changes(spark, folder, "replayed") == [("ann", 1, 0), ("bob", 2, 0)]
    changelog.write_batch(actors(spark, ann=5), folder, TABLE, 0)
    assert rows(changelog.read_table(spark, folder, TABLE)) == [("ann", 5)]


def test_other_rows_under_the_id_of_the_base_are_refused(spark, folder):
    changelog.write_batch(actors(spark, u=1), folder, TABLE, 0)
    changelog.write_batch(actors(spark, u=5), folder, TABLE, 1)
    changelog.compact(spark, folder, TABLE)
    changelog.write_batch(actors(spark, u=5), folder, TABLE, 1)
    for other in (actors(spark, u=2), actors(spark, u=5, w=1)):
        with pytest.raises(ValueError):
            changelog.write_batch(other, folder, TABLE, 1)
    assert rows(changelog.read_table(spark, folder, TABLE)) == [("u", 5)]


def test_claims_are_given_out_once_and_kept(spark, folder):
    first = [changelog.claim(spark, folder, "a", n) for n in range(3)]
    assert first == [0, 1, 2] and changelog.claim(spark, folder, "a", 2) == 2
    assert changelog.claim(spark, folder, "b", 0) == 3 and changelog.claim(spark, folder, "a", 3) == 4
    assert changelog.claim(spark, folder, "c", 0, first=20) == 20
    changelog.write_batch(actors(spark, ann=1), folder, TABLE, 30)
    assert changelog.claim(spark, folder, "a", 4) == 31
    assert len(os.listdir(f"{folder}/claims/all/of")) < 20


def test_a_new_checkpoint_goes_on_after_the_old_rows(spark, folder):
    source, cfg = f"{folder}/in", config(folder)
    land(spark, source, [("u", "r", "01:00:00")] * 5)
    jobs.start_actor_job(clean_stream(spark, source), cfg).awaitTermination()
    changelog.compact(spark, cfg.tables, TABLE)
    land(spark, f"{folder}/in2", [("u", "r", "01:00:00")] * 2)
    again = replace(cfg, checkpoints=f"{folder}/new")
    for _ in range(2):
        jobs.start_actor_job(clean_stream(spark, f"{folder}/in2"), again).awaitTermination()
    assert rows(changelog.read_table(spark, cfg.tables, TABLE)) == [("u", 2)]
    assert changelog.known_batches(spark, cfg.tables, TABLE) == [0, 1]


def test_top_list_after_an_unranked_batch_and_a_vacuum(spark, folder):
    def ranked(batch_id, **changed):
        changelog.write_batch(actors(spark, **changed), folder, TABLE, batch_id)
        known = changelog.known_batches(spark, folder, TABLE)
        return rows(rolling_top(
            actors(spark, **changed), f"{folder}/top", batch_id, "actor_login", top_actors,
            lambda: changelog.read_table(spark, folder, TABLE, batch_id), committed=known,
        ), "actor_login", "activity_count")

    assert ranked(0, a=1) == [("a", 1)]
    changelog.write_batch(actors(spark, b=50), folder, TABLE, 1)  # not ranked
    changelog.compact(spark, folder, TABLE)
    changelog.vacuum(spark, folder, TABLE, keep_bases=1)
    assert changelog.committed_batches(spark, folder, TABLE) == []
    assert ranked(2, a=2) == [("a", 2), ("b", 50)]
    changelog.write_batch(actors(spark, c=70), folder, TABLE, 3)
    for _ in range(2):
        changelog.compact(spark, folder, TABLE)
    changelog.vacuum(spark, folder, TABLE, keep_bases=1)
    assert ranked(4, a=3) == [("a", 3), ("b", 50), ("c", 70)]


def test_language_totals_every_other_batch(spark, folder):
    source, cfg = f"{folder}/in", config(folder)
    names = ["language", "tier", "paradigm", "type"]
    rankings = spark.createDataFrame([("Go", "1", "p", "t")], names)
    for i in range(5):
        land(spark, source, [(f"a{i}", "r", "01:00:00")])
    jobs.start_repo_job(clean_stream(spark, source), rankings, cfg, language_every=2).awaitTermination()
    assert changelog.known_batches(spark, cfg.tables, changelog.LANGUAGE) == [1, 3]
    jobs.refresh_languages(spark, cfg.tables, rankings)
    assert changelog.read_table(spark, cfg.tables, changelog.LANGUAGE).first().total_activity == 5
