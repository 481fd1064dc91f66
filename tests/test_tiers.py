"""Runs of merged batches: the same table read, few folders, and leases that vacuum waits for."""

import os
import random

import pytest

from forgemeter import schemas
from forgemeter.sources import changelog
from tests.conftest import rows

TABLE = changelog.ACTOR


def write(spark, root, n, counts):
    frame = spark.createDataFrame(list(counts.items()), schemas.ACTOR_STATS).coalesce(1)
    changelog.write_batch(frame, root, TABLE, n)


def folders(root):
    return [n for part in ("log", "runs") for n in sorted(os.listdir(f"{root}/{TABLE.name}/{part}"))]


@pytest.fixture
def history(spark, folder):
    """Twenty batches of random keys merged by threes, and the table as it was after each."""
    chance, state, states = random.Random(5), {}, []
    for n in range(20):
        batch = {f"u{chance.randrange(9)}": chance.randrange(1000) for _ in range(3)}
        write(spark, folder, n, batch)
        changelog.compact_when_due(spark, folder, TABLE, 10_000, fan=3)
        state = {**state, **batch}
        states.append(sorted(state.items(), key=repr))
    return states


def test_reads_equal_whatever_was_merged(spark, folder, history):
    levels = [r.level for r in changelog.runs(spark, folder, TABLE)]
    assert levels.count(1) == 6 and levels.count(2) == 2
    for n in (0, 2, 4, 8, 11, 17, 19):
        assert rows(changelog.read_table(spark, folder, TABLE, n)) == history[n]
    keys = spark.createDataFrame([("u1",), ("u5",), ("nobody",)], "actor_login string")
    want = [kv for kv in history[19] if kv[0] in ("u1", "u5")]
    assert rows(changelog.read_keys(spark, folder, TABLE, keys)) == want
    changelog.compact(spark, folder, TABLE)
    assert rows(changelog.read_table(spark, folder, TABLE)) == history[19]
    write(spark, folder, 20, {"u1": 7})
    assert dict(rows(changelog.read_table(spark, folder, TABLE)))["u1"] == 7


def test_folders_grow_with_the_logarithm(spark, folder, history):
    for _ in range(2):
        changelog.vacuum(spark, folder, TABLE)
    # Two runs of nine batches and the two newest, which can come again.
    assert folders(folder) == ["batch_id=18", "batch_id=19", "2.0.8", "2.9.17"]
    assert rows(changelog.read_table(spark, folder, TABLE)) == history[19]
    assert rows(changelog.read_table(spark, folder, TABLE, 8)) == history[8]
    assert rows(changelog.read_table(spark, folder, TABLE, 17)) == history[17]
    for gone in (0, 5, 10, 16):
        assert not changelog.readable_as_of(spark, folder, TABLE, gone)
        with pytest.raises(ValueError):
            changelog.read_table(spark, folder, TABLE, gone)
    assert changelog.known_batches(spark, folder, TABLE) == [8, 17, 18, 19]
    assert changelog.log_is_whole(spark, folder, TABLE, 17)
    assert not changelog.log_is_whole(spark, folder, TABLE, 16)


def test_batches_in_a_run_cannot_change(spark, folder, history):
    changelog.write_batch(changelog.read_batch(spark, folder, TABLE, 4), folder, TABLE, 4)  # a replay
    with pytest.raises(ValueError):
        write(spark, folder, 4, {"u1": -1})
    write(spark, folder, 19, {"u1": 5})  # in no run: replaced
    assert dict(rows(changelog.read_table(spark, folder, TABLE)))["u1"] == 5


def test_a_base_after_so_many_batches_counts_those_vacuumed(spark, folder, history):
    for _ in range(2):
        changelog.vacuum(spark, folder, TABLE)
    changelog.compact_when_due(spark, folder, TABLE, 21, fan=3)
    assert not os.path.exists(f"{folder}/{TABLE.name}/base")
    changelog.compact_when_due(spark, folder, TABLE, 20, fan=3)
    assert os.listdir(f"{folder}/{TABLE.name}/base") == ["upto=19"]
    changelog.vacuum(spark, folder, TABLE, keep_bases=1)
    assert folders(folder) == []
    assert rows(changelog.read_table(spark, folder, TABLE)) == history[19]


def test_vacuum_waits_for_leases(spark, folder, history):
    with changelog.lease(spark, folder, TABLE, upto=10) as batch:
        assert batch == 10
        for _ in range(2):
            changelog.vacuum(spark, folder, TABLE)
        reader = changelog.read_table(spark, folder, TABLE, batch)
        changelog.compact(spark, folder, TABLE)
        changelog.vacuum(spark, folder, TABLE, keep_bases=1)
        assert rows(reader) == history[10]
        assert rows(changelog.read_table(spark, folder, TABLE, 5)) == history[5]
    changelog.vacuum(spark, folder, TABLE, keep_bases=1)
    assert folders(folder) == [] and os.listdir(f"{folder}/{TABLE.name}/leases") == []
    assert rows(changelog.read_table(spark, folder, TABLE)) == history[19]


def test_a_lease_runs_out(spark, folder, history):
    with changelog.lease(spark, folder, TABLE, seconds=-1) as batch:
        assert batch == 19
        changelog.compact(spark, folder, TABLE)
        changelog.vacuum(spark, folder, TABLE, keep_bases=1)
        assert folders(folder) == []


def test_a_lease_on_nothing(spark, folder):
    with changelog.lease(spark, folder, TABLE) as batch:
        assert batch is None
