"""Language totals kept by changed keys, against totals over all repositories."""

import re
from dataclasses import replace

import pytest

from forgemeter import schemas
from forgemeter.operators.aggregates import language_stats
from forgemeter.sources import changelog
from forgemeter.streaming import jobs
from tests.conftest import rows
from tests.test_streaming import at, clean_stream, config


def repos(spark, *found):
    values = [(name, stars, 1, 2, 0, stars + 3, 1, language) for name, stars, language in found]
    columns = ["repo_name", "star_count", "fork_count", "push_count", "push_weight", "activity_count",
               "contributor_count", "event_language"]
    kinds = {f.name: f.dataType.simpleString() for f in schemas.REPO_LOG}
    frame = spark.createDataFrame(values, ", ".join(f"{c} {kinds[c]}" for c in columns))
    return frame.select(*schemas.REPO_LOG.names)


def rankings(spark):
    return spark.createDataFrame(
        [("Go", "1", "p", "t"), ("Zig", "2", "q", "u")], "language string, tier string, paradigm string, type string"
    )


@pytest.mark.parametrize("part", [1, 500_000])
def test_a_hashed_base_is_read_by_its_parts(spark, folder, monkeypatch, part):
    monkeypatch.setattr(changelog, "KEYS_A_PART", part)
    table = changelog.REPO
    found = [(f"r{i}", i, "Go") for i in range(12)] + [("", 1, "Go"), ("é", 2, None)]
    changelog.write_batch(repos(spark, *found), folder, table, 0)
    changelog.compact(spark, folder, table)
    changelog.write_batch(repos(spark, ("r3", 99, "Zig"), ("new", 1, "Go")), folder, table, 1)
    keys = spark.createDataFrame([("r3",), ("r7",), ("",), ("new",), ("none",)], "repo_name string")
    got = rows(changelog.read_keys(spark, folder, table, keys), "repo_name", "star_count")
    assert got == [("", 1), ("new", 1), ("r3", 99), ("r7", 7)]
    before = rows(changelog.read_keys(spark, folder, table, keys, 0), "repo_name", "star_count")
    assert before == [("", 1), ("r3", 3), ("r7", 7)]
    assert changelog.read_latest(spark, folder, table).count() == 15
    plan = changelog.read_keys(spark, folder, table, keys)._jdf.queryExecution().executedPlan().toString()
    assert ("PartitionFilters: [part" in plan) == (part == 1)


@pytest.mark.parametrize(("compact_every", "language_every"), [(0, 1), (2, 1), (2, 2)])
def test_totals_by_changed_keys_equal_totals_over_all(spark, folder, compact_every, language_every):
    source, cfg = f"{folder}/in", replace(config(folder), compact_every=compact_every)
    batches = [
        [("a", "Go"), ("b", "Go"), ("c", None)],
        [("a", "Zig"), ("d", "Lua")],
        [("c", "Go"), ("b", "Zig")],
        [("e", "Ada"), ("d", "Zig"), ("", "Go")],
        [("a", "Zig")],
    ]
    for batch in batches:
        frame = spark.createDataFrame([("PushEvent", "x", r, 1, lang, at("01:00:00")) for r, lang in batch], schemas.CLEAN)
        frame.coalesce(1).write.mode("append").parquet(source)
        job = jobs.start_repo_job(clean_stream(spark, source, 9), rankings(spark), cfg, language_every=language_every)
        job.awaitTermination()
        newest = changelog.last_batch(spark, cfg.tables, changelog.LANGUAGE)
        if newest is None:
            continue
        whole = changelog.read_latest(spark, cfg.tables, changelog.REPO, newest)
        want = rows(language_stats(whole, rankings(spark)).where("language <> ''"))
        assert rows(changelog.read_table(spark, cfg.tables, changelog.LANGUAGE)) == want
    names = {r[0] for r in rows(changelog.read_table(spark, cfg.tables, changelog.LANGUAGE))}
    assert names == {"Go", "Zig", "Ada"}  # the last repository in Lua has moved
    log = changelog.committed_batches(spark, cfg.tables, changelog.REPO)
    bases = [n for n in changelog.known_batches(spark, cfg.tables, changelog.REPO)]
    assert len(log) == len(batches) and set(bases) == set(log)


def test_a_trigger_reads_only_what_its_batch_touches(spark, folder, monkeypatch):
    """The plan of the totals scans the parts of changed keys, not the base."""
    monkeypatch.setattr(changelog, "KEYS_A_PART", 1)
    changelog.write_batch(repos(spark, *[(f"r{i}", i, "Go") for i in range(40)]), folder, changelog.REPO, 0)
    changelog.compact(spark, folder, changelog.REPO)
    stats = language_stats(changelog.read_latest(spark, folder, changelog.REPO), rankings(spark))
    changelog.write_batch(stats, folder, changelog.LANGUAGE, 0)
    changelog.write_batch(repos(spark, ("r5", 6, "Zig")), folder, changelog.REPO, 1)
    cfg = replace(config(folder), tables=folder)
    after = jobs._language_totals(spark, cfg, rankings(spark), 1)
    want = language_stats(changelog.read_latest(spark, folder, changelog.REPO), rankings(spark))
    assert rows(after) == rows(want)
    plan = after._jdf.queryExecution().executedPlan().toString()
    # One part is an equality: the filters then begin with isnotnull(part).
    assert re.search(r"PartitionFilters: \[[^\]]*\(part#\d+ = ", plan)
