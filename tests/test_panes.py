"""Panes against windows that hold every event, and stored sketches over ranges."""

from datetime import datetime, timedelta, timezone

import pytest

from forgemeter import schemas
from forgemeter.operators import aggregates, panes
from forgemeter.sources import changelog
from forgemeter.streaming import jobs
from tests.conftest import rows
from tests.test_streaming import clean_stream, config, land

ZERO = datetime(1970, 1, 1, tzinfo=timezone.utc)


def events(spark, found):
    values = [(kind, actor, repo, 1, "Go", ZERO + timedelta(seconds=s)) for s, kind, actor, repo in found]
    return spark.createDataFrame(values, schemas.CLEAN)


def mixed(spark):
    kinds = ["PushEvent", "WatchEvent", None]
    found = [(7919 * i % 30_000 - 900, kinds[i % 3], f"a{i % 41}", f"r{i % 13}") for i in range(400)]
    return events(spark, [*found, (0, "PushEvent", "a0", "r0"), (-1, "PushEvent", None, None), (1800, "PushEvent", "", "")])


@pytest.mark.parametrize(
    ("size", "slide"),
    [("10 minutes", "5 minutes"), ("1 hour", "5 minutes"), ("9 minutes", "6 minutes"), ("5 minutes", "5 minutes"),
     ("90 seconds", "1 minute")],
)
def test_panes_equal_windows(spark, size, slide):
    found = mixed(spark)
    want = rows(aggregates.window_activity(found, True, size, slide))
    assert rows(panes.window_activity_panes(found, True, size, slide)) == want
    # Thirteen repositories are below what a sketch rounds.
    assert rows(panes.window_activity_panes(found, False, size, slide)) == want


def test_no_event_is_copied(spark):
    merged = panes.window_activity_panes(mixed(spark), True, "1 hour", "5 minutes")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    # What is copied has been counted per pane before: the copy stands above an exchange.
    assert plan.index("Generate explode") < plan.rindex("Exchange hashpartitioning(")


def test_no_events(spark):
    none = spark.createDataFrame([], schemas.CLEAN)
    assert rows(panes.window_activity_panes(none, True)) == rows(panes.window_activity_panes(none)) == []


def test_ranges_hold_whole_panes_only(spark):
    found = events(spark, [(0, "PushEvent", "a", "x"), (299, "PushEvent", "b", "x"), (300, "WatchEvent", "a", "y"),
                           (86_400, "PushEvent", "c", "z")])
    states = panes.pane_states(found, "5 minutes")
    ranges = spark.createDataFrame(
        [("first", 0, 300_000), ("both", 0, 600_000), ("cut", 1, 600_000), ("days", 300_000, 90_000_000),
         ("none", 5, 5), ("back", 9, 0), ("empty", 10**12, 10**12 + 600_000)],
        "range_id string, range_start long, range_end long",
    )
    got = panes.estimated(panes.range_states(states, ranges))
    assert rows(got, "range_id", "event_count", "push_count", "repo_count", "contributor_count") == [
        ("both", 3, 2, 2, 2), ("cut", 1, 0, 1, 1), ("days", 2, 1, 2, 2), ("first", 2, 2, 1, 2)]


def test_states_by_group(spark):
    found = events(spark, [(0, "PushEvent", "a", "x"), (1, "PushEvent", "b", "x"), (2, "PushEvent", "a", "y")])
    states = panes.pane_states(found, "1 day", ["repo_name"])
    ranges = spark.createDataFrame([("d", 0, 86_400_000)], "range_id string, range_start long, range_end long")
    got = panes.estimated(panes.range_states(states, ranges, ["repo_name"]))
    assert rows(got, "repo_name", "contributor_count") == [("x", 2), ("y", 1)]


def test_a_pane_grows_over_batches(spark, folder):
    source, cfg = f"{folder}/in", config(folder)
    land(spark, source, [("a", "x", "00:01:00"), ("b", "x", "00:07:00")])
    land(spark, source, [("c", "y", "00:02:00"), ("a", "x", "00:08:00")])
    jobs.start_pane_job(clean_stream(spark, source), cfg).awaitTermination()
    table = panes.estimated(changelog.read_table(spark, cfg.tables, changelog.PANES))
    # 00:02 lies more than two minutes before 00:07, but its pane had not ended by the watermark of 00:05.
    got = rows(table, "pane_start", "event_count", "repo_count", "contributor_count")
    assert [r[1:] for r in got] in ([(2, 2, 2), (2, 1, 2)], [(1, 1, 1), (2, 1, 2)])
