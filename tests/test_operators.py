"""Lookups, rankings, messages, windows; and the plans they must keep."""

import json
import random

import pytest
from pyspark.sql import functions as F

from forgemeter import schemas
from forgemeter.operators import aggregates, dedup, lookups, messages, ranking
from forgemeter.plans import catalogue, dashboard
from forgemeter.sources import dimensions
from tests.conftest import SMALL, rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def busy_events(spark):
    """1,200 events: a third of one repository, a third blank, the rest spread."""
    return spark.range(1200).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "big/repo")
        .when(F.col("id") % 3 == 1, "")
        .otherwise(F.concat(F.lit("small/"), (F.col("id") % 50).cast("string")))
        .alias("repo_name"),
    )


def known_languages(spark):
    return spark.createDataFrame(
        [("big/repo", "Go"), ("", "Ghost")] + [(f"small/{i}", f"L{i}") for i in range(0, 50, 2)],
        schemas.REPO_LANGUAGES,
    )


def expected_language(name):
    if name == "big/repo":
        return "Go"
    if name.startswith("small/") and int(name[6:]) % 2 == 0:
        return "L" + name[6:]
    return ""


@pytest.mark.parametrize("with_hot", [True, False])
def test_language_lookup_when_shuffled(spark, no_broadcast, with_hot):
    events, languages = busy_events(spark), known_languages(spark)
    hot = lookups.hot_repo_languages(events, languages, limit=3) if with_hot else None
    out = lookups.lookup_repo_language(events, languages, hot)
    got = out.collect()
    assert len(got) == 1200
    assert all(r.language == expected_language(r.repo_name) for r in got)


def test_hot_and_blank_rows_are_scattered(spark, no_broadcast):
    """After the shuffle no partition holds the third of the rows that share a name."""
    events, languages = busy_events(spark), known_languages(spark)
    hot = lookups.hot_repo_languages(events, languages, limit=1)
    out = lookups.lookup_repo_language(events, languages, hot)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1200
    assert "SortMergeJoin" in plan(out) or "ShuffledHashJoin" in plan(out)
    joined = out.where("repo_name = 'big/repo'").select("language").distinct().collect()
    assert [r.language for r in joined] == ["Go"]


def test_hot_repo_without_language_stays_empty(spark):
    events = spark.createDataFrame([("1", "x/y"), ("2", "x/y")], "event_id STRING, repo_name STRING")
    none = spark.createDataFrame([], schemas.REPO_LANGUAGES)
    hot = lookups.hot_repo_languages(events, none)
    assert rows(hot) == [("x/y", None)]
    out = lookups.lookup_repo_language(events, none, hot)
    assert rows(out) == [("1", "x/y", ""), ("2", "x/y", "")]


def test_frequent_keys_are_bounded(spark):
    events = busy_events(spark)
    assert [r[0] for r in lookups.frequent_keys(events, "repo_name", 1).collect()] == ["big/repo"]
    assert lookups.frequent_keys(events, "repo_name", 10**9).count() <= lookups.HOT_LIMIT


def test_unlisted_language_gets_defaults(spark):
    repos = spark.createDataFrame(
        [("a", 1, 0, 2, 3, "Klingon"), ("b", 1, 1, 1, 3, "Java"), ("c", 9, 9, 9, 9, None),
         ("d", 9, 9, 9, 9, "")],
        "repo_name STRING, star_count BIGINT, fork_count BIGINT, push_count BIGINT, "
        "activity_count BIGINT, event_language STRING",
    )
    out = aggregates.language_stats(repos, dimensions.language_rankings(spark))
    assert rows(out) == [
        ("Java", "1", "object-oriented", "compiled", 1, 1, 1, 3, 1),
        ("Klingon", "3", "unknown", "unknown", 1, 0, 2, 3, 1),
    ]


# -- ranking ---------------------------------------------------------------


def stable_desc(items, key):
    """A stable ascending sort, reversed: how ties fall in the lists to agree with."""
    return list(reversed(sorted(items, key=key)))


@pytest.mark.parametrize("seed", range(3))
def test_orders_match_a_stable_sort(spark, seed):
    rng = random.Random(seed)
    repos = sorted(
        {f"r{rng.randint(0, 400):03d}" for _ in range(300)}
    )  # readers get rows in key order
    data = [(name, rng.randint(0, 9), rng.randint(0, 4), rng.randint(0, 3)) for name in repos]
    df = spark.createDataFrame(
        data, "repo_name STRING, activity_count BIGINT, star_count BIGINT, fork_count BIGINT"
    )
    for scan in (None, 120):
        scanned = data if scan is None else data[:scan]
        snapshot = stable_desc(scanned, lambda r: r[1])[:100]
        got = ranking.top_repos(df, scan)
        assert [r.repo_name for r in got.collect()] == [r[0] for r in snapshot]
        for key, column in (("activity", 1), ("stars", 2), ("forks", 3)):
            shown = stable_desc(snapshot, lambda r: r[column])[:10]
            panel = ranking.repo_panel(got, key).orderBy("rank").collect()
            assert [(r.rank, r.repo_name, r.metric) for r in panel] == [
                (i + 1, r[0], r[column]) for i, r in enumerate(shown)
            ]
    actors = df.select(F.col("repo_name").alias("actor_login"), "activity_count")
    snapshot = stable_desc(data, lambda r: r[1])[:50]
    shown = stable_desc(snapshot, lambda r: r[1])[:10]
    panel = ranking.contributor_panel(ranking.top_actors(actors)).orderBy("rank").collect()
    assert [r.actor_login for r in panel] == [r[0] for r in shown]


def window_rows(spark, starts, base=0):
    return spark.createDataFrame(
        [(s * 300_000, s * 300_000 + 600_000, base + s) for s in starts],
        "window_start BIGINT, window_end BIGINT, count BIGINT",
    )


def test_window_panel(spark):
    panel = ranking.window_panel(window_rows(spark, range(1, 31))).collect()
    assert [r.window_start // 300_000 for r in panel] == list(range(19, 31))
    assert {r.max_value for r in panel} == {30}
    assert panel[-1].share == 1.0
    assert ranking.window_panel(window_rows(spark, [])).count() == 0
    zero = ranking.window_panel(window_rows(spark, [1], base=-1)).first()
    assert zero.share is None


def test_append_windows(spark):
    shown = window_rows(spark, range(1, 25))
    added = window_rows(spark, range(24, 27), base=100)
    out = {r.window_start // 300_000: r["count"] for r in ranking.append_windows(shown, added).collect()}
    assert sorted(out) == list(range(3, 27))
    assert out[23] == 23 and out[24] == 124 and out[26] == 126


def test_overview_of_nothing(spark):
    empty = spark.createDataFrame([], schemas.REPO_STATS)
    row = ranking.overview_totals(empty).first()
    assert (row.repos, row.stars, row.stars_text) == (0, 0, "0")
    assert ranking.high_water(empty, "activity_count", 7).first()[0] == 7


# -- messages --------------------------------------------------------------


def actor_rows(spark, n):
    return spark.range(n).select(
        F.concat(F.lit('u"'), F.col("id").cast("string")).alias("actor_login"),
        (F.col("id") % 3).alias("activity_count"),
    )


def test_list_message_round_trip(spark):
    actors = actor_rows(spark, 20)
    message = messages.list_message(
        actors, "ActorStatsSnapshot", ["activity_count", "actor_login"], descending=True
    )
    assert message.count() == 1
    body = json.loads(message.first().body)
    assert body["type"] == "ActorStatsSnapshot"
    order = [(a["activityCount"], a["actorLogin"]) for a in body["actors"]]
    assert order == sorted(order, reverse=True) and len(order) == 20
    assert rows(messages.decode_messages(message, "ActorStatsSnapshot")) == rows(actors)


def test_empty_list_message(spark):
    message = messages.list_message(actor_rows(spark, 0), "ActorStatsUpdated", ["actor_login"])
    assert json.loads(message.first().body) == {"type": "ActorStatsUpdated", "actors": []}


def test_too_long_a_list_fails_instead_of_losing_rows(spark, monkeypatch):
    monkeypatch.setattr(messages, "MESSAGE_ROWS", 5)
    fits = messages.list_message(actor_rows(spark, 5), "ActorStatsSnapshot", ["actor_login"])
    assert len(json.loads(fits.first().body)["actors"]) == 5
    longer = messages.list_message(actor_rows(spark, 6), "ActorStatsSnapshot", ["actor_login"])
    with pytest.raises(Exception, match="more than 5 rows"):
        longer.collect()


def test_other_and_invalid_messages_are_ignored(spark):
    feed = spark.createDataFrame(
        [("nonsense",), ('{"type":"Other"}',), (None,),
         ('{"type":"NewWindow","window":{"windowStart":1,"windowEnd":2,"count":3}}',)],
        "body STRING",
    )
    assert rows(messages.decode_messages(feed, "NewWindow")) == [(1, 2, 3)]


# -- gate ------------------------------------------------------------------


def test_gate_history_against_brute_force(spark):
    rng = random.Random(4)
    data = [(rng.choice("abc"), rng.randint(0, 40) * 3_600) for _ in range(60)]
    df = spark.createDataFrame(data, "repo_name STRING, at BIGINT").select(
        "repo_name", F.timestamp_seconds("at").alias("event_ts")
    )
    got = {r.refreshed_at: (r.high_water, r.sent) for r in dashboard.gate_history(df, "6 hours").collect()}
    previous, want = 0, {}
    for end in sorted({(t // 21_600 + 1) * 21_600 for _, t in data}):
        counts = {}
        for name, t in data:
            if t < end:
                counts[name] = counts.get(name, 0) + 1
        mark = max(counts.values())
        want[end * 1000] = (mark, mark > previous)
        previous = mark
    assert got == want


# -- plans -----------------------------------------------------------------


def test_plans_stay_hashed(spark):
    for name in ("top_repos_global", "actor_stats", "window_activity", "push_speed_per_window"):
        assert "SortAggregate" not in plan(catalogue.QUERIES[name](spark, SMALL)), name


def test_type_filter_reaches_the_scan(spark):
    text = plan(catalogue.QUERIES["clean_events"](spark, SMALL))
    assert "PushedFilters: [In(event_type" in text


def test_columns_are_pruned(spark):
    text = plan(catalogue.QUERIES["actor_stats"](spark, SMALL))
    read = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "ts:" not in read


def test_json_is_parsed_once(spark):
    text = plan(catalogue.QUERIES["envelope_clean_events"](spark, SMALL))
    assert text.count("from_json(") == 2  # the envelope and the event in it


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(catalogue.QUERIES["top_repos_global"](spark, SMALL))


def test_dedup_combines_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("event_id"), F.col("id").alias("at"))
    text = plan(dedup.dedup_events(df, "at"))
    assert text.index("Exchange") < text.index("partial_min_by")


def test_small_dimension_is_broadcast_by_its_size(spark, no_broadcast):
    query = catalogue.QUERIES["language_stats"]
    assert "BroadcastHashJoin" not in plan(query(spark, SMALL))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert "BroadcastHashJoin" in plan(query(spark, SMALL))
