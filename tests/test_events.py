"""Decoding, validity and flattening on hand-written rows."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from forgemeter import schemas
from forgemeter.functions.codec import decode_records, encode_records
from forgemeter.operators.aggregates import actor_stats, repo_stats
from forgemeter.operators.dedup import dedup_events
from forgemeter.operators.flatten import flatten_events
from forgemeter.operators.validate import keep_valid
from forgemeter.plans.ingest import ingest_pages
from forgemeter.plans.statistics import clean_events
from forgemeter.sources import landing
from tests.conftest import rows

NOW = datetime(2024, 1, 1, 1, 0, tzinfo=timezone.utc)


def record(payload, key="1"):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return (key, json.dumps({"id": key, "source": "x", "payload": text, "timestamp": 5}), NOW)


def records(spark, values):
    return spark.createDataFrame(values, "key STRING, value STRING, timestamp TIMESTAMP")


def event(**fields):
    base = {
        "event_type": "PushEvent",
        "actor_login": "ann",
        "repo_name": "o/r",
        "trend_weight": 1,
        "language": "Java",
    }
    return {k: v for k, v in (base | fields).items() if v is not ...}


@pytest.mark.parametrize(
    "weight, kept, value",
    [
        (0, True, 0),
        (100, True, 100),
        (-1, False, None),
        (101, False, None),
        (None, True, None),
        (..., True, None),
        (9999999999, True, None),
        (2.5, True, None),
        ("7", True, None),
    ],
)
def test_weight_limits(spark, weight, kept, value):
    clean = clean_events(records(spark, [record(event(trend_weight=weight))])).collect()
    assert [r.trend_weight for r in clean] == ([value] if kept else [])


@pytest.mark.parametrize(
    "fields, kept",
    [
        ({"event_type": None}, False),
        ({"event_type": ...}, False),
        ({"event_type": "ReleaseEvent"}, False),
        ({"event_type": "DeleteEvent"}, True),
        ({"repo_name": None}, False),
        ({"repo_name": ""}, True),
        ({"actor_login": None}, True),
        ({"actor_login": ""}, True),
    ],
)
def test_required_fields(spark, fields, kept):
    assert clean_events(records(spark, [record(event(**fields))])).count() == int(kept)


def test_broken_records_do_not_stop_others(spark):
    bad = [
        ("1", "not json", NOW),
        ("2", "{}", NOW),
        ("3", None, NOW),
        ("4", "[1, 2]", NOW),
        record("not json", "5"),
        record("[]", "6"),
    ]
    clean = clean_events(records(spark, bad + [record(event(), "7")]))
    assert rows(clean, "repo_name") == [("o/r",)]


def test_binary_values_decode(spark):
    df = records(spark, [record(event())]).withColumn("value", F.col("value").cast("binary"))
    assert clean_events(df).count() == 1


def test_event_time_choices(spark):
    df = records(spark, [record(event(created_at="2024-02-03T04:05:06Z"))])
    millis = {
        choice: decode_records(df, choice).select(F.unix_millis("event_ts")).first()[0]
        for choice in ("record", "envelope", "created_at")
    }
    assert millis == {
        "record": 1704070800000,
        "envelope": 5,
        "created_at": 1706933106000,
    }
    with pytest.raises(ValueError):
        decode_records(df, "other")


def test_repo_language_and_push_weight(spark):
    df = records(
        spark,
        [
            record(event(repo_name="a/a", language="")),
            record(event(repo_name="a/a", language="Java")),
            record(event(repo_name="a/a", language="Scala")),
            record(event(repo_name="b/b", language="", trend_weight=None)),
        ],
    )
    clean = clean_events(df)
    for exact in (True, False):
        stats = repo_stats(clean, exact)
        assert rows(stats, "repo_name", "event_language", "push_weight") == [
            ("a/a", "Scala", 3),
            ("b/b", None, 0),
        ]


def test_blank_actor_is_a_group_and_null_is_not(spark):
    df = records(
        spark,
        [
            record(event(actor_login="")),
            record(event(actor_login=None)),
            record(event(actor_login="ann")),
        ],
    )
    assert rows(actor_stats(clean_events(df))) == [("", 1), ("ann", 1)]


def test_empty_input(spark):
    empty = spark.createDataFrame([], schemas.CLEAN)
    assert repo_stats(empty, exact=True).count() == 0
    assert repo_stats(empty).count() == 0
    assert keep_valid(empty).count() == 0


PAGE = [
    {
        "id": "1",
        "type": "PushEvent",
        "created_at": "2024-01-01T00:00:00Z",
        "actor": {"login": "ann", "id": 7},
        "repo": {"id": "9", "name": "o/r"},
        "payload": {"size": 3, "ref": "refs/heads/main", "action": "ignored"},
    },
    {"id": 2, "type": None, "actor": None, "payload": {"size": 3}},
    {"id": "3", "type": "ForkEvent", "payload": {"forkee": {"full_name": "z/r"}}},
    {"id": "4", "type": "ReleaseEvent", "payload": {"release": {"tag_name": "v1"}}},
    {"id": "5", "type": "CreateEvent", "payload": {"ref_type": "tag", "ref": "ignored"}},
    {"id": "6", "type": "PullRequestEvent", "payload": {"action": "opened"}},
    {"id": "7", "type": "IssuesEvent", "payload": {"action": "closed"}},
    {"id": "", "type": "PushEvent"},
    {"type": "PushEvent"},
    {"id": "8", "type": "PushEvent", "repo": {"id": "no number"}, "payload": {"size": "12.7"}},
]


def pages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "body STRING")


def test_flatten(spark):
    flat = flatten_events(landing.explode_pages(pages(spark, json.dumps(PAGE))))
    assert set(flat.columns) | {"language"} == set(schemas.ENRICHED.names)
    by_id = {r.event_id: r.asDict() for r in flat.collect()}
    assert sorted(by_id) == ["1", "2", "3", "4", "5", "6", "7", "8"]
    defaults = {
        "push_size": 0,
        "push_ref": "",
        "ref_type": "",
        "fork_repo": "",
        "release_tag": "",
        "pr_action": "",
        "issue_action": "",
    }
    special = {
        "1": {"push_size": 3, "push_ref": "refs/heads/main"},
        "2": {},
        "3": {"fork_repo": "z/r"},
        "4": {"release_tag": "v1"},
        "5": {"ref_type": "tag"},
        "6": {"pr_action": "opened"},
        "7": {"issue_action": "closed"},
        "8": {"push_size": 12},
    }
    for event_id, fields in special.items():
        assert {k: by_id[event_id][k] for k in defaults} == defaults | fields
    first, second = by_id["1"], by_id["2"]
    assert (first["actor_id"], first["repo_id"], first["trend_weight"]) == (7, 9, 2)
    assert second["event_type"] == "Unknown"
    assert (second["actor_login"], second["repo_name"], second["created_at"]) == ("", "", "")
    assert (second["actor_id"], second["repo_id"], second["trend_weight"]) == (0, 0, 0)
    assert by_id["8"]["repo_id"] == 0
    assert first["ingest_time"].endswith("Z")


def test_bad_pages_give_no_events(spark):
    flat = flatten_events(
        landing.explode_pages(pages(spark, "oops", "", '{"message": "limited"}', "[]"))
    )
    assert flat.count() == 0


def test_page_files(spark, folder):
    for i in range(3):
        with open(f"{folder}/page{i}.json", "w") as out:
            out.write(json.dumps([{"id": f"{i}-{j}", "type": "PushEvent"} for j in range(4)], indent=1))
    flat = flatten_events(landing.explode_pages(landing.read_pages(spark, folder)))
    assert flat.count() == 12


@pytest.mark.parametrize("staged", [True, False])
def test_ingest_records(spark, folder, staged):
    languages = spark.createDataFrame([("o/r", "Go"), ("", "Ghost")], schemas.REPO_LANGUAGES)
    text = json.dumps(PAGE)
    staging = f"{folder}/flat" if staged else None
    records_ = ingest_pages(pages(spark, text, text), languages, staging)
    got = {
        r.key: json.loads(json.loads(r.value)["payload"]) for r in records_.collect()
    }
    assert len(got) == 8
    assert got["1"]["language"] == "Go"
    assert got["2"]["language"] == ""
    envelope = json.loads(records_.where("key = '1'").first().value)
    assert envelope["id"] == "1" and envelope["source"] == "github"
    assert isinstance(envelope["timestamp"], int)
    assert set(got["1"]) == set(schemas.ENRICHED.names)


def test_encode_then_decode(spark):
    languages = spark.createDataFrame([], schemas.REPO_LANGUAGES)
    sent = ingest_pages(pages(spark, json.dumps(PAGE)), languages)
    clean = clean_events(sent.withColumn("timestamp", F.lit(NOW)))
    # ReleaseEvent and Unknown are not among the known types
    assert clean.count() == 6


def test_sent_at_is_settable(spark):
    one = spark.createDataFrame([("1", "PushEvent")], "event_id STRING, event_type STRING")
    value = encode_records(one, sent_at=F.timestamp_millis(F.lit(123))).first().value
    assert json.loads(value)["timestamp"] == 123


def test_first_copy_wins(spark):
    copies = spark.createDataFrame(
        [("1", 3, "late"), ("1", 1, "first"), ("2", 2, "only")],
        "event_id STRING, at INT, note STRING",
    )
    assert rows(dedup_events(copies, "at"), "event_id", "note") == [("1", "first"), ("2", "only")]
    assert dedup_events(copies).count() == 2
