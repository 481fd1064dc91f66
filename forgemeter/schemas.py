"""Explicit schemas and the fixed values of the event model. Nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# ---------------------------------------------------------------------------
# These must stay as they are for results to agree.
# ---------------------------------------------------------------------------

# Event types that count as valid; every other type is an anomaly.
KNOWN_TYPES = (
    "WatchEvent",
    "ForkEvent",
    "PushEvent",
    "IssuesEvent",
    "PullRequestEvent",
    "CreateEvent",
    "DeleteEvent",
)

# Trend weight per event type; a type that is not listed weighs 0.
EVENT_WEIGHTS = {
    "PushEvent": 2,
    "WatchEvent": 3,
    "ForkEvent": 2,
    "IssuesEvent": 1,
    "PullRequestEvent": 1,
    "CreateEvent": 1,
    "ReleaseEvent": 2,
    "DeleteEvent": 0,
    "GollumEvent": 0,
    "MemberEvent": 0,
    "PublicEvent": 0,
    "CommitCommentEvent": 0,
    "IssueCommentEvent": 0,
    "PullRequestReviewEvent": 0,
    "PullRequestReviewCommentEvent": 0,
}

WEIGHT_RANGE = (0, 100)  # inclusive; a missing weight is kept
DEFAULT_TYPE = "Unknown"
ENVELOPE_SOURCE = "github"
DEFAULT_TOPIC = "github-events"

# Language missing from the rankings dimension.
DEFAULT_TIER, DEFAULT_PARADIGM, DEFAULT_LANG_TYPE = "3", "unknown", "unknown"

WINDOW_SIZE, WINDOW_SLIDE, WATERMARK = "10 minutes", "5 minutes", "2 minutes"
DISTINCT_RSD = 0.05

REPO_SCAN_LIMIT, REPO_TOP = 500, 100
ACTOR_SCAN_LIMIT, ACTOR_TOP = 2000, 50
WINDOW_TOP, WINDOW_SHOWN, PANEL_TOP = 24, 12, 10

# ---------------------------------------------------------------------------
# Input records
# ---------------------------------------------------------------------------

RECORD = _struct(key=T.BinaryType(), value=T.BinaryType(), timestamp=_TS)

ENVELOPE = _struct(id=_S, source=_S, payload=_S, timestamp=_L)

# Identifiers are read as text because feeds send them both quoted and bare.
RAW_EVENT = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("type", _S),
        T.StructField("created_at", _S),
        T.StructField("actor", _struct(login=_S, id=_S)),
        T.StructField("repo", _struct(id=_S, name=_S)),
        T.StructField(
            "payload",
            T.StructType(
                [
                    T.StructField("size", _S),
                    T.StructField("ref", _S),
                    T.StructField("ref_type", _S),
                    T.StructField("action", _S),
                    T.StructField("forkee", _struct(full_name=_S)),
                    T.StructField("release", _struct(tag_name=_S)),
                ]
            ),
        ),
    ]
)
RAW_PAGE = T.ArrayType(RAW_EVENT)

ENRICHED = _struct(
    event_id=_S,
    event_type=_S,
    actor_login=_S,
    actor_id=_L,
    repo_id=_L,
    repo_name=_S,
    created_at=_S,
    ingest_time=_S,
    trend_weight=_I,
    language=_S,
    push_size=_I,
    push_ref=_S,
    ref_type=_S,
    fork_repo=_S,
    release_tag=_S,
    pr_action=_S,
    issue_action=_S,
)

# The part of the enriched event that the statistics read.
PAYLOAD = _struct(event_type=_S, actor_login=_S, repo_name=_S, trend_weight=_I, language=_S)

CLEAN = _struct(
    event_type=_S, actor_login=_S, repo_name=_S, trend_weight=_L, language=_S, event_ts=_TS
)

# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------

LANGUAGE_RANKINGS = _struct(language=_S, tier=_S, paradigm=_S, type=_S)
REPO_LANGUAGES = _struct(repo_name=_S, language=_S)

# ---------------------------------------------------------------------------
# Result tables
# ---------------------------------------------------------------------------

REPO_STATS = _struct(
    repo_name=_S,
    star_count=_L,
    fork_count=_L,
    push_count=_L,
    push_weight=_L,
    activity_count=_L,
    contributor_count=_L,
)
# What the changelog stores: the language is needed to rebuild language totals.
REPO_LOG = T.StructType([*REPO_STATS.fields, T.StructField("event_language", _S)])

ACTOR_STATS = _struct(actor_login=_S, activity_count=_L)

LANGUAGE_STATS = _struct(
    language=_S,
    tier=_S,
    paradigm=_S,
    lang_type=_S,
    total_stars=_L,
    total_forks=_L,
    total_pushes=_L,
    total_activity=_L,
    repo_count=_L,
)

WINDOW_COUNT = _struct(row_key=_S, count=_L, window_start=_L, window_end=_L)

# Panes as stored: what merges over any range of them.
PANE_STATES = _struct(
    row_key=_S,
    event_count=_L,
    push_count=_L,
    repo_sketch=T.BinaryType(),
    actor_sketch=T.BinaryType(),
    pane_start=_L,
    pane_end=_L,
)
