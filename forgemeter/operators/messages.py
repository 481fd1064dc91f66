"""Tagged JSON messages: a ``type`` field and a body that depends on it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgemeter.operators.scan import with_earlier

# The message kinds, the name of their list or item, and field names.
WINDOW_FIELDS = {"window_start": "windowStart", "window_end": "windowEnd", "count": "count"}
PUSH_FIELDS = {"window_start": "windowStart", "window_end": "windowEnd", "count": "pushCount"}
REPO_FIELDS = {
    "repo_name": "repoName",
    "star_count": "starCount",
    "fork_count": "forkCount",
    "push_count": "pushCount",
    "push_weight": "pushWeight",
    "activity_count": "activityCount",
    "contributor_count": "contributorCount",
}
LANGUAGE_FIELDS = {
    "language": "language",
    "tier": "tier",
    "paradigm": "paradigm",
    "lang_type": "langType",
    "total_stars": "totalStars",
    "total_forks": "totalForks",
    "total_pushes": "totalPushes",
    "total_activity": "totalActivity",
    "repo_count": "repoCount",
}
ACTOR_FIELDS = {"actor_login": "actorLogin", "activity_count": "activityCount"}

LIST_KINDS = {
    "Snapshot": ("windows", WINDOW_FIELDS),
    "PushSpeedSnapshot": ("windows", PUSH_FIELDS),
    "RepoStatsSnapshot": ("repos", REPO_FIELDS),
    "RepoStatsUpdated": ("repos", REPO_FIELDS),
    "LanguageStatsSnapshot": ("languages", LANGUAGE_FIELDS),
    "ActorStatsSnapshot": ("actors", ACTOR_FIELDS),
    "ActorStatsUpdated": ("actors", ACTOR_FIELDS),
}
ITEM_KINDS = {
    "NewWindow": ("window", WINDOW_FIELDS),
    "PushSpeedNewWindow": ("window", PUSH_FIELDS),
}
TEXT_FIELDS = {"repo_name", "language", "tier", "paradigm", "lang_type", "actor_login"}

# A message is one JSON text, so its list must be bounded. Lists that come from a top-k are
# far below this; longer ones go out in parts (``list_messages``) and are never cut.
MESSAGE_ROWS = 10_000


def _item(fields: dict[str, str]) -> Column:
    return F.struct(*[F.col(c).alias(name) for c, name in fields.items()])


def list_message(
    rows: DataFrame, kind: str, order: list[str], descending: bool = False
) -> DataFrame:
    """One message with all rows, ordered by the given columns; for lists that are bounded already."""
    name, fields = LIST_KINDS[kind]
    direction = F.desc if descending else F.asc
    bounded = rows.orderBy(*[direction(c) for c in order]).limit(MESSAGE_ROWS + 1)
    # Rows reach collect_list in no fixed order, so each carries its sort position.
    entry = F.struct(F.struct(*order).alias("at"), _item(fields).alias("v"))
    items = F.sort_array(F.collect_list(entry), asc=not descending)
    message = bounded.agg(items.alias("items")).select(
        F.lit(kind).alias("type"),
        F.when(
            F.size("items") <= MESSAGE_ROWS, F.transform("items", lambda e: e["v"])
        )
        .otherwise(F.raise_error(F.lit(f"{kind}: more than {MESSAGE_ROWS} rows")))
        .alias(name),
    )
    return message.select("type", F.to_json(F.struct("type", name)).alias("body"))


def list_messages(
    rows: DataFrame,
    kind: str,
    order: list[str],
    staging: str,
    descending: bool = False,
    part_rows: int = MESSAGE_ROWS,
) -> DataFrame:
    """``list_message`` of a list of any length: numbered parts of at most ``part_rows`` rows.

    A row's place is a running count over ranges of the order (ties fall by the other fields), so no task sees
    more than a range or a part. One part looks as ``list_message`` does; of several each has ``part``, from
    1, and ``parts``. The first replaces what a reader shows, the others add to it. No rows give
    one message with an empty list.
    """
    name, fields = LIST_KINDS[kind]
    direction = F.desc if descending else F.asc
    total_order = [direction(c) for c in [*order, *[c for c in fields if c not in order]]]
    picked = rows.select(*fields).withColumn("one", F.lit(1).cast("long"))
    placed = with_earlier(picked, total_order, "one", "sum", staging).withColumn(
        "place", F.coalesce("earlier", F.lit(0).cast("long"))
    )
    number = F.expr(f"place div {part_rows}")
    entry = F.struct("place", _item(fields).alias("v"))
    filled = placed.groupBy(number.alias("at")).agg(F.sort_array(F.collect_list(entry)).alias("items"))
    last = F.greatest(F.expr(f"(count(one) - 1) div {part_rows}"), F.lit(0).cast("long"))
    parts = placed.agg(last.alias("last")).select(
        F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("at"), (F.col("last") + 1).alias("parts")
    )
    several = F.col("parts") > 1
    return parts.join(filled, "at", "left").select(
        F.lit(kind).alias("type"),
        F.to_json(
            F.struct(
                F.lit(kind).alias("type"),
                F.when(several, F.col("at") + 1).alias("part"),
                F.when(several, F.col("parts")).alias("parts"),
                F.coalesce(F.transform("items", lambda e: e["v"]), F.array()).alias(name),
            )
        ).alias("body"),
    )


def item_messages(rows: DataFrame, kind: str) -> DataFrame:
    """One message per row."""
    name, fields = ITEM_KINDS[kind]
    body = F.struct(F.lit(kind).alias("type"), _item(fields).alias(name))
    return rows.select(F.lit(kind).alias("type"), F.to_json(body).alias("body"))


def all_messages(*messages: DataFrame) -> DataFrame:
    """Several message feeds as one, numbered by feed so that a reader can keep the order."""
    numbered = [m.withColumn("seq", F.lit(i).cast("long")) for i, m in enumerate(messages)]
    return reduce(DataFrame.unionByName, numbered)


def decode_messages(messages: DataFrame, kind: str, body: str = "body") -> DataFrame:
    """Rows carried by messages of one kind; other kinds, invalid text, and items that are not there
    or lack their first field give none."""
    is_list = kind in LIST_KINDS
    name, fields = (LIST_KINDS if is_list else ITEM_KINDS)[kind]
    item = T.StructType(
        [
            T.StructField(field, T.StringType() if c in TEXT_FIELDS else T.LongType())
            for c, field in fields.items()
        ]
    )
    schema = T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField(name, T.ArrayType(item) if is_list else item),
        ]
    )
    opened = messages.select(F.from_json(F.col(body), schema).alias("m")).where(
        F.col("m.type") == kind
    )
    content = F.explode(F.col(f"m.{name}")) if is_list else F.col(f"m.{name}")
    key = next(iter(fields.values()))
    return opened.select(content.alias("item")).where(F.col(f"item.{key}").isNotNull()).select(
        *[F.col(f"item.{field}").alias(c) for c, field in fields.items()]
    )
