"""Stream records: the JSON envelope with the event as JSON text inside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgemeter import schemas

EVENT_TIMES = ("record", "envelope", "created_at")


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text in UTC of an instant, whatever the session time zone is."""
    wall = F.timestamp_add(
        "MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01").cast("timestamp_ntz")
    )
    return F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def encode_records(
    enriched: DataFrame,
    sent_at: Column | None = None,
    source: str = schemas.ENVELOPE_SOURCE,
) -> DataFrame:
    """Enriched events as ``(key, value)`` records ready for a topic.

    ``sent_at`` is the envelope time; the default is the start of the batch.
    """
    sent_at = F.current_timestamp() if sent_at is None else sent_at
    fields = [f.name for f in schemas.ENRICHED.fields if f.name in enriched.columns]
    envelope = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.lit(source).alias("source"),
        F.to_json(F.struct(*fields)).alias("payload"),
        F.unix_millis(sent_at).alias("timestamp"),
    )
    return enriched.select(
        F.col("event_id").cast("string").alias("key"), F.to_json(envelope).alias("value")
    )


def decode_records(records: DataFrame, event_time: str = "record") -> DataFrame:
    """Records to the six columns the statistics read.

    Text that is not JSON gives nulls, which the validity filter then drops, so one bad
    record never stops the others. ``event_time`` picks the clock: the record's own
    timestamp, the envelope's, or the event's ``created_at``.
    """
    if event_time not in EVENT_TIMES:
        raise ValueError(f"event_time must be one of {EVENT_TIMES}")
    envelope = _pick(
        schemas.ENVELOPE, ["payload"] + (["timestamp"] if event_time == "envelope" else [])
    )
    inner = _pick(
        schemas.ENRICHED,
        schemas.PAYLOAD.names + (["created_at"] if event_time == "created_at" else []),
    )
    raw = records.select(
        F.col("value").cast("string").alias("raw"),
        *([F.col("timestamp").alias("record_ts")] if event_time == "record" else []),
    )
    opened = _open_json(raw, "raw", envelope)
    if event_time == "envelope":
        opened = opened.select("payload", F.timestamp_millis("timestamp").alias("record_ts"))
    event = _open_json(opened, "payload", inner)
    if event_time == "created_at":
        event = event.withColumn("record_ts", F.try_to_timestamp("created_at"))
    return event.select(
        "event_type",
        "actor_login",
        "repo_name",
        F.col("trend_weight").cast("long").alias("trend_weight"),
        "language",
        F.col("record_ts").alias("event_ts"),
    )


def _open_json(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Replace a JSON column by its fields; nulls where the text is not such an object.

    ``inline`` makes this a generator, which filters do not move below. As a plain
    expression the parse would be repeated in every later condition on one of its fields.
    """
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.inline(F.array(F.from_json(text, schema))))


def _pick(schema, names):
    return T.StructType([f for f in schema.fields if f.name in names])
