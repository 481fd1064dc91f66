"""Topic source and sink. Connection settings come from the environment or a mapping only."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from forgemeter import schemas

# Names and formats of the connection settings.
SERVERS, TOPIC = "KAFKA_BOOTSTRAP_SERVERS", "KAFKA_TOPIC"
PROTOCOL, MECHANISM = "KAFKA_SECURITY_PROTOCOL", "KAFKA_SASL_MECHANISM"
USERNAME, PASSWORD = "KAFKA_SASL_USERNAME", "KAFKA_SASL_PASSWORD"
DEFAULT_MECHANISM = "SCRAM-SHA-512"
LOGIN_MODULE = "org.apache.kafka.common.security.scram.ScramLoginModule"
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.linger.ms": "100",
    "kafka.batch.size": "16384",
    "kafka.max.block.ms": "10000",
}


def connection_options(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Broker and login options; login options appear only when a protocol is set."""
    env = os.environ if env is None else env
    options = {"kafka.bootstrap.servers": env[SERVERS]}
    protocol = env.get(PROTOCOL)
    if protocol:
        user, password = env[USERNAME], env[PASSWORD]
        options["kafka.security.protocol"] = protocol
        options["kafka.sasl.mechanism"] = env.get(MECHANISM) or DEFAULT_MECHANISM
        options["kafka.sasl.jaas.config"] = (
            f'{LOGIN_MODULE} required username="{user}" password="{password}";'
        )
    return options


def source_options(
    env: Mapping[str, str] | None = None, max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    """One topic from its start. The cap bounds a micro-batch after a long outage."""
    env = os.environ if env is None else env
    options = connection_options(env) | {
        "subscribe": env.get(TOPIC) or schemas.DEFAULT_TOPIC,
        "startingOffsets": "earliest",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def sink_options(env: Mapping[str, str] | None = None) -> dict[str, str]:
    env = os.environ if env is None else env
    return (
        connection_options(env)
        | PRODUCER_OPTIONS
        | {"topic": env.get(TOPIC) or schemas.DEFAULT_TOPIC}
    )


def read_topic(spark: SparkSession, env: Mapping[str, str] | None = None, **caps) -> DataFrame:
    """``(key, value, timestamp)`` as a stream."""
    stream = spark.readStream.format("kafka").options(**source_options(env, **caps)).load()
    return stream.select("key", "value", "timestamp")


def write_topic(records: DataFrame, env: Mapping[str, str] | None = None) -> None:
    records.select("key", "value").write.format("kafka").options(**sink_options(env)).save()


def topic_writer(
    records: DataFrame, checkpoint: str, env: Mapping[str, str] | None = None
) -> DataStreamWriter:
    return (
        records.select("key", "value")
        .writeStream.format("kafka")
        .options(**sink_options(env))
        .option("checkpointLocation", checkpoint)
    )
