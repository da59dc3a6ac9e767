"""Streaming input with the message-broker envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ENVELOPE = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def topic_options(brokers: str, topic: str, starting: str = "latest", per_trigger: int | None = None) -> dict[str, str]:
    """Options of the topic source; a replay starts from ``earliest`` under a new checkpoint."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, schema: str = ENVELOPE, **options) -> DataFrame:
    """A stream of envelopes. File formats take ``path`` and the schema; topics bring their own."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    return df.withColumn("value", df["value"].cast("string")) if "value" in df.columns else df
