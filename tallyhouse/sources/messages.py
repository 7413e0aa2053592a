"""Message streams: Kafka, or files holding the same columns."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyhouse import schemas


def kafka_options(servers: str, topics: str, start: str | Mapping = "latest",
                  per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """Options of Spark's Kafka source.

    ``start`` is "latest" (orders), "earliest" (journal), or saved offsets as
    ``{topic: {partition: next offset}}``; a checkpoint takes precedence over all
    three. ``per_trigger`` caps the messages of one micro-batch.
    """
    if isinstance(start, Mapping):
        start = json.dumps({t: {str(p): o for p, o in ps.items()} for t, ps in start.items()})
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics,
               "startingOffsets": start, **extra}
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_messages(spark: SparkSession, **settings) -> DataFrame:
    """Messages from Kafka; needs the connector jar that matches the Spark version."""
    stream = spark.readStream.format("kafka").options(**kafka_options(**settings)).load()
    return stream.selectExpr("cast(value as string) as value", "topic", "partition", "offset",
                             "timestamp as message_time")


def file_messages(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """Messages from Parquet files, oldest file first."""
    reader = spark.readStream.schema(schemas.MESSAGE)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


def saved_offsets(rows: Iterable) -> dict[str, dict[int, int]]:
    """Rows (topic, partition, until_offset) as the ``start`` of :func:`kafka_options`."""
    offsets: dict[str, dict[int, int]] = {}
    for row in rows:
        offsets.setdefault(row["topic"], {})[row["partition"]] = row["until_offset"]
    return offsets
