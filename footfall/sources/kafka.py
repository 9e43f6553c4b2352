"""Kafka sources. The operators take any DataFrame with a text ``value``; these build one."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_OFFSETS = 4_000_000


def stream_options(servers: str, topic: str, starting: str | dict = "latest", max_offsets: int | None = None) -> dict[str, str]:
    """Options of a stream. ``starting`` matters on the first start only; later the checkpoint says where to go on.

    Offsets that the topic no longer holds end the stream instead of being skipped.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting if isinstance(starting, str) else json.dumps(starting),
        "failOnDataLoss": "true",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def range_options(servers: str, topic: str, start: dict[int, int], end: dict[int, int]) -> dict[str, str]:
    """Options of a bounded read by offsets per partition."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": json.dumps({topic: {str(p): o for p, o in start.items()}}),
        "endingOffsets": json.dumps({topic: {str(p): o for p, o in end.items()}}),
    }


def time_range_options(servers: str, topic: str, partitions: int, from_ms: int, to_ms: int) -> dict[str, str]:
    """Options of a bounded read by time."""
    every = {str(p): from_ms for p in range(partitions)}
    until = {str(p): to_ms for p in range(partitions)}
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsetsByTimestamp": json.dumps({topic: every}),
        "endingOffsetsByTimestamp": json.dumps({topic: until}),
        "startingOffsetsByTimestampStrategy": "latest",
    }


def clamp_offsets(saved: dict[int, int], earliest: dict[int, int], end: dict[int, int]) -> dict[int, int]:
    """Saved offsets moved into what the topic still holds."""
    return {p: min(max(saved.get(p, end[p]), earliest.get(p, 0)), end[p]) for p in end}


def lines(source: DataFrame) -> DataFrame:
    """Kafka rows as log lines with arrival time and a row id that a replay gives again."""
    return source.select(
        F.col("value").cast("string").alias("value"),
        F.unix_millis("timestamp").alias("ingest_ms"),
        F.concat_ws("-", "topic", "partition", "offset").alias("event_id"),
    )


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return lines(spark.readStream.format("kafka").options(**options).load())


def read_range(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return lines(spark.read.format("kafka").options(**options).load())
