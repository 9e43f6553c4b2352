"""Result rows to Kafka topics and on to databases, as data with a key and a route."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

PROD, GREY, DEBUG = "prod", "grey", "debug"


def message_key(columns: list[str]) -> Column:
    """``ak:te`` where the row has a platform, else ``ak``."""
    return F.concat_ws(":", "ak", *(["te"] if "te" in columns else []))


def to_messages(rows: DataFrame, report: str, topics: dict[str, str] | None = None) -> DataFrame:
    """Kafka rows: key, JSON value, and a topic by the row's route where ``topics`` maps one."""
    names = [c for c in rows.columns if c != "route"]
    value = F.to_json(F.struct(F.lit(report).alias("report"), *names), {"ignoreNullFields": "false"})
    messages = rows.select(*(["route"] if "route" in rows.columns else []), message_key(names).alias("key"), value.alias("value"))
    if topics is None or "route" not in rows.columns:
        return messages
    topic = F.coalesce(*[F.when(F.col("route") == route, F.lit(name)) for route, name in topics.items()])
    return messages.withColumn("topic", topic).drop("route")


def from_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Published rows back as columns."""
    parsed = messages.select(F.from_json(F.col("value").cast("string"), schema).alias("r"))
    return parsed.filter(F.col("r").isNotNull()).select("r.*")


def write_kafka(messages: DataFrame, servers: str, topic: str | None = None) -> None:
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    (writer.option("topic", topic) if topic else writer).save()


def copy_topic(source: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Topic to topic."""
    return (
        source.select("key", "value").writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint).start()
    )


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    """Into a staging table of the database; partitions write side by side."""
    rows.write.jdbc(url, table, mode, {"batchsize": "5000", **properties})


def apply_messages(messages: DataFrame, schema: T.StructType, apply: Callable[[DataFrame, int], None], checkpoint: str,
                   **trigger) -> StreamingQuery:
    """Consume published rows and hand every batch with its id to an idempotent writer."""

    def each(batch: DataFrame, batch_id: int) -> None:
        apply(from_messages(batch, schema), batch_id)

    return (
        messages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def by_route(rows: DataFrame, route: str) -> DataFrame:
    return rows.filter(F.col("route") == route).drop("route")
