"""Connected components by alternating large and small stars, all in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import staged


def _stars(edges: DataFrame) -> DataFrame:
    """One large star, then one small star; edges ``a > b`` in and out."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("hub"), F.least("a", "low").alias("low"))
    large = both.join(lowest, F.col("a") == F.col("hub")).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    lowest = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "hub")
    small = large.join(lowest, F.col("a") == F.col("hub")).where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return small.unionByName(lowest.select(F.col("hub").alias("a"), F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``a``, ``b``: each node that is not the smallest of its component, with the smallest.

    ``edges`` are pairs ``a > b`` of longs. Rounds grow with the logarithm of the size; only
    a count and a checksum of a round come to the driver. Hubs are met by joins on a
    pre-aggregated side, which Spark splits where they are large.
    """
    state = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    edges, before = staged(edges.select("a", "b").distinct(), "edges"), None
    while True:
        now = edges.agg(state).first()[0]
        if now == before or not now[0]:
            return edges
        edges, before = staged(_stars(edges), "edges"), now
