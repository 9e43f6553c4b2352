"""Lookup tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    return spark.read.jdbc(url, table, properties=properties)


def lookup_first_wins(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """One lookup out of several databases: a key takes its row from the first source that has it.

    Rows fold to the smallest (source, values) per key on the map side.
    """
    numbered = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    rows = reduce(DataFrame.unionByName, numbered)
    values = [c for c in sources[0].columns if c not in keys]
    if not values:
        return rows.select(*keys).distinct()
    best = F.min(F.struct("_source", *values)).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, *[f"_best.{v}" for v in values])


def link_lookup(links: DataFrame) -> DataFrame:
    """Links that are not deleted, one row per (app, link)."""
    live = links.filter(F.col("is_del").cast("int") == 0)
    return lookup_first_wins([live], ["app_key", "link_key"])


def scene_lookup(scenes: DataFrame) -> DataFrame:
    return lookup_first_wins([scenes], ["te", "scene_id"])


def qr_lookup(codes: DataFrame) -> DataFrame:
    return lookup_first_wins([codes], ["app_key", "qr_key"])


def phone_lookup(phones: DataFrame) -> DataFrame:
    return lookup_first_wins([phones], ["uname"])
