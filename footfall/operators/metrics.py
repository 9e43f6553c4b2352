"""Plain counters per key: page views, distinct identities, new users, value sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators import filters


def page_views(log: DataFrame, dims: list[str]) -> DataFrame:
    """Records of the page level."""
    return log.groupBy(*dims).agg(F.count_if(F.col("ev") == "page").alias("pv"))


def record_count(log: DataFrame, dims: list[str]) -> DataFrame:
    """All records, as the share reports count."""
    return log.groupBy(*dims).agg(F.count("*").alias("pv"))


def unique(log: DataFrame, dims: list[str], identity: str = "uu", name: str = "uv") -> DataFrame:
    """Exact distinct count. A hot key is split by identity before it is counted."""
    return log.groupBy(*dims).agg(F.count_distinct(identity).alias(name))


def unique_ips(log: DataFrame, dims: list[str]) -> DataFrame:
    return unique(log, dims, "client_ip", "ips")


def opens(log: DataFrame, dims: list[str]) -> DataFrame:
    return unique(log, dims, "att", "open_count")


def new_users(log: DataFrame, dims: list[str], identity: str = "uu") -> DataFrame:
    new = F.when(F.col("ifo") == "true", F.col(identity))
    return log.groupBy(*dims).agg(F.count_distinct(new).alias("new_users"))


def views_and_visitors(log: DataFrame, dims: list[str], identity: str = "uu") -> DataFrame:
    """Page views and visitors in one pass over the records that show a page."""
    return (
        log.filter(filters.is_page_view())
        .groupBy(*dims)
        .agg(F.count("*").alias("pv"), F.count_distinct(identity).alias("uv"))
    )


def value_sum(log: DataFrame, dims: list[str], value: Column, name: str = "total") -> DataFrame:
    return log.groupBy(*dims).agg(F.sum(value).alias(name))


def add_counters(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Sum of two keyed counters."""
    return left.unionByName(right).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


def stored_counters(keys: DataFrame, totals: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Stored totals of the given keys, 0 where there are none."""
    return keys.join(totals.select(*on, *values), on, "left").na.fill(0, values)


def unseen(log: DataFrame, seen: DataFrame | None, dims: list[str], identity: str) -> DataFrame:
    """Distinct (dims, identity) pairs that the seen-state does not hold yet."""
    pairs = log.select(*dims, identity).distinct()
    return pairs if seen is None else pairs.join(seen, [*dims, identity], "left_anti")


def unique_increment(log: DataFrame, seen: DataFrame | None, dims: list[str], identity: str = "uu") -> DataFrame:
    """What a batch adds to the distinct count."""
    return unseen(log, seen, dims, identity).groupBy(*dims).agg(F.count("*").alias("uv"))


def app_versions(log: DataFrame) -> DataFrame:
    return log.select("ak", "day", "v").distinct()
