"""Keyed upsert of result rows, as a table operation and onto a partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.traffic import add_ratios

SET, ACC, DAYS = "set", "acc", "days"


def merge_totals(stored: DataFrame, delta: DataFrame, keys: list[str], policy: str = SET,
                 sums: list[str] | None = None, ratios: list[str] | None = None) -> DataFrame:
    """Stored rows with the delta merged in by key.

    ``set`` replaces the stored row of a key, ``days`` all stored rows of the delta's days.
    ``acc`` adds the named sums; ratios are computed again from the sums, never added.
    """
    if policy == DAYS:
        kept = stored.join(delta.select("day").distinct(), "day", "left_anti")
        return kept.unionByName(delta.select(*stored.columns))
    if policy == SET:
        kept = stored.join(delta.select(*keys), keys, "left_anti")
        return kept.unionByName(delta.select(*stored.columns))
    if policy != ACC:
        raise ValueError(f"unknown policy {policy!r}")
    both = stored.select(*keys, *sums).unionByName(delta.select(*keys, *sums))
    merged = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    return add_ratios(merged, ratios) if ratios else merged


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def upsert_table(delta: DataFrame, path: str, staging: str, keys: list[str], policy: str = SET,
                 sums: list[str] | None = None, ratios: list[str] | None = None, partition: str = "day") -> None:
    """Merge a delta into a parquet table partitioned by day; other days are not read or written.

    The merged days are written to ``staging`` first and copied over from there, so the
    table is never read while it is replaced. ``staging`` names this one delta (a batch
    or backfill id): when it is already complete, an earlier attempt merged and may have
    replaced some days, and only the copy is repeated. That also keeps ``acc`` from
    adding a delta twice.
    """
    spark = delta.sparkSession
    if not _exists(spark, f"{staging}/_SUCCESS"):
        merged = delta
        if _exists(spark, path):
            stored = spark.read.schema(delta.schema).parquet(path)
            touched = stored.join(delta.select(partition).distinct(), partition, "left_semi")
            merged = merge_totals(touched, delta, keys, policy, sums, ratios)
        merged.write.mode("overwrite").parquet(staging)
    (
        spark.read.schema(delta.schema).parquet(staging)
        .hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
