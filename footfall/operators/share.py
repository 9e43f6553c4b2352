"""Share and return-visit metrics, both sides of a report in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.traffic import BASE, add_ratios

SHARER, SESSION, RETURNER = "sharer", "session", "returner"


_MEASURES = ("n", "is_new")


def share_partials(records: DataFrame, dims: list[str]) -> DataFrame:
    """One row per group and identity: what the totals are made of. Partials of parts of a log merge."""
    group = [*BASE, *dims]
    click = F.col("share_kind") == "click"
    kinds = F.when(click, F.array(F.lit(SESSION), F.lit(RETURNER))).otherwise(F.array(F.lit(SHARER)))
    entries = records.withColumn("kind", F.explode(kinds)).select(
        *group,
        "kind",
        F.when(F.col("kind") == SESSION, F.col("att")).otherwise(F.col("uu")).alias("id"),
        (F.col("ifo") == "true").cast("int").alias("is_new"),
    )
    return entries.groupBy(*group, "kind", "id").agg(F.count("*").alias("n"), F.max("is_new").alias("is_new"))


def merge_share(partials: DataFrame) -> DataFrame:
    """Partials of several batches as those of one."""
    keys = [c for c in partials.columns if c not in _MEASURES]
    return partials.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("is_new").alias("is_new"))


def share_totals(records: DataFrame, dims: list[str], marks: DataFrame | None = None) -> DataFrame:
    """Shares, sharers, return sessions, returning users and new sessions per (ak, day, dims).

    Shares and return visits land in the same groups, so a group that has only one of
    them gets zeros for the other without an outer join.
    """
    return finish_share(share_partials(records, dims), marks)


def finish_share(ids: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Totals from merged partials."""
    group = [c for c in ids.columns if c not in (*_MEASURES, "kind", "id")]
    if marks is not None:
        side = marks.select("day", F.col("att").alias("id"), F.lit(SESSION).alias("kind"), F.lit(1).alias("_mark"))
        ids = ids.join(side, ["day", "kind", "id"], "left").withColumn("is_new", F.greatest("is_new", "_mark"))
    kind = F.col("kind")
    totals = ids.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(kind == SHARER, F.col("n"))), F.lit(0)).alias("share_count"),
        F.count_if(kind == SHARER).alias("share_user_count"),
        F.count_if(kind == SESSION).alias("share_open_count"),
        F.count_if(kind == RETURNER).alias("share_open_user_count"),
        F.coalesce(F.sum(F.when(kind == SESSION, F.col("is_new"))), F.lit(0)).alias("new_count"),
    )
    return add_ratios(totals, ["share_reflux_ratio"])


def fill_from_stored(batch: DataFrame, stored: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """A zero of the batch takes the stored total of its key."""
    side = stored.select(*keys, *[F.col(v).alias(f"_{v}") for v in values])
    joined = batch.join(side, keys, "left")
    filled = {v: F.when(F.col(v) == 0, F.coalesce(F.col(f"_{v}"), F.lit(0))).otherwise(F.col(v)) for v in values}
    return joined.withColumns(filled).drop(*[f"_{v}" for v in values])
