"""Backfill: recompute a bounded part of the log and put the result over stored totals.

Every form here is exact and can run twice without changing the result again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators import metrics
from footfall.sinks.upsert import merge_totals


def in_hours(day: str, from_hour: str, to_hour: str) -> Column:
    return (F.col("day") == day) & F.col("hour").between(from_hour, to_hour)


def hours_between(log: DataFrame, day: str, from_hour: str, to_hour: str) -> DataFrame:
    return log.filter(in_hours(day, from_hour, to_hour))


def backfill_report(stored: DataFrame, log: DataFrame, report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run the ordinary report over whole days of the log and replace all stored rows of those days.

    A stored key that the days no longer have goes.
    """
    days = log.filter(F.col("day").isNotNull()).select("day").distinct()
    kept = stored.join(days, "day", "left_anti")
    return kept.unionByName(report(log).select(*stored.columns))


def replace_hour_views(daily: DataFrame, stored_hours: DataFrame, new_hours: DataFrame, dims: list[str]) -> DataFrame:
    """Daily page views after hours were counted again: daily + new hours - what they held.

    Hours not in ``new_hours`` keep their share. Differences are summed before they meet
    the daily rows, so no hour row is joined.
    """
    touched = stored_hours.join(new_hours.select(*dims, "hour"), [*dims, "hour"], "left_semi")
    changes = new_hours.select(*dims, "pv").unionByName(touched.select(*dims, (-F.col("pv")).alias("pv")))
    return metrics.add_counters(daily.select(*dims, "pv"), changes, dims, ["pv"])


def replace_hours(stored_hours: DataFrame, new_hours: DataFrame, dims: list[str]) -> DataFrame:
    """The hourly rows after the backfill."""
    return merge_totals(stored_hours, new_hours, [*dims, "hour"], policy="set")


def overwrite_views(stored: DataFrame, log: DataFrame, dims: list[str]) -> DataFrame:
    """Count all records of the touched keys again and replace their totals."""
    return merge_totals(stored, metrics.record_count(log, dims), dims, policy="set")


def overwrite_unique(stored: DataFrame, log: DataFrame, dims: list[str], identity: str = "uu") -> DataFrame:
    return merge_totals(stored, metrics.unique(log, dims, identity), dims, policy="set")


def add_unseen(stored: DataFrame, seen: DataFrame, log: DataFrame, dims: list[str], identity: str = "uu") -> DataFrame:
    """Add the identities that the seen-state does not hold to the stored distinct counts."""
    return metrics.add_counters(
        stored.select(*dims, "uv"), metrics.unique_increment(log, seen, dims, identity), dims, ["uv"]
    )
