"""Cohort retention of link visitors, by app, link, media and position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import text, times
from footfall.operators import enrich, filters, first_seen
from footfall.schema import RETENTION_DAYS

DEFAULT = "default"
MOST_DAYS = 62
DIMENSIONS = ("link_key", "media_id", "position_id")
_COLUMNS = ("ak", "op", "day", "et", "event_id", "att", "ifo", "link_key", "media_id", "scene", "pp")


def base_users(log: DataFrame) -> DataFrame:
    """Distinct (day, ak, op)."""
    return log.filter(text.present(F.col("op"))).select("day", "ak", "op").distinct()


def cohort_visits(log: DataFrame, links: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """One row per day, user and link visit, with a flag on a new user's first record.

    All cohort days in one pass; the link table is joined on app and link.
    """
    known = first_seen.slim(log.filter(filters.has_openid()), _COLUMNS)
    marked = first_seen.with_new_users(known, first_seen.first_seen(known, state))
    visits = marked.filter(text.present(F.col("link_key")) & text.present(F.col("pp")))
    return (
        enrich.add_position(enrich.add_media(visits, links))
        .groupBy("day", "ak", "op", *DIMENSIONS)
        .agg(F.max((F.col("ifo") == "true").cast("int")).alias("is_new"))
    )


def cohort_members(visits: DataFrame) -> DataFrame:
    """Distinct users per cohort: the app's (``default``) and one per link, media and position."""
    kinds = F.explode(F.array(*[F.lit(d) for d in (DEFAULT, *DIMENSIONS)]))
    value = F.lit(DEFAULT)
    for dim in DIMENSIONS:
        value = F.when(F.col("dimension") == dim, F.col(dim)).otherwise(value)
    return (
        visits.withColumn("dimension", kinds)
        .withColumn("dimension_value", value)
        .groupBy("day", "ak", "dimension", "dimension_value", "op")
        .agg(F.max("is_new").alias("is_new"))
    )


def return_days(base: DataFrame, days_after: int = RETENTION_DAYS) -> DataFrame:
    """Per cohort day and user one bit mask: bit n is set when the user came n days later.

    A visit on day d answers for the cohorts of d, d-1 ... d-7, so each visit gives eight
    small rows that fold into masks on the map side; no range join.
    """
    if not 0 <= days_after <= MOST_DAYS:
        raise ValueError(f"days_after must be 0 to {MOST_DAYS}, as a mask has that many bits")
    offset = F.explode(F.sequence(F.lit(0), F.lit(days_after))).alias("n")
    return (
        base.select("day", "ak", "op", offset)
        .select(times.shift_day(F.col("day"), -F.col("n")).alias("day"), "ak", "op", F.expr("shiftleft(1L, n)").alias("bit"))
        .groupBy("day", "ak", "op")
        .agg(F.bit_or("bit").alias("mask"))
    )


def retention(log: DataFrame, links: DataFrame, stat_days: DataFrame | None = None, state: DataFrame | None = None,
              days_after: int = RETENTION_DAYS) -> DataFrame:
    """Retention of every cohort up to a week later.

    ``stat_days`` (one column ``stat_day``) limits the days on which returns are counted;
    by default every day of the log is one. Cohort sizes and returned users are both
    shown; ratios of the cohort's own day read 0.
    """
    base = base_users(log)
    members = cohort_members(cohort_visits(log, links, state))
    joined = members.join(return_days(base, days_after), ["day", "ak", "op"], "left")
    came = [F.coalesce(F.getbit(F.col("mask"), F.lit(n)), F.lit(0)).cast("int") for n in range(days_after + 1)]
    sizes = joined.groupBy("day", "ak", "dimension", "dimension_value").agg(
        F.count("*").alias("visitor_count"),
        F.sum("is_new").alias("new_visitor_count"),
        *[F.sum(c).alias(f"_left{n}") for n, c in enumerate(came)],
        *[F.sum(c * F.col("is_new")).alias(f"_new{n}") for n, c in enumerate(came)],
    )
    by_offset = F.array(
        *[
            F.struct(F.lit(n).alias("day_after"), F.col(f"_left{n}").alias("people_left"), F.col(f"_new{n}").alias("new_people_left"))
            for n in range(days_after + 1)
        ]
    )
    keys = ["day", "ak", "dimension", "dimension_value", "visitor_count", "new_visitor_count"]
    rows = sizes.select(*keys, F.inline(by_offset)).withColumn(
        "stat_day", times.shift_day(F.col("day"), F.col("day_after"))
    )
    days = stat_days if stat_days is not None else base.select(F.col("day").alias("stat_day")).distinct()
    rows = rows.join(days, "stat_day", "left_semi")

    def share(part: str, whole: str):
        whole_or_null = F.nullif(F.col(whole), F.lit(0).cast("long"))
        value = F.coalesce(F.col(part) / whole_or_null, F.lit(0.0))
        return F.when(F.col("day_after") == 0, F.lit(0.0)).otherwise(value)

    return rows.withColumns(
        {
            "active_people_ratio": share("people_left", "visitor_count"),
            "new_people_ratio": share("new_people_left", "new_visitor_count"),
        }
    )
