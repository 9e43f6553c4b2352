"""Session tables. A session is named by the client (``att``), so no gaps are searched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.text import safe_ratio

SUMS = ["new_comer_count", "open_count", "one_page_count", "total_stay_time", "pages_sum", "pv"]


def session_seed(log: DataFrame) -> DataFrame:
    """One record as a session of its own."""
    return log.withColumns(
        {
            "pages": F.lit(1),
            "is_new": (F.col("ifo") == "true").cast("int"),
            "start_ms": F.col("et"),
            "end_ms": F.col("et"),
            "first_page": F.col("pp"),
            "stay": F.col("dr"),
        }
    )


def session_pages(log: DataFrame, dims: list[str]) -> DataFrame:
    """One row per visited page of a session. The only step that shuffles log rows, after map-side combine."""
    return log.groupBy(*dims, "att", "pp").agg(
        F.count("*").alias("pv"),
        F.min("et").alias("page_start"),
        F.max("et").alias("page_end"),
        F.max("dr").alias("stay"),
        F.max((F.col("ifo") == "true").cast("int")).alias("is_new"),
    )


def sessionize(log: DataFrame, dims: list[str]) -> DataFrame:
    """One row per (dims, att): pages, views, times, stay (longest reported), new flag, first page."""
    return of_pages(session_pages(log, dims), dims)


def merge_pages(pages: DataFrame) -> DataFrame:
    """Visited pages of several batches as those of one."""
    keys = [c for c in pages.columns if c not in ("pv", "page_start", "page_end", "stay", "is_new")]
    return pages.groupBy(*keys).agg(
        F.sum("pv").alias("pv"),
        F.min("page_start").alias("page_start"),
        F.max("page_end").alias("page_end"),
        F.max("stay").alias("stay"),
        F.max("is_new").alias("is_new"),
    )


def of_pages(pages: DataFrame, dims: list[str]) -> DataFrame:
    """Sessions from their visited pages."""
    return (
        pages.groupBy(*dims, "att")
        .agg(
            F.max("is_new").alias("is_new"),
            F.count("pp").alias("pages"),
            F.sum("pv").alias("pv"),
            F.min("page_start").alias("start_ms"),
            F.max("page_end").alias("end_ms"),
            F.max("stay").alias("stay"),
            F.min_by("pp", F.struct("page_start", "pp")).alias("first_page"),
        )
    )


def session_sums(sessions: DataFrame, dims: list[str]) -> DataFrame:
    """Mergeable sums per base key."""
    return sessions.groupBy(*dims).agg(
        F.sum("is_new").alias("new_comer_count"),
        F.count("*").alias("open_count"),
        F.count_if(F.col("pages") == 1).alias("one_page_count"),
        F.sum("stay").alias("total_stay_time"),
        F.sum("pages").alias("pages_sum"),
        F.sum("pv").alias("pv"),
    )


def entry_page_totals(log: DataFrame) -> DataFrame:
    """Sessions attributed to their first page."""
    return entry_totals_of(session_pages(log, ["ak", "day"]))


def entry_totals_of(pages: DataFrame) -> DataFrame:
    sessions = of_pages(pages, ["ak", "day"])
    return entry_ratios(
        sessions.groupBy("ak", "day", F.col("first_page").alias("page_path")).agg(
            F.count("*").alias("entry_page_count"),
            F.count_if(F.col("pages") == 1).alias("one_page_count"),
            F.sum("pv").alias("page_count"),
            F.count("*").alias("visitor_count"),
            F.count("*").alias("open_count"),
            F.sum("stay").alias("total_time"),
        )
    )


def entry_app_totals(by_page: DataFrame) -> DataFrame:
    """Entrance totals of the whole app."""
    sums = ["entry_page_count", "one_page_count", "page_count", "visitor_count", "open_count", "total_time"]
    return entry_ratios(by_page.groupBy("ak", "day").agg(*[F.sum(c).alias(c) for c in sums]))


def entry_ratios(totals: DataFrame) -> DataFrame:
    return totals.withColumns(
        {
            "avg_stay_time": safe_ratio(F.col("total_time"), F.col("open_count")),
            "bounce_rate": safe_ratio(F.col("one_page_count"), F.col("open_count")),
        }
    )


def visited_page_totals(log: DataFrame) -> DataFrame:
    """Per visited page: views, sessions, sessions that entered there or saw nothing else.

    The page count of a session is joined to its pages, both already reduced.
    """
    pages = session_pages(log, ["ak", "day"])
    whole = sessionize(log, ["ak", "day"]).select("ak", "day", "att", "pages", "first_page")
    joined = pages.join(whole, ["ak", "day", "att"])
    entered = F.col("pp") == F.col("first_page")
    return joined.groupBy("ak", "day", F.col("pp").alias("page_path")).agg(
        F.sum("pv").alias("page_count"),
        F.count("*").alias("open_count"),
        F.count_if(entered).alias("entry_page_count"),
        F.count_if(F.col("pages") == 1).alias("one_page_count"),
        F.sum("stay").alias("total_time"),
    )
