"""Batch jobs: run a report, route it, write it; and the backfills of each report family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators import backfill, enrich, filters, share
from footfall.operators.traffic import traffic_partials
from footfall.plans import reports
from footfall.plans.reports import Lookups
from footfall.plans.specs import JOBS, REPORTS
from footfall.sinks import publish
from footfall.sinks.upsert import DAYS, upsert_table

SHARE_REPORTS = {
    "daily_share_summary": (lambda log: reports.share_summary(log), ["te"]),
    "hourly_share_summary": (lambda log: reports.share_summary(log, by_hour=True), ["te", "hour"]),
    "daily_page_share": (reports.page_share, ["te", "page_uri", "source", "paras"]),
    "daily_user_share": (reports.user_share, ["te", "src", "layer"]),
}


def build(name: str, log: DataFrame, lookups: Lookups = Lookups()) -> DataFrame:
    if name in SHARE_REPORTS:
        return SHARE_REPORTS[name][0](log)
    return reports.report(name, log, lookups)


def keys_of(name: str) -> list[str]:
    """Key columns of a report's result table."""
    if name in SHARE_REPORTS:
        return ["ak", "day", *SHARE_REPORTS[name][1]]
    spec = REPORTS.get(name) or JOBS[name]
    return ["ak", "day", *(["level"] if len(spec.levels) > 1 else []), *spec.dims]


def table_of(path: str, name: str, route: str = publish.PROD) -> str:
    """Where a report's rows of a route are kept."""
    return f"{path}/{name}" if route == publish.PROD else f"{path}/{route}/{name}"


def run_job(name: str, log: DataFrame, path: str, run_id: str, lookups: Lookups = Lookups(),
            all_online: bool = True) -> None:
    """Run one report over whole days and put the days' rows into its table; ``run_id`` names the run for a safe repeat.

    Unless everything is online, apps go to the table of their route, released ones or grey.
    """
    rows = build(name, log, lookups)
    routed = enrich.route(rows, lookups.release) if not all_online else None
    for route in (publish.PROD,) if all_online else (publish.PROD, publish.GREY):
        own = rows if routed is None else publish.by_route(routed, route)
        upsert_table(own, table_of(path, name, route), f"{path}/_staged/{name}/{route}/{run_id}", keys_of(name), DAYS)


def backfill_days(name: str, stored: DataFrame, log: DataFrame, lookups: Lookups = Lookups()) -> DataFrame:
    """Recompute the log's days, which must be whole, and replace all of their stored rows."""
    return backfill.backfill_report(stored, log, lambda part: build(name, part, lookups))


def backfill_hours(name: str, stored: DataFrame, day_log: DataFrame, day: str, from_hour: str, to_hour: str,
                   lookups: Lookups = Lookups(), auth_state: DataFrame | None = None) -> DataFrame:
    """Replace some hours of an hourly report.

    Rows by day need the whole day (``backfill_days``): a visitor of two hours is one
    visitor of the day. New sessions and first authorisations are found in the day's whole
    log, then the hours are cut out; a session that only the backfilled hours show to be new
    is corrected in other hours by ``backfill_days``.
    """
    if "hour" not in keys_of(name):
        raise ValueError(f"{name} has no hour; use backfill_days")
    whole = day_log.filter(F.col("day") == day)
    marks = enrich.new_session_marks(whole)
    if name in SHARE_REPORTS:
        records = backfill.hours_between(filters.share_records(whole), day, from_hour, to_hour)
        fresh = share.share_totals(records, SHARE_REPORTS[name][1], marks)
    else:
        spec = REPORTS[name]
        rows = backfill.hours_between(reports.report_rows(spec, whole, lookups, auth_state), day, from_hour, to_hour)
        partials = traffic_partials(rows, spec.levels, spec.identity, spec.auth, spec.page_level)
        fresh = reports.finish(spec, partials, marks if spec.session_marks else None)
    shown = [c for c in stored.columns if c in fresh.columns]
    kept = stored.select(*shown).filter(~backfill.in_hours(day, from_hour, to_hour))
    return kept.unionByName(fresh.select(*shown))
