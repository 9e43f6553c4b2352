"""Reports: normalised log and lookups in, result rows out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall import schema as S
from footfall.functions import text, times, versions
from footfall.operators import enrich, filters, first_seen, metrics, rollup, sessions, share
from footfall.operators.traffic import BASE, add_ratios, level_name, totals_of, traffic_partials
from footfall.plans.specs import ALL_RATIOS, JOBS, REPORTS, TERMINAL, TERMINAL_DIMS, VISIT_RATIOS, ReportSpec


@dataclass(frozen=True)
class Lookups:
    """Side tables; a report reads those it needs, folded to one row per key (``sources.lookups``)."""

    scenes: DataFrame | None = None
    qr_codes: DataFrame | None = None
    links: DataFrame | None = None
    media: DataFrame | None = None
    phones: DataFrame | None = None
    release: DataFrame | None = None


def _prepare(log: DataFrame, spec: ReportSpec, lookups: Lookups) -> DataFrame:
    rows = filters.require(log, spec.family)
    if spec.drop_app_level:
        rows = filters.without_app_level(rows)
    if spec.family == "scene":
        return enrich.add_scene_group(rows, lookups.scenes)
    if spec.family == "qr":
        return enrich.add_qr_group(rows, lookups.qr_codes)
    if spec.family in ("link", "ad"):
        return enrich.add_position(enrich.add_media(rows, lookups.links))
    if spec.family == "phone":
        return enrich.add_phone(rows, lookups.phones)
    return rows


# What the report core and the marking of users read, beside the dimensions.
_CORE = ("ak", "day", "att", "pp", "uu", "op", "ev", "dr", "ifo", "img", "et", "event_id")


def columns_of(spec: ReportSpec) -> list[str]:
    """What a report reads of the log."""
    return list(dict.fromkeys((*_CORE, "v", *filters.REQUIRED[spec.family], *spec.dims)))


def report_rows(spec: ReportSpec, log: DataFrame, lookups: Lookups = Lookups(), auth_state: DataFrame | None = None,
                strict: bool = False) -> DataFrame:
    """The filtered and enriched rows a report counts."""
    rows = first_seen.slim(_prepare(log, spec, lookups), (*_CORE, *spec.dims))
    return _with_authorisations(rows, log, auth_state, strict) if spec.auth else rows


def report_partials(spec: ReportSpec, log: DataFrame, lookups: Lookups = Lookups(), auth_state: DataFrame | None = None,
                    strict: bool = False) -> DataFrame:
    """What the report's totals are made of. ``strict`` marks users by the rule of streams."""
    rows = report_rows(spec, log, lookups, auth_state, strict)
    return traffic_partials(rows, spec.levels, spec.identity, spec.auth, spec.page_level)


def finish(spec: ReportSpec, partials: DataFrame, marks: DataFrame | None) -> DataFrame:
    """Result columns of a report from its merged partials."""
    result = add_ratios(totals_of(partials, spec.levels, marks, spec.auth), spec.ratios)
    shown = [*spec.metrics, *(["new_auth_count"] if spec.auth else []), *spec.ratios]
    level = ["level"] if len(spec.levels) > 1 else []
    return result.select(*BASE, *level, *spec.dims, *shown)


def run(spec: ReportSpec, log: DataFrame, lookups: Lookups = Lookups(), auth_state: DataFrame | None = None) -> DataFrame:
    """One report, or several levels of it in one pass (then with a ``level`` column)."""
    marks = enrich.new_session_marks(log) if spec.session_marks else None
    return finish(spec, report_partials(spec, log, lookups, auth_state), marks)


def _with_authorisations(rows: DataFrame, log: DataFrame, auth_state: DataFrame | None, strict: bool) -> DataFrame:
    """Append the records that count as a first authorisation.

    With an open id: the first authorisation of (ak, op) that the state does not hold.
    Without: authorisations in a new session, which may have been marked by any record.
    Both are found on the few authorisation records only.
    """
    firsts = first_seen.first_seen(first_seen.auth_records(rows), auth_state, first_seen.AUTH, strict=strict)
    anonymous = rows.filter(~filters.has_openid() & filters.is_authorised())
    marks = enrich.new_session_marks(log).withColumn("_new", F.lit(True))
    marked = anonymous.join(marks, ["day", "att"], "left").filter((F.col("ifo") == "true") | F.col("_new"))
    result = first_seen.with_first_auth(first_seen.counted(rows), firsts)
    return first_seen.append_marks(result, marked.drop("_new").select(*rows.columns), _auth_id=F.col("uu"))


def report(name: str, log: DataFrame, lookups: Lookups = Lookups(), auth_state: DataFrame | None = None,
           openid_of_session: bool = False) -> DataFrame:
    """A report by name. ``openid_of_session`` first gives records without an open id that of their session."""
    spec = REPORTS.get(name) or JOBS[name]
    log = enrich.propagate_openid(log) if openid_of_session else log
    result = run(spec, log, lookups, auth_state)
    if name == "hourly_trend":
        result = result.withColumn("avg_refresh_count", F.lit(0))
    return result


# -- share ------------------------------------------------------------------------


def share_summary(log: DataFrame, by_hour: bool = False) -> DataFrame:
    dims = ["te", *(["hour"] if by_hour else [])]
    return share.share_totals(filters.share_records(log), dims, enrich.new_session_marks(log))


def page_share(log: DataFrame) -> DataFrame:
    """By page and utm source, whole: a sink whose column is narrower cuts what it shows, not what is counted."""
    return share.share_totals(page_share_records(log), PAGE_SHARE, enrich.new_session_marks(log))


PAGE_SHARE = ["te", "page_uri", "source", "paras"]


def page_share_records(log: DataFrame) -> DataFrame:
    return filters.share_records(log).withColumns(
        {"source": F.col("ct_utm_s"), "paras": F.col("ct_utm_p"), "page_uri": F.col("path")}
    )


USER_SHARE = ["te", "src", "layer"]


def user_share_records(log: DataFrame) -> DataFrame:
    return enrich.add_share_chain(filters.share_records(log)).filter(text.present(F.col("src")))


def user_share(log: DataFrame) -> DataFrame:
    """By sharer and sharing degree, with the sharer's latest city and gender."""
    totals = share.share_totals(user_share_records(log), USER_SHARE, enrich.new_session_marks(log))
    return with_profiles(totals, enrich.sharer_profiles(log), ["ak"])


def with_profiles(totals: DataFrame, profiles: DataFrame, keys: list[str]) -> DataFrame:
    """User share totals with the sharers' profiles; sharers without one read unknown."""
    joined = totals.drop("share_user_count").join(profiles.withColumnRenamed("uu", "src"), [*keys, "src"], "left")
    return joined.na.fill(S.UNKNOWN, ["city", "gender"])


# -- advertising ------------------------------------------------------------------


AD_COLUMNS = (*_CORE, "hour", "scene", "link_key", "media_id")
AD_METRICS = ["new_auth_count", "visitor_count", "open_count", "new_comer_count", "total_stay_time", "one_page_count"]


def _ad_rows(log: DataFrame, new_state: DataFrame | None, strict: bool = False) -> DataFrame:
    """Records with an open id; only the first record of a new user says so."""
    known = log.filter(filters.has_openid() & text.present(F.col("ak")) & F.col("et").isNotNull())
    known = first_seen.slim(known, AD_COLUMNS)
    return first_seen.with_new_users(known, first_seen.first_seen(known, new_state, first_seen.NEW_USER, strict=strict))


def _ad_link_rows(rows: DataFrame, links: DataFrame) -> DataFrame:
    return enrich.add_position(enrich.add_media(filters.require(rows, "ad"), links))


def _ad_partials(rows: DataFrame, levels, auth_state: DataFrame | None, strict: bool = False) -> DataFrame:
    real = rows.filter(F.col("_counted") == 1)
    firsts = first_seen.first_seen(first_seen.auth_records(real), auth_state, first_seen.AUTH, strict=strict)
    marked = first_seen.with_first_auth(rows, firsts.drop("_counted", "_auth_first", "_auth_id"))
    return traffic_partials(marked, levels, "op", auth=True)


def _ad_totals(partials: DataFrame, levels) -> DataFrame:
    """New users never exceed visitors."""
    totals = totals_of(partials, levels, auth=True)
    return totals.withColumn("new_comer_count", F.least("new_comer_count", "visitor_count"))


def ad_link_partials(log: DataFrame, links: DataFrame, levels=rollup.LINK_LEVELS, new_state: DataFrame | None = None,
                     auth_state: DataFrame | None = None, strict: bool = False) -> DataFrame:
    return _ad_partials(_ad_link_rows(_ad_rows(log, new_state, strict), links), levels, auth_state, strict)


def finish_ads(partials: DataFrame, levels=rollup.LINK_LEVELS) -> DataFrame:
    """Result columns of the advertising reports from their merged partials."""
    dims = list(dict.fromkeys(d for level in levels for d in level))
    totals = add_ratios(_ad_totals(partials, levels), VISIT_RATIOS)
    return totals.select(*BASE, *(["level"] if len(levels) > 1 else []), *dims, *AD_METRICS, *VISIT_RATIOS)


def ad_reports(log: DataFrame, links: DataFrame, levels=rollup.LINK_LEVELS, new_state: DataFrame | None = None,
               auth_state: DataFrame | None = None) -> DataFrame:
    """Link visits by every level in one pass: visitors by open id, exact at each level."""
    return finish_ads(ad_link_partials(log, links, levels, new_state, auth_state), levels)


def app_totals(log: DataFrame, by_hour: bool = False, new_state: DataFrame | None = None,
               auth_state: DataFrame | None = None) -> DataFrame:
    """Visitors, new users and authorisations of the whole app, with or without a link."""
    rows, levels = _ad_rows(log, new_state), (("hour",) if by_hour else (),)
    return _app_columns(_ad_totals(_ad_partials(rows, levels, auth_state), levels), by_hour)


def _app_columns(totals: DataFrame, by_hour: bool) -> DataFrame:
    return totals.select(
        *BASE,
        *(["hour"] if by_hour else []),
        F.col("visitor_count").alias("total_visitor_count"),
        F.col("new_comer_count").alias("total_newer_for_app"),
        F.col("new_auth_count").alias("total_new_auth_user"),
    )


def ad_home(log: DataFrame, links: DataFrame, by_hour: bool = False, new_state: DataFrame | None = None,
            auth_state: DataFrame | None = None) -> DataFrame:
    """Link totals beside the whole app's totals."""
    return finish_home(home_partials(log, links, by_hour, new_state, auth_state, auth_state), by_hour)


def home_partials(log: DataFrame, links: DataFrame, by_hour: bool = False, new_state: DataFrame | None = None,
                  link_auth: DataFrame | None = None, app_auth: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Partials of the link visits and of the whole app, told apart by ``side``."""
    level = ("hour",) if by_hour else ()
    rows = _ad_rows(log, new_state, strict)
    link = _ad_partials(_ad_link_rows(rows, links), (level,), link_auth, strict)
    app = _ad_partials(rows, (level,), app_auth, strict)
    return link.withColumn("side", F.lit("link")).unionByName(app.withColumn("side", F.lit("app")))


def finish_home(partials: DataFrame, by_hour: bool = False) -> DataFrame:
    level = ("hour",) if by_hour else ()
    side = lambda name: partials.filter(F.col("side") == name).drop("side")
    return finish_ads(side("link"), (level,)).join(_app_columns(_ad_totals(side("app"), (level,)), by_hour), [*BASE, *level])


# -- devices, pages, versions -----------------------------------------------------


def terminal(log: DataFrame) -> DataFrame:
    """Seven device dimensions stacked as (type, type_value)."""
    return stack_terminal(run(TERMINAL, terminal_rows(log)))


def terminal_rows(log: DataFrame) -> DataFrame:
    return log.withColumn("ww_wh", F.concat_ws("*", "ww", "wh"))


def stack_terminal(stacked: DataFrame) -> DataFrame:
    value = F.lit(None).cast("string")
    for dim in TERMINAL_DIMS:
        value = F.when(F.col("level") == level_name((dim,)), F.col(dim)).otherwise(value)
    return (
        stacked.withColumn("type_value", value)
        .withColumnsRenamed({"level": "type", "secondary_avg_stay_time": "avg_stay_time"})
        .drop(*TERMINAL_DIMS)
    )


def entry_rows(log: DataFrame) -> DataFrame:
    return filters.require(log, "entrance").filter((F.col("ev") == "page") & (F.col("pp") != "undefined"))


def entry_pages(log: DataFrame) -> DataFrame:
    return sessions.entry_page_totals(entry_rows(log))


def entry_app(log: DataFrame) -> DataFrame:
    return sessions.entry_app_totals(entry_pages(log))


def sdk_versions(log: DataFrame) -> DataFrame:
    """SDK versions in use per app, with the third-party flag."""
    rows = metrics.app_versions(filters.require(log, "version"))
    return rows.filter(versions.is_proper_sdk(F.col("v"))).select(
        "ak", "day", F.col("v").alias("version"), versions.is_third_party(F.col("v")).alias("is_third")
    )


def activity_detail(log: DataFrame, links: DataFrame, media: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """One row per app, hour, user, activity and channel, with first-visit and authorisation marks.

    Flags read 0 for yes. A user's first visit is their first record that reports a first
    open, unless the state knows them; the row that holds it is the new one.
    """
    rows = activity_rows(log, links, media)
    firsts = activity_firsts(rows, state)
    known = firsts.select("ak", "op", F.col("first_at").alias("first_ts"))
    if state is not None:
        stored = first_seen.state_of(state, first_seen.ACTIVITY, "first_ts")
        known = known.unionByName(stored).groupBy("ak", "op").agg(F.min("first_ts").alias("first_ts"))
    return finish_activity(rows.groupBy(*ACTIVITY_KEYS).agg(F.max("et").alias("last_at")), firsts, known)


ACTIVITY_KEYS = ["ak", "op", "day", "hour", "activity", "channel"]


def activity_rows(log: DataFrame, links: DataFrame, media: DataFrame) -> DataFrame:
    rows = filters.require(log, "activity").filter(filters.has_openid())
    return first_seen.slim(enrich.add_activity_channel(rows, links, media), [*ACTIVITY_KEYS, "et", "event_id", "ifo", "img"])


def activity_firsts(rows: DataFrame, state: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Users' first visits: their keys, time, and whether they authorised."""
    firsts = first_seen.first_seen(rows.filter(F.col("ifo") == "true"), state, first_seen.ACTIVITY, strict=strict)
    return firsts.select(*ACTIVITY_KEYS, F.col("et").alias("first_at"), filters.is_authorised().alias("authorised"))


def finish_activity(visits: DataFrame, firsts: DataFrame, known: DataFrame) -> DataFrame:
    """Detail rows from last visits per key, first visits, and the times at which users were first seen."""
    new = firsts.withColumn("_new", F.lit(True))
    joined = visits.join(new, ACTIVITY_KEYS, "left").join(known, ["ak", "op"], "left")
    is_new, is_auth = F.coalesce("_new", F.lit(False)), F.coalesce("authorised", F.lit(False))
    clock = "yyyy-MM-dd HH:mm:ss"
    visited = F.when(F.col("first_ts") <= F.col("last_at"), times.format_millis(F.col("first_ts"), clock))
    return joined.select(
        "ak", "day", "hour", "activity", "channel", F.col("op").alias("openid"),
        F.when(is_new, 0).otherwise(1).alias("is_new_user"),
        F.coalesce(visited, F.lit(S.NO_TIME)).alias("first_visit_time"),
        F.when(is_auth, 0).otherwise(1).alias("is_new_authorization"),
        F.when(is_auth, times.format_millis(F.col("first_at"), clock)).otherwise(S.NO_TIME).alias("authorization_time"),
    )


def debug_trend(debug_log: DataFrame, by_hour: bool = False) -> DataFrame:
    """The trend report over the log of apps under debugging; its sink has tables of its own."""
    return report("hourly_trend" if by_hour else "daily_trend", debug_log)


__all__ = [
    "ALL_RATIOS", "Lookups", "activity_detail", "ad_home", "ad_reports", "app_totals", "debug_trend", "entry_app",
    "entry_pages", "page_share", "report", "run", "sdk_versions", "share_summary", "terminal", "user_share",
]
