"""Streams over the event table: read as files in micro-batches, checked against the batch totals."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import times
from footfall.operators import first_seen, metrics
from footfall.operators.filters import has_openid
from footfall.plans.specs import AD_LEVELS, JOBS, REPORTS
from footfall.sinks import publish
from footfall.sinks.upsert import upsert_table
from footfall.streaming import ingest, reports, sessions, uniques
from footfall.workload.log import log_of, lookup, lookups_of, oracle_ctes
from footfall.workload.normalising import raw_lines, raw_trend_check
from footfall.workload.oracle import traffic
from footfall.workload.registry import ORACLES, over_log, query
from footfall.workload.storing import place

#: Files of one micro-batch; they are written and read side by side.
FILES = 24
#: Cuts between the batches of an ordered stream, one of them inside a day.
CUTS = ("timestamp '2024-01-10 12:00:00'", "timestamp '2024-01-21 00:00:00'")
DAY_MS = 86_400_000


def job_day() -> Column:
    """The day a record arrived."""
    return times.day_of(F.col("ingest_ms"))


def log_stream(spark: SparkSession, sf_dir: str, root: str, ordered: bool = False, lateness: str = "0") -> DataFrame:
    """The log as files, read in three micro-batches, with its arrival time ``ingest_ms``.

    Records of one session are spread over all batches; or, ``ordered``, batches follow the
    arrival. ``lateness`` is how many ms a record arrives after it happened.
    """
    log = log_of(spark, sf_dir).withColumn("ingest_ms", F.col("et") + F.expr(lateness).cast("long"))
    if ordered:
        arrived = [f"ingest_ms < unix_millis({cut})" for cut in CUTS]
        parts = [arrived[0], f"{arrived[1]} and not ({arrived[0]})", f"not ({arrived[1]})"]
    else:
        parts = [f"pmod(xxhash64(event_id), 3) = {i}" for i in range(3)]
    return staged_stream(spark, [log.filter(part) for part in parts], f"{root}/input")


def staged_stream(spark: SparkSession, parts: list[DataFrame], path: str) -> DataFrame:
    """Tables as the micro-batches of a file stream, in this order. Rows are dealt by their id, as Spark sorts
    wide rows whole to deal them in turn."""
    for part in parts:
        part.repartition(FILES, "event_id").write.mode("append").parquet(path)
    return ingest.file_stream(spark, path, parts[0].schema, FILES)


def _root(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A new folder per run: a checkpoint must not meet another run's input."""
    return f"{place(spark, sf_dir, name)}/{uuid.uuid4().hex}"


def _totals(spark: SparkSession, kept: reports.ReportTables) -> DataFrame:
    return spark.read.parquet(kept.totals).withColumn("day", F.col("day").cast("string"))


_SPECS = (
    "trend_job", "daily_scene", "qr_job", "region_job", "phone_job", "daily_link", "link_expansion", "link_monitor_cube",
)
for _name in _SPECS:

    @query(f"stream_{_name}", ORACLES[_name])
    def _stream(spark, sf, name=_name):
        root = _root(spark, sf, f"stream_{name}")
        spec = REPORTS.get(name) or JOBS[name]
        # First authorisations go to the first arrival, so these get their log in order.
        stream = log_stream(spark, sf, root, ordered=spec.auth)
        kept = reports.ReportTables(root, spec.name)
        ingest.run_available(reports.stream_report(stream, spec, root, lookups_of(spark)), kept.checkpoint)
        return _totals(spark, kept)


#: A streamed sharer's profile is the latest of the day, as of a batch job over one day.
_OF_DAY = (
    ORACLES["daily_user_share"]
    .replace("select ak, uu as src, case when city", "select ak, day, uu as src, case when city")
    .replace("partition by ak, uu order by", "partition by ak, uu, day order by")
    .replace("p.src = t.src", "p.src = t.src and p.day = t.day")
)

for _name in reports.STREAMED:

    @query(f"stream_{_name}", _OF_DAY if _name == "daily_user_share" else ORACLES[_name])
    def _streamed(spark, sf, name=_name):
        root = _root(spark, sf, f"stream_{name}")
        kept = reports.ReportTables(root, name)
        ingest.run_available(reports.stream(log_stream(spark, sf, root), name, root), kept.checkpoint)
        return _totals(spark, kept)


@query("stream_two_runs", ORACLES["daily_scene"])
def _two_runs(spark, sf):
    """A live stream, then a backfill of what it missed, with a checkpoint of its own, into the same tables."""
    root, spec = _root(spark, sf, "two_runs"), REPORTS["daily_scene"]
    log = log_of(spark, sf)
    for run, part in (("live", "event_id % 3 > 0"), ("again", "event_id % 3 = 0")):
        missed = staged_stream(spark, [log.filter(part)], f"{root}/{run}")
        kept = reports.ReportTables(root, spec.name, run)
        ingest.run_available(reports.stream_report(missed, spec, root, lookups_of(spark), run=run), kept.checkpoint)
    return _totals(spark, kept)


@query("stream_raw_trend", raw_trend_check())
def _raw(spark, sf):
    """From JSON lines to the report in one stream; some lines are cut off, and each batch has lines of all days."""
    root, spec = _root(spark, sf, "raw"), REPORTS["daily_trend"]
    lines = raw_lines(spark, sf)
    source = staged_stream(spark, [lines.filter(f"event_id % 2 = {i}") for i in range(2)], f"{root}/lines")
    kept = reports.ReportTables(root, spec.name)
    ingest.run_available(reports.stream_report(ingest.normalized_stream(source), spec, root), kept.checkpoint)
    return _totals(spark, kept)


_LATE = f"case when event_id % 10 = 0 then {3 * DAY_MS} else 0 end"
_ARRIVED = "strftime(make_timestamp((et + {late}) * 1000), '%Y%m%d')".format(late=_LATE)


@query("stream_late_visitors", over_log(f"select ak, {_ARRIVED} as day, count(distinct uu) as uv from log group by all"))
def _late(spark, sf):
    """A tenth of the records come three days late, and input is unordered: they count on the day they arrive."""
    root = _root(spark, sf, "late")
    kept = reports.ReportTables(root, uniques.UNIQUES)
    stream = log_stream(spark, sf, root, lateness=_LATE)
    ingest.run_available(uniques.unique_stream(stream, ["ak"], root, job_day()), kept.checkpoint)
    return _totals(spark, kept)


_MIDNIGHT = f"date_trunc('day', make_timestamp((et + {3 * DAY_MS}) * 1000))"
_RESTAMPED = (
    oracle_ctes().replace("log as (", "whole as (", 1)
    + ", log as (select * replace (case when late then epoch_ms(midnight) else et end as et, case when late then strftime(midnight, '%Y%m%d') else day end as day,"
    f" case when late then '00' else hour end as hour) from (select *, event_id % 10 = 0 as late, {_MIDNIGHT} as midnight from whole))"
)


@query("stream_late_trend", traffic(JOBS["trend_job"], _RESTAMPED))
def _late_trend(spark, sf):
    """A report whose late records move to the midnight before they arrived, in any order of arrival."""
    root, spec = _root(spark, sf, "late_trend"), JOBS["trend_job"]
    kept = reports.ReportTables(root, spec.name)
    stream = log_stream(spark, sf, root, lateness=_LATE)
    ingest.run_available(reports.stream_report(stream, spec, root, lookups_of(spark), job_day()), kept.checkpoint)
    return _totals(spark, kept)


# -- several runs on the same tables ---------------------------------------------------------------


def _beside_backfill(spark: SparkSession, sf: str, name: str, start, kept_of) -> DataFrame:
    """Live batches, then a backfill of later records as a run of its own, then all live batches once more."""
    root, log = _root(spark, sf, name), log_of(spark, sf)
    live = staged_stream(spark, [log.filter(f"et < unix_millis({CUTS[0]})"), log.filter(f"et >= unix_millis({CUTS[0]}) and et < unix_millis({CUTS[1]})")], f"{root}/live")
    again = staged_stream(spark, [log.filter(f"et >= unix_millis({CUTS[1]})")], f"{root}/again")
    for stream, run, checkpoint in ((live, "live", "a"), (again, "again", "b"), (live, "live", "replay")):
        ingest.run_available(start(stream, root, run), f"{root}/checkpoints/{checkpoint}")
    return _totals(spark, kept_of(root))


@query("stream_replay_beside_backfill", ORACLES["daily_link_summary"])
def _replayed_link(spark, sf):
    spec = REPORTS["daily_link_summary"]
    return _beside_backfill(
        spark, sf, "replayed_link", lambda s, root, run: reports.stream_report(s, spec, root, lookups_of(spark), run=run),
        lambda root: reports.ReportTables(root, spec.name),
    )


@query("stream_ads_replay_beside_backfill", ORACLES["ad_levels"])
def _replayed_ads(spark, sf):
    return _beside_backfill(
        spark, sf, "replayed_ads", lambda s, root, run: reports.stream_ads(s, root, lookup(spark, "links"), AD_LEVELS, run=run),
        lambda root: reports.ReportTables(root, reports.ADS),
    )


_REPLAYED_DAYS = ["20240110", "20240111", "20240112"]


@query("stream_backfill_replaces_days", ORACLES["daily_link_summary"])
def _replaced(spark, sf):
    """Three days that live has counted, one of them twice over and one in part, are counted again and put in their place."""
    root, spec, log = _root(spark, sf, "replaced"), REPORTS["daily_link_summary"], log_of(spark, sf)
    wrong = log.filter("day <> '20240111' or event_id % 2 = 0").unionByName(log.filter("day = '20240112'").withColumn("att", F.concat("att", F.lit("x"))))
    parts = [wrong.filter(f"et < unix_millis({CUTS[0]})"), wrong.filter(f"et >= unix_millis({CUTS[0]}) and day <= '20240113'"), wrong.filter("day > '20240113'")]
    replayed = log.filter(F.col("day").between("20240109", "20240113"))
    report = reports.spec_report(spec, lookups_of(spark))
    live, again = reports.ReportTables(root, spec.name), reports.ReportTables(root, spec.name, "again", _REPLAYED_DAYS)
    start = lambda s, kept: reports.stream_report(s, spec, root, lookups_of(spark), run=kept.run, replaces=kept.replaces)
    ingest.run_available(start(staged_stream(spark, parts[:2], f"{root}/live"), live), live.checkpoint)
    ingest.run_available(start(staged_stream(spark, [replayed.filter("hour < '12'"), replayed.filter("hour >= '12'")], f"{root}/again"), again), again.checkpoint)
    reports.swap(report, spark, again)
    parts[2].repartition(FILES, "event_id").write.mode("append").parquet(f"{root}/live")
    ingest.run_available(start(ingest.file_stream(spark, f"{root}/live", log.schema, FILES), live), live.checkpoint)
    return _totals(spark, live)


@query("stream_ad_levels", ORACLES["ad_levels"])
def _ads(spark, sf):
    root = _root(spark, sf, "stream_ads")
    kept = reports.ReportTables(root, reports.ADS)
    stream = log_stream(spark, sf, root, ordered=True)
    ingest.run_available(reports.stream_ads(stream, root, lookup(spark, "links"), AD_LEVELS), kept.checkpoint)
    return _totals(spark, kept)


@query("stream_ad_home_hourly", ORACLES["ad_home_hourly"])
def _home(spark, sf):
    root = _root(spark, sf, "stream_home")
    kept = reports.ReportTables(root, reports.HOME)
    stream = log_stream(spark, sf, root, ordered=True)
    ingest.run_available(reports.stream_home(stream, root, lookup(spark, "links"), by_hour=True), kept.checkpoint)
    return _totals(spark, kept)


@query("stream_ad_activity_detail", ORACLES["ad_activity_detail"])
def _activity(spark, sf):
    root = _root(spark, sf, "stream_activity")
    kept = reports.ReportTables(root, reports.ACTIVITY)
    stream = log_stream(spark, sf, root, ordered=True)
    ingest.run_available(reports.stream_activity(stream, root, lookup(spark, "links"), lookup(spark, "media")), kept.checkpoint)
    return _totals(spark, kept)


@query("stream_messages_to_table", over_log("select ak, day, te, count(*) as pv from log group by all"))
def _messages(spark, sf):
    """Published rows consumed batch by batch and entered into a table."""
    root = _root(spark, sf, "messages")
    rows = metrics.record_count(log_of(spark, sf), ["ak", "day", "te"])
    messages = publish.to_messages(rows, "pv")
    messages.repartition(2).write.parquet(f"{root}/topic")
    source = ingest.file_stream(spark, f"{root}/topic", messages.schema)

    def enter(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, f"{root}/table", f"{root}/staged/{batch_id}", ["ak", "day", "te"])

    publish.apply_messages(source, rows.schema, enter, f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/table")


@query("stream_unique_visitors", over_log("select ak, day, count(distinct uu) as uv from log group by all"))
def _uniques(spark, sf):
    """Each batch has records of all days."""
    root = _root(spark, sf, "uniques")
    kept = reports.ReportTables(root, uniques.UNIQUES)
    ingest.run_available(uniques.unique_stream(log_stream(spark, sf, root), ["ak"], root, job_day()), kept.checkpoint)
    return _totals(spark, kept)


@query(
    "stream_session_changes",
    over_log(
        "select ak, te, day, cast(sum(is_new) as bigint) as new_comer_count, count(*) as open_count,"
        " count(*) filter (where pages = 1) as one_page_count, cast(sum(stay) as bigint) as total_stay_time,"
        " cast(sum(pv) as bigint) as pv from (select ak, te, day, att, max(case when ifo = 'true' then 1 else 0 end) as is_new,"
        " count(distinct pp) as pages, max(dr) as stay, count(*) as pv from log group by all) group by ak, te, day"
    ),
)
def _sessions(spark, sf):
    root, dims = _root(spark, sf, "sessions"), ["ak", "te", "day"]
    changes = sessions.session_changes(log_stream(spark, sf, root), dims, job_day())
    with sessions.state_settings(spark):
        ingest.run_available(sessions.keep_changes(changes, dims, sessions.SUMS, f"{root}/changes"), f"{root}/checkpoint")
    schema = spark.createDataFrame([], "ak string, te string, day string, " + ", ".join(f"{c} long" for c in sessions.SUMS)).schema
    return uniques.running_totals(spark, f"{root}/changes", schema, dims, sessions.SUMS)


@query(
    "stream_entry_page_changes",
    over_log(
        "select ak, day, page_path, count(*) as entry_page_count, count(*) filter (where pages = 1) as one_page_count,"
        " cast(sum(pv) as bigint) as page_count, cast(sum(stay) as bigint) as total_time from (select ak, day, att,"
        " arg_min(pp, et) as page_path, count(distinct pp) as pages, count(*) as pv, max(dr) as stay from log group by all)"
        " group by ak, day, page_path"
    ),
)
def _entries(spark, sf):
    root, dims = _root(spark, sf, "entries"), ["ak", "day"]
    changes = sessions.entry_changes(log_stream(spark, sf, root), dims, job_day())
    keys = [*dims, "page_path"]
    with sessions.state_settings(spark):
        ingest.run_available(sessions.keep_changes(changes, keys, sessions.ENTRY_SUMS, f"{root}/changes"), f"{root}/checkpoint")
    schema = spark.createDataFrame([], "ak string, day string, page_path string, " + ", ".join(f"{c} long" for c in sessions.ENTRY_SUMS)).schema
    totals = uniques.running_totals(spark, f"{root}/changes", schema, keys, sessions.ENTRY_SUMS)
    return totals.filter("entry_page_count <> 0")


@query(
    "stream_new_users",
    over_log("select ak, op, event_id from log where op <> 'useless_openid' qualify row_number() over (partition by ak, op order by et, event_id) = 1"),
)
def _new_users(spark, sf):
    root = _root(spark, sf, "new_users")
    stream = log_stream(spark, sf, root, ordered=True).filter(has_openid())
    ingest.run_available(uniques.mark_new_users(stream, root), f"{root}/checkpoint")
    return uniques.new_users(spark, root).select(*first_seen.KEYS, "event_id")


@query("stream_windowed_views", over_log("select ak, epoch_ms(date_trunc('hour', make_timestamp(et * 1000))) as start_ms, count(*) as pv from log group by all"))
def _windows(spark, sf):
    """Each batch has records of all days."""
    root = _root(spark, sf, "windows")
    kept = reports.ReportTables(root, uniques.WINDOWS)
    ingest.run_available(uniques.window_stream(log_stream(spark, sf, root), ["ak"], root, job_day()), kept.checkpoint)
    return _totals(spark, kept).drop("day")
