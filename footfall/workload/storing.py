"""Tables written and read back: log scans, upserts, messages, backfills."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import backfill, metrics
from footfall.plans import jobs, reports
from footfall.plans.specs import REPORTS
from footfall.schema import CHEAT_SCAN, RETENTION_SCAN
from footfall.session import shared_dir
from footfall.sinks import files, publish
from footfall.sinks.upsert import merge_totals, upsert_table
from footfall.sources import logs
from footfall.workload.log import log_of, lookup, lookups_of, oracle_ctes
from footfall.workload.oracle import NOT_APP_LEVEL, traffic
from footfall.workload.registry import ORACLES, over_log, query


def place(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder of this application and scale in the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{os.path.basename(sf_dir.rstrip('/'))}/{name}"


def _stored_log(spark: SparkSession, sf_dir: str, name: str, log: DataFrame | None = None) -> str:
    path = place(spark, sf_dir, name)
    files.write_log(log_of(spark, sf_dir) if log is None else log, path, mode="overwrite")
    return path


# -- scans -----------------------------------------------------------------------------

query(
    "scan_hours_of_day",
    over_log("select event_id, ak, uu, day, hour from log where day = '20240110' and hour between '06' and '11'"),
)(lambda spark, sf: logs.of_hours(
    logs.read_log(spark, _stored_log(spark, sf, "log"), log_of(spark, sf).schema), "20240110", "06", "11"
).select("event_id", "ak", "uu", "day", "hour"))
query(
    "scan_last_week_of_apps",
    over_log("select event_id, ak, day from log where day between '20240114' and '20240120' and ak in ('app1', 'app2', 'app3') and ak <> 'app2'"),
)(lambda spark, sf: logs.of_apps(
    logs.of_days(logs.read_log(spark, _stored_log(spark, sf, "log_week"), log_of(spark, sf).schema), "20240120", 7),
    include=["app1", "app2", "app3"], exclude=["app2"],
).select("event_id", "ak", "day"))
query(
    "scan_recent_sdk",
    over_log(
        "select ak, op, img, ifo, client_ip, scene, link_key, pp, v, day, hour from log where v >= '7.3.0' and link_key <> 'null'"
    ),
)(lambda spark, sf: logs.recent_sdk(logs.link_visits(logs.read_log(spark, _stored_log(spark, sf, "log_sdk"), log_of(spark, sf).schema))))


@query(
    "scan_with_schema",
    over_log("select ak, op, ifo, scene, link_key as wsr_query_ald_link_key, pp, v from log"),
)
def _with_schema(spark, sf):
    path = place(spark, sf, "raw_names")
    files.save_rows(log_of(spark, sf).withColumnRenamed("link_key", "wsr_query_ald_link_key"), path)
    return logs.read_log(spark, path, RETENTION_SCAN)


@query(
    "scan_merged_schemas",
    over_log(
        "select ak, op, img, client_ip, wsr_query_ald_link_key, v from (select ak, op, img, client_ip, link_key as"
        " wsr_query_ald_link_key, case when event_id % 2 = 0 then v end as v from log)"
    ),
)
def _merged(spark, sf):
    path = place(spark, sf, "two_schemas")
    log = log_of(spark, sf).withColumnRenamed("link_key", "wsr_query_ald_link_key")
    names = CHEAT_SCAN.fieldNames()
    files.save_rows(log.filter("event_id % 2 = 0").select(*names), path)
    files.append_rows(log.filter("event_id % 2 = 1").select(*[n for n in names if n != "v"]), path)
    return logs.read_log(spark, path, merge_schema=True).select(*names)


@query(
    "scan_json_lines",
    over_log("select ak, uu, att as \"at\", pp, cast(et as varchar) as et, scene, cast(dr as varchar) as dr from log"),
)
def _json(spark, sf):
    path = place(spark, sf, "json")
    raw = log_of(spark, sf).withColumnRenamed("att", "at").select("ak", "uu", "at", "pp", "et", "scene", "dr", "day", "hour")
    raw.write.mode("overwrite").partitionBy("day", "hour").json(path)
    return logs.read_json_log(spark, f"{path}/day=*/hour=*").select("ak", "uu", "at", "pp", "et", "scene", "dr")


@query(
    "adhoc_fact_scan",
    over_log("select ak, uu, pp, day as ald_day from log where ak = 'app3' and ev = 'page'"),
)
def _adhoc(spark, sf):
    path = place(spark, sf, "facts")
    files.save_rows(log_of(spark, sf).withColumnRenamed("day", "ald_day"), path)
    return logs.read_log(spark, path).filter("ak = 'app3' and ev = 'page'").select("ak", "uu", "pp", "ald_day")


# -- upserts ------------------------------------------------------------------------------

_KEYS = ["ak", "day", "te"]


@query("upsert_set", ORACLES["daily_trend"])
def _upsert_set(spark, sf):
    """Half of the day's log first, the whole day later: the later rows stand."""
    path = place(spark, sf, "set")
    log, schema = log_of(spark, sf), None
    for step, part in enumerate([log.filter("hour < '12'"), log]):
        rows = reports.report("daily_trend", part)
        schema = rows.schema
        upsert_table(rows, path, f"{path}_staged/{step}", _KEYS, "set")
    return spark.read.schema(schema).parquet(path)


@query(
    "upsert_acc",
    over_log(
        "select ak, day, te, cast(sum(dr) as bigint) as total_stay_time, count(*) as open_count,"
        " cast((200 * cast(sum(dr) as bigint) + count(*)) // (2 * count(*)) as double) / 100 as secondary_avg_stay_time"
        " from log group by all"
    ),
)
def _upsert_acc(spark, sf):
    """Two deltas add up; the second is applied twice under one id and counts once."""
    path = place(spark, sf, "acc")
    log, sums = log_of(spark, sf), ["total_stay_time", "open_count"]
    ratios = ["secondary_avg_stay_time"]
    rows = None
    for step, part in [(0, "hour < '12'"), (1, "hour >= '12'"), (1, "hour >= '12'")]:
        delta = log.filter(part).groupBy(*_KEYS).agg(F.sum("dr").alias(sums[0]), F.count("*").alias(sums[1]))
        rows = merge_totals(delta.limit(0), delta, _KEYS, "acc", sums, ratios)
        upsert_table(rows, path, f"{path}_staged/{step}", _KEYS, "acc", sums, ratios)
    return spark.read.schema(rows.schema).parquet(path)


@query("append_rows", over_log("select ak, day, hour, count(*) as pv from log group by all"))
def _append(spark, sf):
    path = place(spark, sf, "append")
    rows = metrics.record_count(log_of(spark, sf), ["ak", "day", "hour"])
    files.save_rows(rows.filter("hour < '08'"), path)
    files.append_rows(rows.filter("hour >= '08'"), path)
    return spark.read.schema(rows.schema).parquet(path)


@query("replace_days", over_log("select ak, uu, pp, day, hour from log where day < '20240104' or hour < '12'"))
def _replace(spark, sf):
    path = place(spark, sf, "replaced")
    rows = log_of(spark, sf).select("ak", "uu", "pp", "day", "hour")
    rows.write.mode("overwrite").partitionBy("day").parquet(path)
    files.replace_days(rows.filter("day >= '20240104' and hour < '12'"), path)
    return spark.read.schema(rows.schema).parquet(path)


# -- messages --------------------------------------------------------------------------------

_TOPICS = {publish.PROD: "result-prod", publish.GREY: "result-grey"}


@query(
    "result_messages",
    over_log(
        "select d.ak, d.day, d.te, d.pv, d.ak || ':' || d.te as key,"
        " case when online_status = 1 then 'result-prod' else 'result-grey' end as topic from"
        " (select ak, day, te, count(*) as pv from log group by all) d left join release r on r.ak = d.ak", "release",
    ),
)
def _messages(spark, sf):
    from footfall.operators import enrich

    rows = metrics.record_count(log_of(spark, sf), ["ak", "day", "te"])
    messages = publish.to_messages(enrich.route(rows, lookup(spark, "release")), "pv", _TOPICS)
    parsed = messages.withColumn("r", F.from_json("value", rows.schema))
    return parsed.select("r.*", "key", "topic")


@query("messages_back_to_rows", over_log("select ak, day, te, count(*) as pv from log group by all"))
def _back(spark, sf):
    rows = metrics.record_count(log_of(spark, sf), ["ak", "day", "te"])
    return publish.from_messages(publish.to_messages(rows, "pv"), rows.schema)


# -- backfills ---------------------------------------------------------------------------------


def _gap(log: DataFrame) -> DataFrame:
    """What was counted before the backfill: some hours are missing half of their records."""
    return log.filter("hour < '10' or event_id % 2 = 0")


for _name in ("trend_job", "scene_job", "qr_job", "link_expansion", *jobs.SHARE_REPORTS):

    @query(f"backfill_{_name}", ORACLES[_name])
    def _backfill(spark, sf, name=_name):
        log, lookups = log_of(spark, sf), lookups_of(spark)
        return jobs.backfill_days(name, jobs.build(name, _gap(log), lookups), log, lookups)


@query(
    "backfill_hours_of_trend",
    f"select * exclude (avg_refresh_count) from ({ORACLES['hourly_trend']}) where day = '20240110'",
)
def _hours(spark, sf):
    log = log_of(spark, sf)
    day = log.filter("day = '20240110'")
    lost = day.filter("hour < '10' or event_id % 2 = 0 or ifo = 'true'")
    stored = reports.report("hourly_trend", lost).drop("avg_refresh_count")
    return jobs.backfill_hours("hourly_trend", stored, day, "20240110", "10", "23")


_ONE_DAY = f"{oracle_ctes('links').replace('log as (', 'whole as (', 1)}, log as (select * from whole where day = '20240110')"


@query("backfill_hours_of_link", traffic(REPORTS["hourly_link"], _ONE_DAY))
def _hours_of_link(spark, sf):
    """Users who authorised before the backfilled hours are not new in them."""
    log, lookups = log_of(spark, sf), lookups_of(spark)
    day = log.filter("day = '20240110'")
    stored = reports.report("hourly_link", day, lookups).withColumns(
        {c: F.when(F.col("hour") >= "10", F.col(c) + 7).otherwise(F.col(c)) for c in ("open_count", "new_auth_count")}
    )
    return jobs.backfill_hours("hourly_link", stored, day, "20240110", "10", "23", lookups)


@query("backfill_hours_of_share", f"select * from ({ORACLES['hourly_share_summary']}) where day = '20240110'")
def _hours_of_share(spark, sf):
    day = log_of(spark, sf).filter("day = '20240110'")
    stored = reports.share_summary(day.filter("hour < '10' or event_id % 2 = 0"), by_hour=True)
    return jobs.backfill_hours("hourly_share_summary", stored, day, "20240110", "10", "23")


@query("backfill_days_drops_keys", ORACLES["daily_link"])
def _vanished(spark, sf):
    """Links that were live when the days were counted first, and are deleted now."""
    log, lookups = log_of(spark, sf), lookups_of(spark)
    before = lookups_of(spark, links=lookup(spark, "links").withColumn("is_del", F.lit(0)))
    return jobs.backfill_days("daily_link", jobs.build("daily_link", log, before), log, lookups)


@query(
    "job_routes",
    over_log(
        "select ak, day, te, pv, case when ak in (select ak from release where online_status = 1) then 'prod' else 'grey' end as route"
        f" from (select ak, day, te, count(*) filter (where pp <> 'useless_page') as pv from log where {NOT_APP_LEVEL} group by all)",
        "release",
    ),
)
def _routes(spark, sf):
    """A job before everything is online: released apps and grey ones go to a table each."""
    root = f"{place(spark, sf, 'routes')}/{uuid.uuid4().hex}"
    log = log_of(spark, sf)
    jobs.run_job("daily_trend", log, root, "1", lookups_of(spark), all_online=False)
    schema = reports.report("daily_trend", log).schema
    parts = [
        spark.read.schema(schema).parquet(jobs.table_of(root, "daily_trend", route)).withColumn("route", F.lit(route))
        for route in (publish.PROD, publish.GREY)
    ]
    return parts[0].unionByName(parts[1]).select("ak", "day", "te", F.col("total_page_count").alias("pv"), "route")


@query("backfill_hour_views", over_log("select ak, day, count(*) as pv from log group by all"))
def _hour_views(spark, sf):
    log, dims = log_of(spark, sf), ["ak", "day"]
    part = _gap(log)
    return backfill.replace_hour_views(
        metrics.record_count(part, dims),
        metrics.record_count(part, [*dims, "hour"]),
        metrics.record_count(log.filter("hour >= '10'"), [*dims, "hour"]),
        dims,
    )


@query("backfill_views_overwrite", over_log("select ak, day, count(*) as pv from log group by all"))
def _views(spark, sf):
    log, dims = log_of(spark, sf), ["ak", "day"]
    return backfill.overwrite_views(metrics.record_count(_gap(log), dims), log, dims)


@query("backfill_unique_overwrite", over_log("select ak, day, count(distinct uu) as uv from log group by all"))
def _unique(spark, sf):
    log, dims = log_of(spark, sf), ["ak", "day"]
    return backfill.overwrite_unique(metrics.unique(_gap(log), dims), log, dims)


@query("backfill_unique_add_unseen", over_log("select ak, day, count(distinct uu) as uv from log group by all"))
def _unseen(spark, sf):
    log, dims = log_of(spark, sf), ["ak", "day"]
    part = _gap(log)
    return backfill.add_unseen(metrics.unique(part, dims), metrics.unseen(part, None, dims, "uu"), log, dims)
