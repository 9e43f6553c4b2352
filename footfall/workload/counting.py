"""Counters, session tables, enrichment and filters as queries of their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall import schema as S
from footfall.functions import text, times, versions
from footfall.operators import enrich, filters, metrics, rollup, sessions, share
from footfall.operators.traffic import traffic_totals
from footfall.sources import lookups as lookup_sources
from footfall.plans import reports
from footfall.plans.specs import REPORTS
from footfall.workload.log import log_of, lookup, lookups_of, oracle_ctes, table
from footfall.workload.oracle import NOT_APP_LEVEL, POSITION, SHARE_SCENES, ratio, traffic
from footfall.workload.registry import over_log, query

DIMS = ["ak", "te", "day"]

# -- counters -----------------------------------------------------------------------

query("page_views", over_log("select ak, te, day, count(*) filter (where ev = 'page') as pv from log group by all"))(
    lambda spark, sf: metrics.page_views(log_of(spark, sf), DIMS)
)
query("record_count", over_log("select ak, te, day, count(*) as pv from log group by all"))(
    lambda spark, sf: metrics.record_count(log_of(spark, sf), DIMS)
)
query("unique_visitors", over_log("select ak, te, day, count(distinct uu) as uv from log group by all"))(
    lambda spark, sf: metrics.unique(log_of(spark, sf), DIMS)
)
query("unique_ips", over_log("select ak, day, count(distinct client_ip) as ips from log group by all"))(
    lambda spark, sf: metrics.unique_ips(log_of(spark, sf), ["ak", "day"])
)
query("session_opens", over_log("select ak, te, day, count(distinct att) as open_count from log group by all"))(
    lambda spark, sf: metrics.opens(log_of(spark, sf), DIMS)
)
query(
    "new_user_count",
    over_log("select ak, te, day, count(distinct case when ifo = 'true' then uu end) as new_users from log group by all"),
)(lambda spark, sf: metrics.new_users(log_of(spark, sf), DIMS))
query(
    "views_and_visitors",
    over_log("select ak, te, day, hour, count(*) as pv, count(distinct uu) as uv from log where pp <> 'useless_page' group by all"),
)(lambda spark, sf: metrics.views_and_visitors(log_of(spark, sf), [*DIMS, "hour"]))
query("stay_sum", over_log("select ak, te, day, cast(sum(dr) as bigint) as total from log group by all"))(
    lambda spark, sf: metrics.value_sum(log_of(spark, sf), DIMS, F.col("dr"))
)
query(
    "counter_sum",
    over_log("select ak, day, cast(sum(n) as bigint) as pv from (select ak, day, hour, count(*) as n from log group by all) group by ak, day"),
)(lambda spark, sf: _counter_sum(log_of(spark, sf)))


def _counter_sum(log):
    morning = metrics.record_count(log.filter("hour < '12'"), ["ak", "day"])
    evening = metrics.record_count(log.filter("hour >= '12'"), ["ak", "day"])
    return metrics.add_counters(morning, evening, ["ak", "day"], ["pv"])


query(
    "unique_increment",
    over_log(
        "select ak, day, count(*) as uv from (select ak, day, uu from log where hour >= '12' group by all except"
        " select ak, day, uu from log where hour < '12') group by ak, day"
    ),
)(lambda spark, sf: _increment(log_of(spark, sf)))


def _increment(log):
    seen = metrics.unseen(log.filter("hour < '12'"), None, ["ak", "day"], "uu")
    return metrics.unique_increment(log.filter("hour >= '12'"), seen, ["ak", "day"])


query(
    "stored_counters",
    over_log(
        "select ak, day, coalesce(pv, 0) as pv from (select distinct ak, day from log)"
        " left join (select ak, day, count(*) as pv from log where hour = '03' group by all) using (ak, day)"
    ),
)(lambda spark, sf: metrics.stored_counters(
    log_of(spark, sf).select("ak", "day").distinct(),
    metrics.record_count(log_of(spark, sf).filter("hour = '03'"), ["ak", "day"]), ["ak", "day"], ["pv"],
))
query("app_versions", over_log("select distinct ak, day, v from log"))(
    lambda spark, sf: metrics.app_versions(log_of(spark, sf))
)

# -- sessions -----------------------------------------------------------------------

_ONE = """
 select ak, te, day, att, max(case when ifo = 'true' then 1 else 0 end) as is_new, count(distinct pp) as pages,
  count(*) as pv, min(et) as start_ms, max(et) as end_ms, max(dr) as stay, arg_min(pp, et) as first_page
 from log group by ak, te, day, att"""
query("session_table", over_log(_ONE))(lambda spark, sf: sessions.sessionize(log_of(spark, sf), DIMS))
query(
    "session_sums",
    over_log(
        "select ak, te, day, cast(sum(is_new) as bigint) as new_comer_count, count(*) as open_count,"
        " count(*) filter (where pages = 1) as one_page_count, cast(sum(stay) as bigint) as total_stay_time,"
        f" cast(sum(pages) as bigint) as pages_sum, cast(sum(pv) as bigint) as pv from ({_ONE}) group by ak, te, day"
    ),
)(lambda spark, sf: sessions.session_sums(sessions.sessionize(log_of(spark, sf), DIMS), DIMS))
query(
    "session_seed",
    over_log(
        "select event_id, 1 as pages, case when ifo = 'true' then 1 else 0 end as is_new, et as start_ms, et as end_ms,"
        " pp as first_page, dr as stay from log"
    ),
)(lambda spark, sf: sessions.session_seed(log_of(spark, sf)).select(
    "event_id", "pages", "is_new", "start_ms", "end_ms", "first_page", "stay"
))

# -- rollups ------------------------------------------------------------------------

_CUBE = " union all by name ".join(
    "select ak, day, " + ", ".join(c if c in lv else f"'all' as {c}" for c in ("hour", "link_key", "position_id"))
    + f", '{'+'.join(lv) or 'app'}' as level, count(*) as pv, count(distinct uu) as uv, count(distinct att) as opens"
    + " from placed group by ak, day" + "".join(f", {c}" for c in lv)
    for lv in ((), ("hour",), ("link_key",), ("hour", "link_key"), ("position_id",), ("hour", "position_id"))
)
query("grouping_levels", over_log(_CUBE, ctes=f" placed as (select *, {POSITION} as position_id from log)"))(
    lambda spark, sf: traffic_totals(
        enrich.add_position(log_of(spark, sf)),
        ((), ("hour",), ("link_key",), ("hour", "link_key"), ("position_id",), ("hour", "position_id")),
    ).select(
        "ak", "day", "hour", "link_key", "position_id", "level", F.col("total_page_count").alias("pv"),
        F.col("visitor_count").alias("uv"), F.col("open_count").alias("opens"),
    )
)
query(
    "one_level_of_rollup",
    over_log("select ak, day, hour, cast(count(*) as bigint) as n from log group by all"),
)(lambda spark, sf: rollup.pick_level(
    rollup.roll_up(
        metrics.record_count(log_of(spark, sf), ["ak", "day", "hour", "link_key"]), ((), ("hour",), ("link_key",)), ["pv"]
    ), ("hour",),
).withColumnRenamed("pv", "n"))

# -- enrichment ----------------------------------------------------------------------

query(
    "scene_groups",
    over_log(
        f"select event_id, case when g.scene_id is null then '{S.OTHER}' else l.scene end as scene,"
        f" coalesce(scene_group_id, '{S.OTHER}') as scene_group from log l"
        " left join scenes g on g.te = l.te and g.scene_id = l.scene", "scenes",
    ),
)(lambda spark, sf: enrich.add_scene_group(log_of(spark, sf), lookup(spark, "scenes")).select("event_id", "scene", "scene_group"))
_QR_GROUP = f"case when c.qr_group_key = '' then '{S.OTHER}' else c.qr_group_key end"
query(
    "qr_groups",
    over_log(f"select event_id, {_QR_GROUP} as qr_group from log l join qr_codes c on c.app_key = l.ak and c.qr_key = l.qr", "qr_codes"),
)(lambda spark, sf: enrich.add_qr_group(log_of(spark, sf), lookup(spark, "qr_codes")).select("event_id", "qr_group"))
query(
    "qr_groups_or_other",
    over_log(
        f"select event_id, coalesce({_QR_GROUP}, '{S.OTHER}') as qr_group from log l"
        " left join qr_codes c on c.app_key = l.ak and c.qr_key = l.qr", "qr_codes",
    ),
)(lambda spark, sf: enrich.add_qr_group_or_other(log_of(spark, sf), lookup(spark, "qr_codes")).select("event_id", "qr_group"))
query(
    "link_media",
    over_log(
        "select event_id, cast(k.media_id as varchar) as media_id from log l"
        " join links k on k.app_key = l.ak and k.link_key = l.link_key and is_del = 0", "links",
    ),
)(lambda spark, sf: enrich.add_media(log_of(spark, sf), lookup(spark, "links")).select("event_id", "media_id"))
query(
    "link_media_by_link",
    over_log(
        "select event_id, k.media_id from log l join (select link_key, cast(min(media_id) as varchar) as media_id"
        " from links where is_del = 0 group by link_key) k on k.link_key = l.link_key", "links",
    ),
)(lambda spark, sf: enrich.add_media(log_of(spark, sf), lookup(spark, "links"), by_app=False).select("event_id", "media_id"))
query("positions", over_log(f"select event_id, {POSITION} as position_id from log"))(
    lambda spark, sf: enrich.add_position(log_of(spark, sf)).select("event_id", "position_id")
)
query(
    "activity_channels",
    over_log(
        f"select event_id, case when k.link_name = '' then '{S.UNKNOWN_ACTIVITY}' else k.link_name end as activity,"
        f" coalesce(m.media_name, '{S.UNKNOWN_CHANNEL}') as channel from log l"
        " join links k on k.app_key = l.ak and k.link_key = l.link_key and is_del = 0"
        " left join media m on m.media_id = k.media_id", "links", "media",
    ),
)(lambda spark, sf: enrich.add_activity_channel(
    log_of(spark, sf), lookup(spark, "links"), lookup(spark, "media")
).select("event_id", "activity", "channel"))
query(
    "phones",
    over_log(
        f"select event_id, coalesce(brand, '{S.UNKNOWN}') as brand, coalesce(name, '{S.UNKNOWN}') as model"
        " from log left join phones on uname = pm", "phones",
    ),
)(lambda spark, sf: enrich.add_phone(log_of(spark, sf), lookup(spark, "phones")).select("event_id", "brand", "model"))
query(
    "share_chains",
    over_log(
        "select event_id, case when share_src = 'null' then null else list_extract(string_split(share_src, ','), -1) end as src,"
        " case when share_src = 'null' then null else cast(len(string_split(share_src, ',')) as varchar) end as layer from log"
    ),
)(lambda spark, sf: enrich.add_share_chain(log_of(spark, sf)).select("event_id", "src", "layer"))
query(
    "sharer_profiles",
    over_log(
        f"select ak, uu, case when city = '' then '{S.UNKNOWN}' else city end as city, case gender when '1' then '{S.MALE}'"
        f" when '2' then '{S.FEMALE}' else '{S.UNKNOWN}' end as gender from log"
        " qualify row_number() over (partition by ak, uu order by et desc) = 1"
    ),
)(lambda spark, sf: enrich.sharer_profiles(log_of(spark, sf)))
query(
    "new_user_propagation",
    over_log(
        "select event_id, case when bool_or(ifo = 'true' and v < '7.0.0') over (partition by day, att) then 'true'"
        " else ifo end as ifo from log"
    ),
)(lambda spark, sf: enrich.propagate_new_user(log_of(spark, sf)).select("event_id", "ifo"))
_PART_OP = "case when event_id % 3 = 0 then op else 'useless_openid' end"
query(
    "openid_propagation",
    over_log(
        "select event_id, case when op <> 'useless_openid' then op else coalesce(min(nullif(op, 'useless_openid'))"
        f" over (partition by day, att), 'useless_openid') end as op from (select event_id, day, att, {_PART_OP} as op from log)"
    ),
)(lambda spark, sf: enrich.propagate_openid(log_of(spark, sf).withColumn("op", F.expr(_PART_OP))).select("event_id", "op"))
query(
    "link_expansion_of_sessions",
    traffic(
        REPORTS["link_expansion"],
        f"{oracle_ctes('links').replace('log as (', 'whole as (', 1)},"
        f" part as (select * replace ({_PART_OP} as op) from whole),"
        " log as (select * replace (case when op <> 'useless_openid' then op else coalesce(min(nullif(op, 'useless_openid'))"
        " over (partition by day, att), 'useless_openid') end as op) from part)",
    ),
)(lambda spark, sf: reports.report(
    "link_expansion", log_of(spark, sf).withColumn("op", F.expr(_PART_OP)), lookups_of(spark), openid_of_session=True
))
query(
    "release_routes",
    over_log(
        "select d.ak, d.day, d.pv, case when online_status = 1 then 'prod' else 'grey' end as route from"
        " (select ak, day, count(*) as pv from log group by all) d left join release r on r.ak = d.ak", "release",
    ),
)(lambda spark, sf: enrich.route(metrics.record_count(log_of(spark, sf), ["ak", "day"]), lookup(spark, "release")))
query(
    "foreign_day_restamp",
    over_log(
        "select event_id, case when day = '20240110' then et else 1704844800000 end as et, '20240110' as day,"
        " case when day = '20240110' then hour else '00' end as hour from log"
    ),
)(lambda spark, sf: enrich.align_day(log_of(spark, sf), F.lit("20240110")).select("event_id", "et", "day", "hour"))
query("foreign_day_drop", over_log("select event_id, et, day, hour from log where day = '20240110'"))(
    lambda spark, sf: enrich.align_day(log_of(spark, sf), F.lit("20240110"), "drop").select("event_id", "et", "day", "hour")
)

# -- filters --------------------------------------------------------------------------

query("required_fields", over_log("select event_id from log where city <> ''"))(
    lambda spark, sf: filters.require(log_of(spark, sf), "region").select("event_id")
)
query("without_app_level", over_log(f"select event_id from log where {NOT_APP_LEVEL}"))(
    lambda spark, sf: filters.without_app_level(log_of(spark, sf)).select("event_id")
)
query(
    "share_records",
    over_log(
        "select event_id, case when tp = 'ald_share_status' then 'status' else 'click' end as share_kind,"
        " regexp_replace(path, '^/', '') as pp, case when tp = 'ald_share_status' then ct_utm_s else wsr_query_utm_s end as ct_utm_s"
        f" from log where ev = 'event' and (tp = 'ald_share_status' or (tp = 'ald_share_click' and scene in ({SHARE_SCENES})))"
    ),
)(lambda spark, sf: filters.share_records(log_of(spark, sf)).select("event_id", "share_kind", "pp", "ct_utm_s"))
query("open_id_present", over_log("select event_id from log where op <> 'useless_openid'"))(
    lambda spark, sf: log_of(spark, sf).filter(filters.has_openid()).select("event_id")
)
query(
    "sdk_flags",
    over_log(
        "select event_id, v < '7.0.0' as old_sdk, regexp_matches(v, '[0-9].[0-9].[0-9]') as proper, case when v = '6.9.9' then 1 else 0 end as third from log"
    ),
)(lambda spark, sf: log_of(spark, sf).select(
    "event_id", versions.is_old_sdk(F.col("v")).alias("old_sdk"), versions.is_proper_sdk(F.col("v")).alias("proper"),
    versions.is_third_party(F.col("v")).alias("third"),
))

# -- joins between results ---------------------------------------------------------------

query(
    "share_with_stored",
    over_log(
        "select ak, day, case when pv = 0 then coalesce(total, 0) else pv end as pv from"
        " (select ak, day, count(*) filter (where hour < '02') as pv from log group by all)"
        " left join (select ak, day, count(*) as total from log where hour < '20' group by all) using (ak, day)"
    ),
)(lambda spark, sf: share.fill_from_stored(
    log_of(spark, sf).groupBy("ak", "day").agg(F.count_if(F.col("hour") < "02").alias("pv")),
    metrics.record_count(log_of(spark, sf).filter("hour < '20'"), ["ak", "day"]), ["ak", "day"], ["pv"],
))
query(
    "lookup_first_wins",
    "with a as (select c_custkey % 700 as k, min(c_mktsegment) as v from customer group by all),"
    " b as (select o_custkey % 900 as k, min(o_orderpriority) as v from orders group by all)"
    " select k, coalesce(a.v, b.v) as v from a full join b using (k)",
)(lambda spark, sf: lookup_sources.lookup_first_wins(
    [
        table(spark, sf, "customer").select((F.col("c_custkey") % 700).alias("k"), F.col("c_mktsegment").alias("v")),
        table(spark, sf, "orders").select((F.col("o_custkey") % 900).alias("k"), F.col("o_orderpriority").alias("v")),
    ], ["k"],
))

# -- scalar functions ----------------------------------------------------------------------

query(
    "time_functions",
    over_log(
        "select event_id, strftime(make_timestamp(et * 1000), '%H:%M') as hm,"
        " strftime(strptime(day, '%Y%m%d') - to_days(1), '%Y%m%d') as yesterday,"
        " strftime(strptime(day, '%Y%m%d') + to_months(1), '%Y%m%d') as next_month,"
        " epoch_ms(strptime(day, '%Y%m%d')) as day_start, epoch_ms(strptime(day, '%Y%m%d')) + 86400000 as next_day,"
        " epoch_ms(strptime(day, '%Y%m%d')) + 93600000 as expiry,"
        " cast(date_diff('day', strptime('20240101', '%Y%m%d'), strptime(day, '%Y%m%d')) as int) as age,"
        " (et // 1000) * 1000 as from_seconds, case when event_id % 5000 < 3000 then cast(0 as bigint) else event_id % 5000 end as clock,"
        " true as inside, epoch_ms(strptime(day || hour, '%Y%m%d%H')) as parsed from log"
    ),
)(lambda spark, sf: log_of(spark, sf).select(
    "event_id",
    times.hour_minute_of(F.col("et")).alias("hm"),
    times.yesterday(F.col("day")).alias("yesterday"),
    times.shift_months(F.col("day"), 1).alias("next_month"),
    times.day_start(F.col("day")).alias("day_start"),
    times.next_day_start(F.col("day")).alias("next_day"),
    times.counter_expiry(F.col("day")).alias("expiry"),
    times.days_between(F.col("day"), F.lit("20240101")).alias("age"),
    times.to_millis(F.call_function("div", F.col("et"), F.lit(1000).cast("long"))).alias("from_seconds"),
    times.clock_difference(F.col("et") + F.col("event_id") % 5000, F.col("et")).alias("clock"),
    times.in_day(F.col("et"), F.col("day")).alias("inside"),
    times.parse_millis(F.concat("day", "hour"), "yyyyMMddHH").alias("parsed"),
))
query("key_hashes", over_log("select event_id, substr(md5(ak || chr(31) || uu), 1, 8) as hash from log"))(
    lambda spark, sf: log_of(spark, sf).select("event_id", text.key_hash(F.col("ak"), F.col("uu")).alias("hash"))
)
query(
    "url_functions",
    "select page_id, string_split(url, '?')[1] as bare, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) as host,"
    " coalesce(nullif(trim(url), ''), 'unknown') as named, reverse(url) as reversed from pages",
)(lambda spark, sf: table(spark, sf, "pages").select(
    "page_id",
    text.url_without_params(F.col("url")).alias("bare"),
    text.lower_host(F.col("url")).alias("host"),
    text.or_unknown(F.col("url")).alias("named"),
    F.reverse("url").alias("reversed"),
))
query(
    "safe_ratios",
    f"select l_orderkey, l_linenumber, {ratio('l_partkey', 'l_suppkey', 'ratio')}, cast(0 as double) as none from lineitem",
)(lambda spark, sf: table(spark, sf, "lineitem").select(
    "l_orderkey", "l_linenumber",
    text.safe_ratio(F.col("l_partkey"), F.col("l_suppkey")).alias("ratio"),
    text.safe_ratio(F.col("l_partkey"), F.col("l_suppkey") * 0).alias("none"),
))

