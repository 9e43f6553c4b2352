"""Advertising reports, retention and abnormal traffic, and the state behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall import schema as S
from footfall.operators import cheat, first_seen, retention, rollup
from footfall.operators.filters import has_openid
from footfall.operators.traffic import level_name
from footfall.plans import reports
from footfall.plans.specs import AD_LEVELS
from footfall.workload.log import log_of, lookup
from footfall.workload.oracle import LINK_JOIN, RATIO, ratio
from footfall.workload.registry import over_log, query

_FIRST = "qualify row_number() over (partition by ak, op order by et, event_id) = 1"
_AD = f"""
 known as (select * from log where op <> 'useless_openid'),
 new_first as (select event_id from known {_FIRST}),
 app_rows as (select k.* exclude (ifo), case when f.event_id is null then 'false' else 'true' end as ifo
              from known k left join new_first f on f.event_id = k.event_id),
 app_auth as (select * from app_rows where img <> 'useless_img' {_FIRST}),
 link_rows as ({LINK_JOIN.format(source="app_rows")}),
 link_auth as (select * from link_rows where img <> 'useless_img' {_FIRST})"""

_ALL_DIMS = ("hour", "link_key", "media_id", "position_id")


def _ad_sql(level: tuple[str, ...], rows: str = "link_rows", auth: str = "link_auth", dims=(), many: bool = False) -> str:
    group = ", ".join(["ak", "day", *level])
    outside = "".join(f", 'all' as {d}" for d in dims if d not in level)
    label = f", '{level_name(level)}' as level" if many else ""
    return f"""
 select {group}{label}{outside}, coalesce(new_auth, 0) as new_auth_count, visitor_count, open_count,
  least(new_sessions, visitor_count) as new_comer_count, total_stay_time, one_page_count,
  {ratio(*RATIO["secondary_avg_stay_time"], "secondary_avg_stay_time")}, {ratio(*RATIO["bounce_rate"], "bounce_rate")}
 from (select {group}, cast(sum(is_new) as bigint) as new_sessions, count(*) as open_count,
        cast(sum(stay) as bigint) as total_stay_time, count(*) filter (where pages = 1) as one_page_count
       from (select {group}, att, count(distinct pp) as pages, max(dr) as stay,
              max(case when ifo = 'true' then 1 else 0 end) as is_new from {rows} group by {group}, att) group by {group})
 join (select {group}, count(distinct op) as visitor_count from {rows} group by {group}) using ({group})
 left join (select {group}, count(*) as new_auth from {auth} group by {group}) using ({group})"""


def _levels_sql(levels) -> str:
    dims = [d for d in _ALL_DIMS if any(d in lv for lv in levels)]
    return " union all by name ".join(_ad_sql(lv, dims=dims, many=True) for lv in levels)


def _app_sql(level: tuple[str, ...]) -> str:
    group = ", ".join(["ak", "day", *level])
    return (
        f"select {group}, visitor_count as total_visitor_count, new_comer_count as total_newer_for_app,"
        f" new_auth_count as total_new_auth_user from ({_ad_sql(level, 'app_rows', 'app_auth')})"
    )


def _home_sql(level: tuple[str, ...]) -> str:
    group = ", ".join(["ak", "day", *level])
    return f"select * from ({_ad_sql(level)}) join ({_app_sql(level)}) using ({group})"


query("ad_home_daily", over_log(_home_sql(()), "links", ctes=_AD))(
    lambda spark, sf: reports.ad_home(log_of(spark, sf), lookup(spark, "links"))
)
query("ad_home_hourly", over_log(_home_sql(("hour",)), "links", ctes=_AD))(
    lambda spark, sf: reports.ad_home(log_of(spark, sf), lookup(spark, "links"), by_hour=True)
)
query("ad_app_totals", over_log(_app_sql(()), "links", ctes=_AD))(lambda spark, sf: reports.app_totals(log_of(spark, sf)))
query("ad_levels", over_log(_levels_sql(AD_LEVELS), "links", ctes=_AD))(
    lambda spark, sf: reports.ad_reports(log_of(spark, sf), lookup(spark, "links"), AD_LEVELS)
)
for _name, _level in {
    "ad_daily_link": ("link_key",),
    "ad_hourly_link": ("hour", "link_key"),
    "ad_daily_media": ("media_id",),
    "ad_hourly_media": ("hour", "media_id"),
    "ad_daily_position": ("position_id",),
    "ad_hourly_position": ("hour", "position_id"),
}.items():
    query(_name, over_log(_ad_sql(_level), "links", ctes=_AD))(
        lambda spark, sf, level=_level: reports.ad_reports(log_of(spark, sf), lookup(spark, "links"), (level,))
    )

# Sums of the finest level go up to the others for values that add up.
_FINEST = ("hour", "link_key", "media_id", "position_id")
query(
    "auth_rollup",
    over_log(
        " union all by name ".join(
            f"select {', '.join(['ak', 'day', *lv])}, '{level_name(lv)}' as level"
            + "".join(f", 'all' as {d}" for d in _FINEST if d not in lv)
            + f", count(*) as new_auth from link_auth group by {', '.join(['ak', 'day', *lv])}"
            for lv in rollup.CUBE_LEVELS
        ),
        "links",
        ctes=_AD,
    ),
)(lambda spark, sf: _auth_rollup(spark, sf))


def _auth_rollup(spark, sf):
    from footfall.operators import enrich, filters

    rows = filters.require(log_of(spark, sf).filter(has_openid()), "ad")
    visits = enrich.add_position(enrich.add_media(rows, lookup(spark, "links")))
    firsts = first_seen.first_seen(first_seen.auth_records(visits))
    finest = firsts.groupBy("ak", "day", *_FINEST).agg(F.count("*").alias("new_auth"))
    return rollup.roll_up(finest, rollup.CUBE_LEVELS, ["new_auth"])


# -- state --------------------------------------------------------------------------

_HALF = "20240116"
# The state knows two thirds of the users: some from the first half, some from the job's own days.
_KNOWS = "cast(substr(op, 2) as int) % 3"
_STATE = f"""
 state as (select ak, op, min(et) as known from log where op <> 'useless_openid'
           and ((day < '{_HALF}' and {_KNOWS} = 0) or (day >= '{_HALF}' and {_KNOWS} = 1)) group by ak, op),
 later as (select * from log where op <> 'useless_openid' and day >= '{_HALF}')"""


def _split(spark, sf):
    """State that knows some users, and the log of the second half."""
    known = log_of(spark, sf).filter(has_openid())
    kept = f"(day < '{_HALF}' and {_KNOWS} = 0) or (day >= '{_HALF}' and {_KNOWS} = 1)"
    state = first_seen.update_state(None, known.filter(kept))
    return state, known.filter(F.col("day") >= _HALF)


@query(
    "new_users_against_state",
    over_log(
        "select l.ak, l.op, l.day, l.event_id from"
        f" (select * from later {_FIRST}) l left join state s using (ak, op)"
        " where s.op is null or s.known >= epoch_ms(strptime(l.day, '%Y%m%d'))",
        ctes=_STATE,
    ),
)
def _new_users(spark, sf):
    state, later = _split(spark, sf)
    return first_seen.first_seen(later, state).select("ak", "op", "day", "event_id")


@query(
    "new_users_streaming_rule",
    over_log(
        "select ak, op, day, event_id from (select l.* from later l left join state s using (ak, op)"
        f" where s.op is null) {_FIRST}",
        ctes=_STATE,
    ),
)
def _new_users_strict(spark, sf):
    state, later = _split(spark, sf)
    return first_seen.first_seen_strict(later, state).select("ak", "op", "day", "event_id")


@query(
    "first_seen_state",
    over_log(
        "select ak, op, 'new_user' as kind, min(ts) as first_ts from (select ak, op, known as ts from state"
        " union all select ak, op, et from later) group by ak, op",
        ctes=_STATE,
    ),
)
def _state(spark, sf):
    state, later = _split(spark, sf)
    return first_seen.update_state(state, later)


@query(
    "first_seen_lookup",
    over_log(
        "select ak, op, seen_ts, known as stored_ts, least(known, seen_ts) as first_ts"
        " from (select ak, op, min(et) as seen_ts from later group by ak, op) left join state using (ak, op)",
        ctes=_STATE,
    ),
)
def _lookup(spark, sf):
    state, later = _split(spark, sf)
    return first_seen.lookup_or_insert(later, state)


@query(
    "mark_first_records",
    over_log(
        "select event_id, row_number() over (partition by ak, op order by et, event_id) = 1 as is_first"
        " from log where op <> 'useless_openid'"
    ),
)
def _mark(spark, sf):
    known = log_of(spark, sf).filter(has_openid())
    return first_seen.mark_first(known, first_seen.first_seen(known)).select("event_id", "is_first")


@query(
    "new_auth_by_old_rule",
    over_log(
        "select ak, day, count(distinct uu) as new_auth from log where op = 'useless_openid'"
        " and img <> 'useless_img' and (ifo = 'true' or event_id % 2 = 0) group by ak, day"
    ),
)
def _old_auth(spark, sf):
    log = log_of(spark, sf)
    opened = log.withColumn("ifo", F.when(F.col("event_id") % 2 == 0, "true").otherwise(F.col("ifo")))
    return first_seen.old_rule_auth(opened).groupBy("ak", "day").agg(F.count_distinct("uu").alias("new_auth"))


@query(
    "new_auth_by_openid",
    over_log(
        "select ak, day, count(*) as new_auth from (select * from log where op <> 'useless_openid'"
        f" and img <> 'useless_img' {_FIRST}) group by ak, day"
    ),
)
def _open_auth(spark, sf):
    firsts = first_seen.first_seen(first_seen.auth_records(log_of(spark, sf)))
    return firsts.groupBy("ak", "day").agg(F.count("*").alias("new_auth"))


@query("known_user_load", over_log("select distinct ak, op, 'new_user' as kind, cast(1700000000000 as bigint) as first_ts"
                                   " from log where op <> 'useless_openid'"))
def _load(spark, sf):
    known = log_of(spark, sf).filter(has_openid()).select("ak", "op")
    return first_seen.load_known_users(known, None, 1_700_000_000_000)


# -- retention and abnormal traffic ---------------------------------------------------

_COHORTS = f"""
 base as (select distinct day, ak, op from log),
 known as (select * from log where op <> 'useless_openid'),
 new_first as (select event_id from known {_FIRST}),
 app_rows as (select k.* exclude (ifo), case when f.event_id is null then 'false' else 'true' end as ifo
              from known k left join new_first f on f.event_id = k.event_id),
 visits as ({LINK_JOIN.format(source="app_rows")}),
 members as (
  {" union all ".join(f"select day, ak, '{d}' as dimension, {v} as dimension_value, op,"
   " max(case when ifo = 'true' then 1 else 0 end) as is_new from visits group by all"
   for d, v in (("default", "'default'"), ("link_key", "link_key"), ("media_id", "media_id"), ("position_id", "position_id")))}),
 offsets as (select unnest(range(0, 8)) as n),
 shifted as (select m.*, n, strftime(strptime(m.day, '%Y%m%d') + to_days(cast(n as int)), '%Y%m%d') as stat_day
             from members m cross join offsets),
 days as (select distinct day from base)"""


def _retention_sql(where: str = "true") -> str:
    return f"""
 select s.day, s.ak, s.dimension, s.dimension_value, cast(s.n as int) as day_after, s.stat_day,
  count(*) as visitor_count, cast(sum(is_new) as bigint) as new_visitor_count,
  count(b.op) as people_left, cast(sum(case when b.op is null then 0 else is_new end) as bigint) as new_people_left,
  case when s.n = 0 then cast(0 as double) else count(b.op) / count(*) end as active_people_ratio,
  case when s.n = 0 or sum(is_new) = 0 then cast(0 as double)
       else sum(case when b.op is null then 0 else is_new end) / sum(is_new) end as new_people_ratio
 from shifted s left join base b on b.day = s.stat_day and b.ak = s.ak and b.op = s.op
 where s.stat_day in (select day from days) and {where}
 group by s.day, s.ak, s.dimension, s.dimension_value, s.n, s.stat_day"""


query("retention", over_log(_retention_sql(), "links", ctes=_COHORTS))(
    lambda spark, sf: retention.retention(log_of(spark, sf), lookup(spark, "links"))
)
query("retention_app", over_log(_retention_sql("dimension = 'default'"), "links", ctes=_COHORTS))(
    lambda spark, sf: retention.retention(log_of(spark, sf), lookup(spark, "links")).filter("dimension = 'default'")
)
query("retention_base_users", over_log("select distinct day, ak, op from log"))(
    lambda spark, sf: retention.base_users(log_of(spark, sf))
)
query(
    "retention_cohorts",
    over_log(
        "select day, ak, op, link_key, media_id, position_id, max(case when ifo = 'true' then 1 else 0 end) as is_new"
        " from visits group by all", "links", ctes=_COHORTS,
    ),
)(lambda spark, sf: retention.cohort_visits(log_of(spark, sf), lookup(spark, "links")))


def _suspicious_sql(threshold: int) -> str:
    address = "ak, day, client_ip"
    return (
        f"select {address}, auth_count, uv from (select {address}, count(distinct op) as uv from visits group by {address})"
        f" join (select {address}, count(distinct op) as auth_count from (select * from visits where img <> 'useless_img' {_FIRST})"
        f" group by {address}) using ({address}) where auth_count > {threshold}"
    )


query(
    "suspicious_ips",
    over_log(
        _suspicious_sql(0),
        ctes=" visits as (select * from log where op <> 'useless_openid' and v >= '7.3.0')",
    ),
)(lambda spark, sf: cheat.suspicious_ips(log_of(spark, sf), threshold=0))

# At the default threshold: all records come from one address, and each user goes by forty names.
_MANY = "(select * exclude (op, client_ip), op || '-' || cast(event_id % 40 as varchar) as op, 'one' as client_ip from log) log"
query(
    "suspicious_ips_default",
    over_log(
        _suspicious_sql(S.CHEAT_THRESHOLD),
        ctes=f" visits as (select * from {_MANY} where op not like 'useless_openid%' and v >= '7.3.0')",
    ),
)(lambda spark, sf: cheat.suspicious_ips(
    log_of(spark, sf).filter(has_openid()).withColumns(
        {"op": F.concat_ws("-", "op", (F.col("event_id") % 40).cast("string")), "client_ip": F.lit("one")}
    )
))

