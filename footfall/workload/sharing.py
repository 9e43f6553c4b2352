"""Share reports, entrance pages, SDK versions, activity detail."""

from __future__ import annotations

from footfall import schema as S
from footfall.operators import sessions
from footfall.plans import reports
from footfall.workload.log import log_of, lookup
from footfall.workload.oracle import MARKS, SHARE_SCENES, ratio
from footfall.workload.registry import over_log, query

# -- share ------------------------------------------------------------------------

_CLEAN = "regexp_replace(path, '^/', '')"
_SHARED = f"""
 {MARKS},
 shared as (
  select l.* exclude (path, pp, ct_utm_s, ct_utm_p), {_CLEAN} as path,
   case when tp = 'ald_share_click' then wsr_query_utm_s else ct_utm_s end as source,
   case when tp = 'ald_share_click' then wsr_query_utm_p else ct_utm_p end as paras,
   case when share_src = 'null' then null else list_extract(string_split(share_src, ','), -1) end as src,
   case when share_src = 'null' then null else cast(len(string_split(share_src, ',')) as varchar) end as layer,
   case when ifo = 'true' or m.att is not null then 1 else 0 end as new_record
  from log l left join marks m on m.day = l.day and m.att = l.att
  where ev = 'event' and (tp = 'ald_share_status' or (tp = 'ald_share_click' and scene in ({SHARE_SCENES}))))
"""


def _share_sql(dims: str, extra: str = "", where: str = "true", columns: str = "share_user_count,") -> str:
    group = f"ak, day, {dims}"
    return f"""
 select {group}, {columns} coalesce(share_count, 0) as share_count, coalesce(share_open_count, 0) as share_open_count,
  coalesce(share_open_user_count, 0) as share_open_user_count, coalesce(new_count, 0) as new_count,
  {ratio("coalesce(share_open_count, 0)", "coalesce(share_count, 0)", "share_reflux_ratio")} {extra}
 from (select {group}, count(*) as share_count, count(distinct uu) as share_users from shared
       where tp = 'ald_share_status' and {where} group by {group}) s
 full join (select {group}, count(distinct att) as share_open_count, count(distinct uu) as share_open_user_count,
        count(distinct case when new_record = 1 then att end) as new_count from shared
       where tp = 'ald_share_click' and {where} group by {group}) c using ({group})"""


_USERS = "coalesce(share_users, 0) as share_user_count,"

query("daily_share_summary", over_log(_share_sql("te", columns=_USERS), ctes=_SHARED))(
    lambda spark, sf: reports.share_summary(log_of(spark, sf))
)
query("hourly_share_summary", over_log(_share_sql("te, hour", columns=_USERS), ctes=_SHARED))(
    lambda spark, sf: reports.share_summary(log_of(spark, sf), by_hour=True)
)
query(
    "daily_page_share",
    over_log(
        "select * exclude (path), path as page_uri from ("
        + _share_sql("te, path, source, paras", columns=_USERS) + ")",
        ctes=_SHARED,
    ),
)(lambda spark, sf: reports.page_share(log_of(spark, sf)))

_PROFILES = f"""
 profiles as (
  select ak, uu as src, case when city = '' then '{S.UNKNOWN}' else city end as city,
   case gender when '1' then '{S.MALE}' when '2' then '{S.FEMALE}' else '{S.UNKNOWN}' end as gender
  from log qualify row_number() over (partition by ak, uu order by et desc, event_id desc) = 1)"""
_USER_SHARE = _share_sql("te, src, layer", where="src is not null", columns="")
query(
    "daily_user_share",
    over_log(
        f"select t.*, coalesce(p.city, '{S.UNKNOWN}') as city, coalesce(p.gender, '{S.UNKNOWN}') as gender"
        f" from ({_USER_SHARE}) t left join profiles p on p.ak = t.ak and p.src = t.src",
        ctes=_SHARED + "," + _PROFILES,
    ),
)(lambda spark, sf: reports.user_share(log_of(spark, sf)))

# -- pages ------------------------------------------------------------------------

_ENTRY = """
 visits as (select * from log where ev = 'page'),
 one as (select ak, day, att, arg_min(pp, et) as page_path, count(distinct pp) as pages, count(*) as pv, max(dr) as stay
         from visits group by ak, day, att),
 by_page as (
  select ak, day, page_path, count(*) as entry_page_count, count(*) filter (where pages = 1) as one_page_count,
   cast(sum(pv) as bigint) as page_count, count(*) as visitor_count, count(*) as open_count,
   cast(sum(stay) as bigint) as total_time
  from one group by ak, day, page_path)"""
_ENTRY_RATIOS = f"{ratio('total_time', 'open_count', 'avg_stay_time')}, {ratio('one_page_count', 'open_count', 'bounce_rate')}"

query("daily_entrance_page", over_log(f"select *, {_ENTRY_RATIOS} from by_page", ctes=_ENTRY))(
    lambda spark, sf: reports.entry_pages(log_of(spark, sf))
)
query(
    "daily_entrance_app",
    over_log(
        f"select *, {_ENTRY_RATIOS} from (select ak, day, "
        + ", ".join(
            f"cast(sum({c}) as bigint) as {c}"
            for c in ("entry_page_count", "one_page_count", "page_count", "visitor_count", "open_count", "total_time")
        )
        + " from by_page group by ak, day)",
        ctes=_ENTRY,
    ),
)(lambda spark, sf: reports.entry_app(log_of(spark, sf)))
query(
    "daily_visited_page",
    over_log(
        """
 select v.ak, v.day, v.pp as page_path, count(*) as page_count, count(distinct v.att) as open_count,
  count(distinct case when o.page_path = v.pp then v.att end) as entry_page_count,
  count(distinct case when o.pages = 1 then v.att end) as one_page_count,
  any_value(t.total_time) as total_time
 from visits v join one o using (ak, day, att)
 join (select ak, day, pp, cast(sum(stay) as bigint) as total_time
       from (select ak, day, pp, att, max(dr) as stay from visits group by all) group by all) t using (ak, day, pp)
 group by v.ak, v.day, v.pp""",
        ctes=_ENTRY,
    ),
)(lambda spark, sf: sessions.visited_page_totals(log_of(spark, sf).filter("ev = 'page'")))

# -- versions and activities --------------------------------------------------------

query(
    "sdk_versions",
    over_log(
        "select distinct ak, day, v as version, case when cast(split_part(v, '.', 3) as int) % 2 <> 0 then 1 else 0 end"
        " as is_third from log"
    ),
)(lambda spark, sf: reports.sdk_versions(log_of(spark, sf)))

_CLOCK = "strftime(make_timestamp({} * 1000), '%Y-%m-%d %H:%M:%S')"
query(
    "ad_activity_detail",
    over_log(
        f"""
 select d.ak, d.day, d.hour, d.activity, d.channel, d.op as openid,
  case when n.op is not null then 0 else 1 end as is_new_user,
  case when k.et <= d.last_et then {_CLOCK.format('k.et')} else '{S.NO_TIME}' end as first_visit_time,
  case when n.img <> 'useless_img' then 0 else 1 end as is_new_authorization,
  case when n.img <> 'useless_img' then {_CLOCK.format('n.et')} else '{S.NO_TIME}' end as authorization_time
 from (select ak, day, hour, activity, channel, op, max(et) as last_et from rows group by all) d
 left join firsts n on n.ak = d.ak and n.op = d.op and n.day = d.day and n.hour = d.hour
  and n.activity = d.activity and n.channel = d.channel
 left join firsts k on k.ak = d.ak and k.op = d.op""",
        "links", "media",
        ctes=f"""
 rows as (
  select l.*, case when k.link_name = '' then '{S.UNKNOWN_ACTIVITY}' else k.link_name end as activity,
   coalesce(m.media_name, '{S.UNKNOWN_CHANNEL}') as channel
  from log l join links k on k.app_key = l.ak and k.link_key = l.link_key and k.is_del = 0
  left join media m on m.media_id = k.media_id where l.op <> 'useless_openid'),
 firsts as (select * from rows where ifo = 'true'
  qualify row_number() over (partition by ak, op order by et, event_id) = 1)""",
    ),
)(lambda spark, sf: reports.activity_detail(log_of(spark, sf), lookup(spark, "links"), lookup(spark, "media")))

