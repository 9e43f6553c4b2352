"""Check SQL of the registered queries: sessions, visitors and views computed apart and joined."""

from __future__ import annotations

from footfall import schema as S
from footfall.operators.traffic import level_name
from footfall.plans.specs import JOBS, REPORTS, TERMINAL, TERMINAL_DIMS, ReportSpec
from footfall.workload.log import oracle_ctes

NOT_APP_LEVEL = "not (v >= '7.0.0' and ev = 'app')"
AD_SCENES = ", ".join(f"'{s}'" for s in S.AD_SCENES)
SHARE_SCENES = ", ".join(f"'{s}'" for s in S.SHARE_SCENES)
POSITION = f"case when scene in ({AD_SCENES}) then scene else '{S.OTHER}' end"

MARKS = "marks as (select distinct day, att from log where ifo = 'true' and v < '7.0.0')"


def ratio(part: str, whole: str, name: str) -> str:
    return (
        f"case when {whole} > 0 then cast((200 * cast({part} as bigint) + {whole}) // (2 * {whole}) as double) / 100"
        f" else cast(0 as double) end as {name}"
    )


RATIO = {
    "avg_stay_time": ("total_stay_time", "total_page_count"),
    "secondary_avg_stay_time": ("total_stay_time", "open_count"),
    "bounce_rate": ("one_page_count", "open_count"),
}

SCENE_ROWS = f"""
select l.* exclude (scene), case when g.scene_id is null then '{S.OTHER}' else l.scene end as scene,
 coalesce(g.scene_group_id, '{S.OTHER}') as scene_group
from log l left join scenes g on g.te = l.te and g.scene_id = l.scene where {NOT_APP_LEVEL}"""
QR_ROWS = f"""
select l.*, case when c.qr_group_key = '' then '{S.OTHER}' else c.qr_group_key end as qr_group
from log l join qr_codes c on c.app_key = l.ak and c.qr_key = l.qr where {NOT_APP_LEVEL}"""
LINK_JOIN = f"""
select l.* exclude (media_id), cast(k.media_id as varchar) as media_id, {POSITION} as position_id
from {{source}} l join links k on k.app_key = l.ak and k.link_key = l.link_key and k.is_del = 0"""
PHONE_ROWS = f"""
select l.*, coalesce(p.brand, '{S.UNKNOWN}') as brand, coalesce(p.name, '{S.UNKNOWN}') as model
from log l left join phones p on p.uname = l.pm"""

FAMILY_ROWS = {
    "trend": (f"select * from log where {NOT_APP_LEVEL}", ()),
    "scene": (SCENE_ROWS, ("scenes",)),
    "qr": (QR_ROWS, ("qr_codes",)),
    "link": (LINK_JOIN.format(source="log") + f" where {NOT_APP_LEVEL}", ("links",)),
    "region": ("select * from log where city <> ''", ()),
    "phone": (PHONE_ROWS, ("phones",)),
    "terminal": ("select *, ww || '*' || wh as ww_wh from log", ()),
}


def _level_sql(spec: ReportSpec, level: tuple[str, ...], many: bool) -> str:
    group = ", ".join(["ak", "day", *level])
    page = "ev = 'page'" if spec.page_level else "pp <> 'useless_page'"
    who = spec.identity if spec.page_level else f"case when {page} then {spec.identity} end"
    auth_join, auth_col = "", ""
    if spec.auth:
        auth_join = f"""
 join (select {group}, count(distinct old_auth) as old_auth from rows group by {group}) a using ({group})
 left join (select {group}, count(*) as first_auth from auth_first group by {group}) f using ({group})"""
        auth_col = ", case when coalesce(first_auth, 0) <> 0 then first_auth else old_auth end as new_auth_count"
    outside = [f"'all' as {d}" for d in spec.dims if d not in level] if many else []
    label = [f"'{level_name(level)}' as level"] if many else []
    shown = [*spec.metrics, *(["new_auth_count"] if spec.auth else []), *[ratio(*RATIO[r], r) for r in spec.ratios]]
    return f"""
select {", ".join(["ak", "day", *label, *level, *outside, *shown])} from (
 select * {auth_col} from
 (select {group}, cast(sum(is_new) as bigint) as new_comer_count, count(*) as open_count,
   cast(sum(stay) as bigint) as total_stay_time, count(*) filter (where pages = 1) as one_page_count
  from (select {group}, att, count(distinct pp) as pages, max(dr) as stay, max(new_record) as is_new
        from rows group by {group}, att) one group by {group}) s
 join (select {group}, count(*) filter (where {page}) as total_page_count, count(distinct {who}) as visitor_count
       from rows group by {group}) v using ({group}){auth_join})"""


def traffic(spec: ReportSpec, head: str | None = None) -> str:
    """``head`` gives another ``log`` than the workload's."""
    source, names = FAMILY_ROWS[spec.family]
    many = len(spec.levels) > 1
    new = "case when p.ifo = 'true'" + (" or m.att is not null" if spec.session_marks else "") + " then 1 else 0 end"
    mark_join = "left join marks m on m.day = p.day and m.att = p.att" if spec.session_marks else ""
    old_auth = (
        ", case when p.op = 'useless_openid' and p.img <> 'useless_img' and (p.ifo = 'true' or m.att is not null)"
        " then p.uu end as old_auth"
        if spec.auth
        else ""
    )
    parts = [
        head or oracle_ctes(*names),
        MARKS,
        f"prepared as ({source})",
        f"rows as (select p.*, {new} as new_record {old_auth} from prepared p {mark_join})",
    ]
    if spec.auth:
        parts.append(
            "auth_first as (select * from rows where op <> 'useless_openid' and img <> 'useless_img'"
            " qualify row_number() over (partition by ak, op order by et, event_id) = 1)"
        )
    return "with " + ",\n".join(parts) + "\n" + "\nunion all by name".join(_level_sql(spec, lv, many) for lv in spec.levels)


def report_oracles() -> dict[str, str]:
    found = {name: traffic(spec) for name, spec in {**REPORTS, **JOBS}.items()}
    found["hourly_trend"] = f"select *, 0 as avg_refresh_count from ({found['hourly_trend']})"
    stacked = traffic(TERMINAL)
    value = " ".join(f"when '{level_name((d,))}' then {d}" for d in TERMINAL_DIMS)
    found["daily_terminal"] = (
        f"select ak, day, level as type, case level {value} end as type_value, * exclude (ak, day, level,"
        f" secondary_avg_stay_time, {', '.join(TERMINAL_DIMS)}), secondary_avg_stay_time as avg_stay_time from ({stacked})"
    )
    found["debug_daily_trend"] = found["daily_trend"]
    found["debug_hourly_trend"] = found["hourly_trend"]
    return found
