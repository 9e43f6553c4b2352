"""Raw JSON lines made from the event table, normalised again; and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import schema as S
from footfall.operators import factlog
from footfall.operators.normalize import count_rejects, normalize_log
from footfall.workload.log import DUCKDB, KEYED, SPARK, log_of, lookups_of, table
from footfall.plans.specs import REPORTS
from footfall.workload.oracle import POSITION, traffic
from footfall.workload.registry import over_log, query

# Raw fields as a client sends them, with the gaps the rules are there for. Both engines
# evaluate this text; only Spark then writes it as JSON and parses it again.
_RAW = """
 select event_id, k, et as true_et,
 'app' || cast(user_id % 7 as {S}) as ak,
 case when user_id % 5 = 0 then 'qx' when user_id % 5 = 1 then 'null' else '' end as te,
 'u' || cast(user_id as {S}) as uu,
 case when user_id % 4 = 0 then '' else 'o' || cast(user_id as {S}) end as op,
 's' || cast(user_id as {S}) || '-' || day as "at",
 case when k % 5 = 0 then cast({SEC} as {S}) when k % 11 = 7 then 'bad' else cast(et as {S}) end as et,
 case when k % 4 = 0 then 'true' else 'null' end as ifo,
 case when k % 3 = 0 then 'img' else '' end as img,
 case when k % 9 = 0 then '6.9.9' when k % 9 = 1 then 'null' when k % 9 = 2 then 'M5.1' when k % 9 = 3 then '10.1.0' else '7.3.0' end as v,
 case k % 8 when 0 then 'x1' when 1 then '' when 2 then cast(-5000 - user_id as {S}) else cast(1000 + user_id as {S}) end as dr,
 case when k % 12 = 0 then '' else 'page' end as ev,
 case when k % 12 = 0 then 'null' else 'pages/' || cast(k % 4 as {S}) end as pp,
 case k % 6 when 0 then '1014' when 1 then '1011' when 2 then 'null' else '' end as scene,
 case when k % 2 = 0 then 'p' || cast(k % 7 as {S}) || '?a=1&utm_s=src' || cast(k as {S}) else '' end as ct_path,
 case when k % 5 < 2 then '' else 'q' || cast(k % 8 as {S}) end as qr,
 case when k % 7 < 3 then 'null' else 'L' || cast(k % 5 as {S}) end as wsr_query_ald_link_key,
 case when k % 3 = 0 then '' else 'us' || cast(k % 3 as {S}) end as wsr_query_utm_s,
 case when k % 4 = 0 then 'null' else 'um' || cast(k % 4 as {S}) end as wsr_query_utm_m
 from keyed"""
# Inside the nested JSON strings of a line.
_WSR_SCENE, _WSR_PATH, _GENDER = "1000 + k % 100", "'w' || cast(k % 9 as {S})", "k % 3"


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id``, ``ingest_ms`` and one JSON line; every tenth line is cut off or empty."""
    events = table(spark, sf_dir, "events")
    keyed = spark.sql(KEYED.format(**SPARK).replace("from events", "from {events}"), events=events)
    raw = spark.sql(_RAW.format(SEC="et div 1000", **SPARK).replace('"at"', "`at`").replace("from keyed", "from {keyed}"), keyed=keyed)
    nested = raw.withColumns(
        {
            "wsr": F.to_json(F.struct(F.expr(_WSR_PATH.format(**SPARK)).alias("path"), F.expr(_WSR_SCENE).cast("string").alias("scene"))),
            "ufo": F.to_json(F.struct(F.to_json(F.struct(F.expr(_GENDER).cast("string").alias("gender"))).alias("userInfo"))),
        }
    )
    fields = [c for c in nested.columns if c not in ("event_id", "k", "true_et")]
    line = F.to_json(F.struct(*fields))
    cut = F.when(F.col("event_id") % 20 == 19, F.lit("{}")).when(
        F.col("event_id") % 10 == 9, F.expr("substr(line, 1, length(line) - 1)")
    ).otherwise(F.col("line"))
    return nested.withColumn("line", line).select("event_id", F.col("true_et").alias("ingest_ms"), cut.alias("value"))


_BLANK = "case when {0} in ('', 'null') then null else {0} end"


def _b(name: str) -> str:
    return _BLANK.format(name)


_CLEAN = f"""
 raw as ({_RAW.format(SEC="et // 1000", **DUCKDB)}),
 clean as (
  select event_id, k, ak, coalesce({_b('te')}, 'wx') as te, uu, coalesce({_b('op')}, 'useless_openid') as op, "at" as att,
   case when et = 'bad' then true_et when length(et) = 10 then cast(et as bigint) * 1000 else cast(et as bigint) end as et,
   coalesce({_b('ifo')}, 'false') as ifo, coalesce({_b('img')}, 'useless_img') as img, coalesce({_b('v')}, '7.0.0') as v,
   {_b('dr')} as dr, {_b('ev')} as ev, {_b('pp')} as pp,
   coalesce({_b('scene')}, cast({_WSR_SCENE} as varchar)) as scene,
   coalesce(nullif(string_split(ct_path, '?')[1], ''), {_WSR_PATH.format(**DUCKDB)}) as path,
   case when k % 2 = 0 then 'src' || cast(k as varchar) else 'null' end as ct_utm_s,
   cast({_GENDER} as varchar) as gender, {_b('qr')} as qr, {_b('wsr_query_ald_link_key')} as link_key,
   {_b('wsr_query_utm_s')} as utm_s, {_b('wsr_query_utm_m')} as utm_m
  from raw where event_id % 10 <> 9)"""

_QR = ", ".join(f"'{s}'" for s in S.QR_SCENES)
_AD = ", ".join(f"'{s}'" for s in S.AD_SCENES)
_FILLER = (
    "cast('0x' || substr(md5(coalesce(ak, '') || '|' || coalesce(att, '') || '|' || cast(et as varchar)), 1, 8) as bigint) % 50 + 10"
)
_AUTH = "img <> 'useless_img' and ifo = 'true'"
_DR = f"case when dr is null and {_AUTH} then '0' else dr end"
_OLD = "(v = 'M5.1' or v = '6.9.9')"

_COLUMNS = [
    "event_id", "ak", "te", "uu", "op", "att", "et", "day", "hour", "ifo", "img", "v", "dr", "ev", "pp", "scene", "path",
    "ct_utm_s", "gender", "qr", "qr_group", "link_key", "media_id", "wsr_query_utm_s", "wsr_query_utm_m", "wsr_query_utm_p",
]


_NORMALIZED = f"""
 select event_id, ak, te, uu, op, att, et, strftime(make_timestamp(et * 1000), '%Y%m%d') as day,
  strftime(make_timestamp(et * 1000), '%H') as hour, ifo, img, v,
  case when {_DR} is null then {_FILLER} when not {_OLD} then case when try_cast({_DR} as bigint) <= -1000 then {_FILLER} else coalesce(greatest(try_cast({_DR} as bigint), 0) // 1000, 0) end
       when try_cast({_DR} as bigint) >= 0 then try_cast({_DR} as bigint) else {_FILLER} end as dr,
  case when ev is null and {_AUTH} then 'useless_level' else ev end as ev,
  case when pp is null and {_AUTH} then 'useless_page' else pp end as pp, scene, path, ct_utm_s, gender,
  case when qr is null and scene in ({_QR}) then utm_s else qr end as qr,
  case when qr is null and scene in ({_QR}) and utm_s is not null then utm_m end as qr_group,
  case when link_key is null and scene in ({_AD}) and utm_s is not null and utm_m is not null then utm_s else link_key end as link_key,
  case when link_key is null and scene in ({_AD}) and utm_s is not null and utm_m is not null then utm_m end as media_id,
  coalesce(utm_s, 'null') as wsr_query_utm_s, coalesce(utm_m, 'null') as wsr_query_utm_m, 'null' as wsr_query_utm_p
 from clean"""


def raw_trend_check() -> str:
    """Check SQL of the daily trend over the normalised lines."""
    log = f"select * from ({_NORMALIZED}) where ev is not null and pp is not null"
    return traffic(REPORTS["daily_trend"], f"keyed as ({KEYED.format(**DUCKDB)}), {_CLEAN}, log as ({log})")


@query("normalized_log", over_log(_NORMALIZED, ctes=_CLEAN))
def _normalized(spark, sf):
    return normalize_log(raw_lines(spark, sf), ingest_ms="ingest_ms", keep=("event_id",)).select(*_COLUMNS)


query(
    "rejected_lines",
    "select count(*) as lines, count(*) filter (where event_id % 10 = 9) as rejected from events",
)(lambda spark, sf: count_rejects(raw_lines(spark, sf)))

# -- fact table ------------------------------------------------------------------------

_CT = "case when event_id % 4 = 0 then '' when event_id % 4 = 1 then 'text' else '{{\"a\":\"' || cast(event_id as {S}) || '\",\"b\":\"x:y,z\"}}' end"
_FACT_ROWS = f"""
 explained as (
  select l.* exclude (ifo, media_id), case when bool_or(ifo = 'true') over (partition by day, att) then 'true' else ifo end as ifo,
   coalesce(g.scene_group_id, '{S.OTHER}') as scene_group,
   coalesce(case when c.qr_group_key = '' then '{S.OTHER}' else c.qr_group_key end, '{S.OTHER}') as qr_group,
   coalesce(cast(k.media_id as varchar), 'null') as media_id, {POSITION} as link_scene,
   coalesce(p.brand, '{S.UNKNOWN}') as phone_brand, coalesce(p.name, '{S.UNKNOWN}') as phone_model
  from log l left join scenes g on g.te = l.te and g.scene_id = l.scene
  left join qr_codes c on c.app_key = l.ak and c.qr_key = l.qr
  left join links k on k.app_key = l.ak and k.link_key = l.link_key and k.is_del = 0
  left join phones p on p.uname = l.pm),
 params as (select 'a' as ct_key union all select 'b')"""
_FACT_COLUMNS = (
    "ak, uu, att, pp, ifo, tp, day as ald_day, ev, scene, scene_group, qr, qr_group, link_key, media_id, link_scene, province,"
    " case when city = '' then 'null' else city end as city, phone_model, phone_brand, wvv, wv, nt, path"
)


@query(
    "fact_table",
    over_log(
        f"select {_FACT_COLUMNS}, 'null' as ct_key, 'null' as ct_value from explained where event_id % 4 < 2 union all"
        f" select {_FACT_COLUMNS}, ct_key, case ct_key when 'a' then cast(event_id as varchar) else 'x:y,z' end as ct_value"
        " from explained cross join params where event_id % 4 >= 2",
        "scenes", "qr_codes", "links", "phones", ctes=_FACT_ROWS,
    ),
)
def _facts(spark, sf):
    log = log_of(spark, sf).withColumn("ct", F.expr(_CT.format(**SPARK)))
    return factlog.fact_rows(log, lookups_of(spark))


@query(
    "event_params",
    "select event_id, 'null' as ct_key, 'null' as ct_value from events where event_id % 4 < 2 union all"
    " select event_id, k, case k when 'a' then cast(event_id as varchar) else 'x:y,z' end from events"
    " cross join (select unnest(['a', 'b']) as k) where event_id % 4 >= 2",
)
def _params(spark, sf):
    log = table(spark, sf, "events").select("event_id", F.expr(_CT.format(**SPARK)).alias("ct"))
    return factlog.explode_event_params(log).select("event_id", "ct_key", "ct_value")
