"""The log the registered queries run on: a projection of the ``events`` table.

The same SELECT text runs in Spark and in the check engine, apart from the expressions
in ``SPARK`` and ``DUCKDB``. Lookups leave some keys out on purpose, so that both
dropping and defaulting joins show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.plans.reports import Lookups

SPARK = {
    "S": "string",
    "D": "date_format(ts, 'yyyyMMdd')",
    "H": "date_format(ts, 'HH')",
    "K": "cast(get_json_object(props, '$.k') as int)",
    "ET": "unix_millis(cast(ts as timestamp))",
}
DUCKDB = {
    "S": "varchar",
    "D": "strftime(ts, '%Y%m%d')",
    "H": "strftime(ts, '%H')",
    "K": "cast(props->>'$.k' as int)",
    "ET": "epoch_us(ts) // 1000",
}

KEYED = "select event_id, ts, user_id, event_type, value, {D} as day, {H} as hour, {ET} as et, {K} as k from events"

LOG = """
select event_id, et, day, hour,
 'app' || cast(user_id % 7 as {S}) as ak,
 case when user_id % 5 = 0 then 'qx' else 'wx' end as te,
 'u' || cast(user_id as {S}) as uu,
 case when user_id % 4 = 0 then 'useless_openid' else 'o' || cast(user_id as {S}) end as op,
 's' || cast(user_id as {S}) || '-' || day as att,
 case event_type when 'error' then 'app' when 'view' then 'page' else 'event' end as ev,
 case event_type when 'click' then 'ald_share_click' when 'signup' then 'ald_share_status' else 'null' end as tp,
 'pages/' || cast(k % 4 as {S}) as pp,
 '/pages/' || cast(k % 4 as {S}) as path,
 cast(floor(value) as bigint) as dr,
 case when event_type = 'signup' and event_id % 5 = 0 then 'true' else 'false' end as ifo,
 case when event_type = 'purchase' and event_id % 3 = 0 then 'img' else 'useless_img' end as img,
 case when event_id % 2 = 0 then '7.3.0' else '6.9.9' end as v,
 case k % 6 when 0 then '1014' when 1 then '1035' when 2 then '1058'
            when 3 then '1007' when 4 then '1036' else '1001' end as scene,
 'L' || cast(k % 5 as {S}) as link_key,
 'm' || cast(k % 3 as {S}) as media_id,
 'q' || cast(k % 8 as {S}) as qr,
 '10.0.0.' || cast(user_id % 11 as {S}) as client_ip,
 case k % 3 when 0 then 'u' || cast((user_id * 7) % 150 as {S})
            when 1 then 'u' || cast((user_id * 3) % 150 as {S}) || ',u' || cast((user_id * 7) % 150 as {S})
            else 'null' end as share_src,
 'c' || cast(k % 3 as {S}) as ct_utm_s, 'p' || cast(k % 2 as {S}) as ct_utm_p,
 'c' || cast(k % 4 as {S}) as wsr_query_utm_s, 'p' || cast(k % 2 as {S}) as wsr_query_utm_p,
 case when user_id % 13 = 0 then '' else 'city' || cast(user_id % 9 as {S}) end as city,
 'prov' || cast(user_id % 4 as {S}) as province,
 'dev' || cast(user_id % 6 as {S}) as pm,
 cast(user_id % 3 as {S}) as gender,
 'lang' || cast(user_id % 3 as {S}) as lang, 'nt' || cast(k % 3 as {S}) as nt,
 'sv' || cast(user_id % 5 as {S}) as sv, 'wsdk' || cast(user_id % 4 as {S}) as wsdk,
 'wv' || cast(user_id % 8 as {S}) as wv, 'wvv' || cast(user_id % 2 as {S}) as wvv,
 cast(300 + user_id % 3 as {S}) as ww, cast(600 + user_id % 2 as {S}) as wh
from keyed
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    keyed = spark.sql(KEYED.format(**SPARK).replace("from events", "from {events}"), events=events)
    return spark.sql(LOG.format(**SPARK).replace("from keyed", "from {keyed}"), keyed=keyed)


# -- lookups ----------------------------------------------------------------------


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


_SCENES = [
    ("wx", "1014", "6"), ("wx", "1035", "6"), ("wx", "1058", "6"), ("wx", "1007", "2"), ("wx", "1036", "2"),
    ("qx", "1014", "7"), ("qx", "1007", "3"),
]
_QR = [(f"app{a}", f"q{q}", "" if q == 3 else f"g{q % 3}", 1) for a in range(6) for q in range(7)]
_LINKS = [
    (f"app{a}", f"L{k}", 1 + (a + k) % 3, f"act{k}" if k else "", 1 if (a, k) == (2, 3) else 0)
    for a in range(7) for k in range(4)
]
_MEDIA = [(1, "channel one"), (2, "channel two")]
_PHONES = [(f"dev{d}", f"brand{d % 2}", f"model{d}") for d in range(5)]
_RELEASE = [("app0", 1), ("app1", 0), ("app2", 1)]

LOOKUP_VALUES = {
    "scenes": (_SCENES, "te, scene_id, scene_group_id"),
    "qr_codes": (_QR, "app_key, qr_key, qr_group_key, status"),
    "links": (_LINKS, "app_key, link_key, media_id, link_name, is_del"),
    "media": (_MEDIA, "media_id, media_name"),
    "phones": (_PHONES, "uname, brand, name"),
    "release": (_RELEASE, "ak, online_status"),
}


def lookup(spark: SparkSession, name: str) -> DataFrame:
    rows, columns = LOOKUP_VALUES[name]
    return spark.sql(f"select * from values {_values(rows)} as t({columns})")


def lookups_of(spark: SparkSession, **other: DataFrame) -> Lookups:
    return Lookups(**{name: lookup(spark, name) for name in LOOKUP_VALUES} | other)


def oracle_ctes(*names: str) -> str:
    """``keyed`` and ``log`` plus the named lookups, as the head of a WITH clause."""
    parts = [f"keyed as ({KEYED.format(**DUCKDB)})", f"log as ({LOG.format(**DUCKDB)})"]
    for name in names:
        rows, columns = LOOKUP_VALUES[name]
        parts.append(f"{name} as (select * from (values {_values(rows)}) t({columns}))")
    return ",\n".join(parts)
