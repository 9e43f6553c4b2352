"""Column names, schemas and fixed code lists of the app-behaviour log."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field names and codes as the log producers write them.
# ---------------------------------------------------------------------------

RAW_FIELDS = """
ak te uu op at et st day hour ev life tp pp lp path ct_path dr ifo ifp img v
scene scene_group_id qr qr_group wsr wst waid ag ag_ald_link_key ag_ald_media_id
ag_ald_position_id ag_aldsrc wsr_query_ald_link_key wsr_query_ald_media_id
wsr_query_ald_position_id wsr_query_ald_link_name wsr_query_ald_share_src
wsr_query_aldsrc ct_utm_s ct_utm_m ct_utm_p wsr_query_utm_s wsr_query_utm_m
wsr_query_utm_p ct ct_chain pm brand model pr ww wh lang nt sv wsdk wv wvv lat
lng spd province city client_ip ec error_messsage src layer gender ufo
""".split()

FACT_FIELDS = """
ak uu att pp ifo tp ald_day ev scene scene_group qr qr_group link_key media_id
link_scene province city phone_model phone_brand wvv wv nt path ct_key ct_value
""".split()

# Raw name -> name used by the operators.
RENAMED = {
    "at": "att",
    "wsr_query_ald_link_key": "link_key",
    "wsr_query_ald_media_id": "media_id",
    "wsr_query_ald_position_id": "position_id",
    "wsr_query_ald_link_name": "link_name",
    "wsr_query_ald_share_src": "share_src",
}

QR_SCENES = ("1011", "1012", "1013", "1047", "1048", "1049", "1072")
AD_SCENES = ("1014", "1035", "1038", "1058")
SHARE_SCENES = ("1007", "1008", "1036", "1044", "1074")
LEGACY_CUSTOM_SDKS = ("M5.1", "dev1", "D3.99", "B3.88")

SHARE_STATUS = "ald_share_status"
SHARE_CLICK = "ald_share_click"

NO_IMG = "useless_img"
NO_OPENID = "useless_openid"
NO_PAGE = "useless_page"
NO_LEVEL = "useless_level"
NULL_TEXT = "null"

OTHER = "其它"
UNKNOWN = "未知"
UNKNOWN_ACTIVITY = "未知活动"
UNKNOWN_CHANNEL = "未知渠道"
MALE, FEMALE = "男", "女"
NO_TIME = "0000-00-00 00:00:00"

OPENID_LENGTH = 28
CHEAT_THRESHOLD = 10
RETENTION_DAYS = 7
DEFAULT_SDK = "7.0.0"
DEFAULT_PLATFORM = "wx"

# ---------------------------------------------------------------------------

ALL = "all"  # marks a dimension that a rollup level does not split by


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_SCHEMA = _strings(RAW_FIELDS)
FACT_SCHEMA = _strings(FACT_FIELDS)
RETENTION_SCAN = _strings("ak op ifo scene wsr_query_ald_link_key pp v".split())
CHEAT_SCAN = _strings("ak op img client_ip wsr_query_ald_link_key v".split())
FIRST_SEEN_SCHEMA = T.StructType(
    [
        T.StructField("ak", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("first_ts", T.LongType()),
    ]
)
