"""Row filters of the report families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import schema as S
from footfall.functions import text, versions

# Fields that must be present, per report family.
REQUIRED = {
    "trend": ("ak", "att", "ev", "uu", "et", "dr", "pp", "te"),
    "scene": ("ak", "att", "ev", "uu", "et", "dr", "pp", "te", "scene"),
    "qr": ("ak", "att", "ev", "uu", "et", "pp", "te", "qr"),
    "share": ("ak", "att", "ev", "uu", "et", "tp", "te", "path"),
    "link": ("ak", "att", "ev", "uu", "et", "dr", "pp", "img", "ifo", "scene", "link_key", "media_id"),
    "ad": ("ak", "att", "et", "dr", "pp", "ifo", "img", "scene", "link_key", "media_id"),
    "region": ("ak", "att", "ev", "uu", "et", "dr", "pp", "city", "province"),
    "phone": ("ak", "att", "ev", "uu", "et", "dr", "pp", "pm"),
    "terminal": ("ak", "att", "ev", "uu", "et", "dr", "pp", "lang", "nt", "sv", "wsdk", "wv", "wvv", "ww", "wh"),
    "entrance": ("ak", "att", "ev", "uu", "et", "dr", "pp"),
    "version": ("ak", "v"),
    "activity": ("ak", "et", "img", "ifo", "link_key", "media_id"),
    "fact": ("ak", "att", "ev", "et", "uu"),
}


def has_fields(names: tuple[str, ...] | list[str], df: DataFrame) -> Column:
    """All named columns present; numeric ones only need to be non-null."""
    kinds = dict(df.dtypes)
    checks = [text.present(F.col(n)) if kinds[n] == "string" else F.col(n).isNotNull() for n in names]
    condition = checks[0]
    for check in checks[1:]:
        condition = condition & check
    return condition


def require(df: DataFrame, family: str) -> DataFrame:
    return df.filter(has_fields(REQUIRED[family], df))


def without_app_level(df: DataFrame) -> DataFrame:
    """From SDK 7.0.0 on, ``app`` level records are not counted."""
    return df.filter(~(versions.at_least(F.col("v"), S.DEFAULT_SDK) & (F.col("ev") == "app")))


def is_share_status() -> Column:
    return (F.col("tp") == S.SHARE_STATUS) & (F.col("ev") == "event")


def is_share_click() -> Column:
    return (F.col("tp") == S.SHARE_CLICK) & (F.col("ev") == "event") & F.col("scene").isin(*S.SHARE_SCENES)


def is_page_view() -> Column:
    return F.col("pp") != S.NO_PAGE


def has_openid() -> Column:
    return text.present(F.col("op")) & (F.col("op") != S.NO_OPENID)


def is_authorised() -> Column:
    return F.col("img") != S.NO_IMG


def share_records(df: DataFrame) -> DataFrame:
    """Share and return-visit records with a cleaned path as page and one utm source.

    ``share_kind`` is ``status`` (a share) or ``click`` (a return visit). Return visits
    carry their source in the query of the opened link.
    """
    click = F.col("share_kind") == "click"
    kept = require(df.filter(F.col("tp").isin(S.SHARE_STATUS, S.SHARE_CLICK)), "share")
    return (
        kept.withColumn("share_kind", F.when(is_share_status(), "status").when(is_share_click(), "click"))
        .filter(F.col("share_kind").isNotNull())
        .withColumns(
            {
                "path": text.without_leading_slash(F.col("path")),
                "pp": text.without_leading_slash(F.col("path")),
                "ct_utm_s": F.when(click, F.col("wsr_query_utm_s")).otherwise(F.col("ct_utm_s")),
                "ct_utm_p": F.when(click, F.col("wsr_query_utm_p")).otherwise(F.col("ct_utm_p")),
            }
        )
    )
