"""Log -> fact table of the user-group analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall import schema as S
from footfall.functions import text
from footfall.operators import enrich, filters
from footfall.plans.reports import Lookups


def explode_event_params(log: DataFrame, column: str = "ct") -> DataFrame:
    """One row per key of the JSON event parameters; anything else gives one ``null`` row."""
    params = F.from_json(F.col(column), "map<string,string>")
    filled = F.when(text.present(F.col(column)) & (F.size(F.coalesce(params, F.create_map())) > 0), params)
    return (
        log.select("*", F.explode_outer(filled).alias("ct_key", "ct_value"))
        .withColumns({c: F.coalesce(F.col(c), F.lit(S.NULL_TEXT)) for c in ("ct_key", "ct_value")})
    )


def fact_rows(log: DataFrame, lookups: Lookups) -> DataFrame:
    """The 25 text columns of the fact table, missing values as the text ``null``."""
    rows = enrich.propagate_new_user(filters.require(log, "fact"), old_sdk_only=False)
    scene, link, phone = text.present(F.col("scene")), text.present(F.col("link_key")), text.present(F.col("pm"))
    rows = rows.withColumns({"_scene": F.col("scene"), "_qr": text.present(F.col("qr")), "_link": link, "_phone": phone})
    rows = enrich.add_scene_group(rows, lookups.scenes)
    rows = enrich.add_qr_group_or_other(rows, lookups.qr_codes)
    rows = enrich.add_media(rows, lookups.links, how="left")
    rows = enrich.add_phone(rows, lookups.phones)
    rows = rows.withColumns(
        {
            "scene_group": F.when(text.present(F.col("_scene")), F.col("scene_group")),
            "scene": F.col("_scene"),
            "qr_group": F.when(F.col("_qr"), F.col("qr_group")),
            "link_scene": F.when(F.col("_link"), enrich.position_of(F.col("_scene"))),
            "media_id": F.when(F.col("_link"), F.col("media_id")),
            "phone_model": F.when(F.col("_phone"), F.col("model")),
            "phone_brand": F.when(F.col("_phone"), F.col("brand")),
            "ald_day": F.col("day"),
        }
    )
    rows = explode_event_params(rows)
    return rows.select(*[F.coalesce(text.blank_to_null(F.col(c)), F.lit(S.NULL_TEXT)).alias(c) for c in S.FACT_FIELDS])


