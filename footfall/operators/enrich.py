"""Lookup joins and derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import schema as S
from footfall.functions import text, times, versions
from footfall.sources.lookups import link_lookup, lookup_first_wins, phone_lookup, qr_lookup, scene_lookup

# Lookups are folded to one row per key and joined plainly. Spark broadcasts a side by its size at
# run time, and splits a hot key of the log where it does not.


def add_scene_group(log: DataFrame, scenes: DataFrame) -> DataFrame:
    """(te, scene) -> scene group; blank is unknown, unmatched is "other" for scene and group."""
    side = scene_lookup(scenes.select("te", "scene_id", "scene_group_id")).select(
        "te", F.col("scene_id").alias("scene"), F.col("scene_group_id").alias("_group")
    )
    joined = log.withColumn("scene", F.trim("scene")).join(side, ["te", "scene"], "left")
    blank = ~text.present(F.col("scene"))
    known = F.col("_group").isNotNull()
    return joined.withColumns(
        {
            "scene_group": F.when(blank, S.UNKNOWN).when(known, F.col("_group")).otherwise(S.OTHER),
            "scene": F.when(blank, S.UNKNOWN).when(known, F.col("scene")).otherwise(S.OTHER),
        }
    ).drop("_group")


def _qr_groups(codes: DataFrame) -> DataFrame:
    return qr_lookup(codes.select("app_key", "qr_key", "qr_group_key")).select(
        F.col("app_key").alias("ak"), F.col("qr_key").alias("qr"), F.col("qr_group_key").alias("_group")
    )


def add_qr_group(log: DataFrame, codes: DataFrame) -> DataFrame:
    """(ak, qr) -> group; records of unknown codes go, a blank group is "other"."""
    joined = log.withColumn("qr", F.trim("qr")).join(_qr_groups(codes), ["ak", "qr"])
    return joined.withColumn("qr_group", text.or_default(F.col("_group"), S.OTHER)).drop("_group")


def add_qr_group_or_other(log: DataFrame, codes: DataFrame) -> DataFrame:
    """The fact-table form: unknown codes stay, as "other"."""
    joined = log.withColumn("qr", F.trim("qr")).join(_qr_groups(codes), ["ak", "qr"], "left")
    return joined.withColumn("qr_group", text.or_default(F.col("_group"), S.OTHER)).drop("_group")


def add_media(log: DataFrame, links: DataFrame, by_app: bool = True, how: str = "inner") -> DataFrame:
    """Link key -> media id. The default keys on (app, link) and drops unknown links."""
    keys = ["ak", "link_key"] if by_app else ["link_key"]
    side = link_lookup(links.select("app_key", "link_key", "media_id", "is_del")).select(
        F.col("app_key").alias("ak"), "link_key", F.col("media_id").cast("string").alias("_media")
    )
    if not by_app:
        side = side.groupBy("link_key").agg(F.min("_media").alias("_media"))
    joined = log.withColumn("link_key", F.trim("link_key")).join(side, keys, how)
    return joined.withColumn("media_id", F.col("_media")).drop("_media")


def position_of(scene: Column) -> Column:
    return F.when(scene.isin(*S.AD_SCENES), scene).otherwise(S.OTHER)


def add_position(log: DataFrame) -> DataFrame:
    return log.withColumn("position_id", position_of(F.col("scene")))


def add_activity_channel(log: DataFrame, links: DataFrame, media: DataFrame) -> DataFrame:
    """Link -> activity and channel names. Records of unknown links go."""
    link_side = link_lookup(links.select("app_key", "link_key", "media_id", "link_name", "is_del")).select(
        F.col("app_key").alias("ak"), "link_key",
        F.col("media_id").cast("string").alias("_media"), F.col("link_name").alias("_name"),
    )
    media_side = lookup_first_wins([media.select("media_id", "media_name")], ["media_id"]).select(
        F.col("media_id").cast("string").alias("_media"), F.col("media_name").alias("_channel")
    )
    joined = log.join(link_side, ["ak", "link_key"]).join(media_side, "_media", "left")
    return joined.withColumns(
        {
            "activity": text.or_default(F.col("_name"), S.UNKNOWN_ACTIVITY),
            "channel": text.or_default(F.col("_channel"), S.UNKNOWN_CHANNEL),
        }
    ).drop("_media", "_name", "_channel")


def add_phone(log: DataFrame, phones: DataFrame) -> DataFrame:
    """Device string -> brand and model."""
    side = phone_lookup(phones.select("uname", "brand", "name")).select(
        F.col("uname").alias("pm"), F.col("brand").alias("_brand"), F.col("name").alias("_model")
    )
    joined = log.withColumn("pm", F.trim("pm")).join(side, "pm", "left")
    return joined.withColumns(
        {
            "brand": text.or_default(F.col("_brand"), S.UNKNOWN),
            "model": text.or_default(F.col("_model"), S.UNKNOWN),
        }
    ).drop("_brand", "_model")


def add_share_chain(log: DataFrame) -> DataFrame:
    """Last user of the comma chain is the sharer; its length is the sharing degree."""
    chain = F.split("share_src", ",")
    return log.withColumns(
        {
            "src": F.when(text.present(F.col("share_src")), F.element_at(chain, -1)),
            "layer": F.when(text.present(F.col("share_src")), F.size(chain).cast("string")),
        }
    )


def latest_profiles(log: DataFrame, *more: str) -> DataFrame:
    """Time, city and gender of the latest record per (ak, uu) and further keys."""
    gender = F.when(F.col("gender") == "1", S.MALE).when(F.col("gender") == "2", S.FEMALE).otherwise(S.UNKNOWN)
    rows = log.filter(text.present(F.col("uu")) & text.present(F.col("ak"))).select(
        "ak", "uu", *more, "et", text.or_default(F.col("city"), S.UNKNOWN).alias("city"), gender.alias("gender")
    )
    return merge_profiles(rows)


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """The latest of several profiles of one key."""
    values = ["et", "city", "gender"]
    keys = [c for c in profiles.columns if c not in values]
    return profiles.groupBy(*keys).agg(F.max(F.struct(*values)).alias("latest")).select(*keys, *[f"latest.{v}" for v in values])


def sharer_profiles(log: DataFrame) -> DataFrame:
    """Latest city and gender per (ak, uu)."""
    return latest_profiles(log).drop("et")


def new_session_marks(log: DataFrame) -> DataFrame:
    """(day, att) of sessions in which an old SDK reported a first open."""
    return (
        log.filter((F.col("ifo") == "true") & versions.is_old_sdk(F.col("v")))
        .filter(text.present(F.col("ak")) & text.present(F.col("uu")) & text.present(F.col("att")) & F.col("day").isNotNull())
        .select("day", "att")
        .distinct()
    )


def propagate_new_user(log: DataFrame, old_sdk_only: bool = True) -> DataFrame:
    """Mark every record of a session as new when one of its records is.

    The reports do not need this per record: they attach the marks after sessions are
    reduced. Spark splits a session that holds much of the log.
    """
    marks = (
        new_session_marks(log)
        if old_sdk_only
        else log.filter((F.col("ifo") == "true") & F.col("day").isNotNull()).select("day", "att").distinct()
    )
    joined = log.join(marks.withColumn("_new", F.lit(True)), ["day", "att"], "left")
    return joined.withColumn("ifo", F.when(F.col("_new"), "true").otherwise(F.col("ifo"))).drop("_new")


def propagate_openid(log: DataFrame) -> DataFrame:
    """Give records without an open id the (smallest) open id of their session."""
    known = log.filter((F.col("op") != S.NO_OPENID) & text.present(F.col("op")))
    side = known.groupBy("day", "att").agg(F.min("op").alias("_op"))
    joined = log.join(side, ["day", "att"], "left")
    has_own = text.present(F.col("op")) & (F.col("op") != S.NO_OPENID)
    return joined.withColumn(
        "op", F.when(has_own, F.col("op")).otherwise(F.coalesce("_op", F.lit(S.NO_OPENID)))
    ).drop("_op")


def route(results: DataFrame, release: DataFrame, all_online: bool = False) -> DataFrame:
    """``prod`` or ``grey`` per row: everything is prod once online, else apps with status 1."""
    if all_online:
        return results.withColumn("route", F.lit("prod"))
    side = lookup_first_wins([release.select("ak", "online_status")], ["ak"]).select("ak", F.col("online_status").cast("string").alias("_status"))
    joined = results.join(side, "ak", "left")
    return joined.withColumn("route", F.when(F.col("_status") == "1", "prod").otherwise("grey")).drop("_status")


def align_day(log: DataFrame, job_day: Column, policy: str = "restamp") -> DataFrame:
    """Records whose event day is not the job's day: ``restamp`` to its midnight, ``drop`` or ``keep``."""
    foreign = times.day_of(F.col("et")) != job_day
    if policy == "keep":
        return log
    if policy == "drop":
        return log.filter(~foreign)
    if policy != "restamp":
        raise ValueError(f"unknown policy {policy!r}")
    stamped = log.withColumn("et", F.when(foreign, times.day_start(job_day)).otherwise(F.col("et")))
    return stamped.withColumns({"day": times.day_of(F.col("et")), "hour": times.hour_of(F.col("et"))})
