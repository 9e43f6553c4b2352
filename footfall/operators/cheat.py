"""Addresses from which unusually many users authorise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import text, versions
from footfall.operators import filters, first_seen
from footfall.schema import CHEAT_THRESHOLD


def suspicious_ips(log: DataFrame, threshold: int = CHEAT_THRESHOLD, auth_state: DataFrame | None = None,
                   minimum_version: str = "7.3.0") -> DataFrame:
    """(ak, day, client_ip) with more than ``threshold`` newly authorised users that day, beside the address's users.

    Users fold to one row per address first, so both counts come from one pass without a join.
    """
    visits = log.filter(
        text.present(F.col("ak"))
        & filters.has_openid()
        & text.present(F.col("link_key"))
        & versions.at_least(F.col("v"), minimum_version)
    )
    visits = first_seen.slim(visits, ("ak", "op", "client_ip", "day", "et", "event_id", "img"))
    firsts = first_seen.first_seen(first_seen.auth_records(visits), auth_state, first_seen.AUTH)
    rows = visits.select("ak", "day", "client_ip", "op", F.lit(0).alias("authorised")).unionByName(
        firsts.select("ak", "day", "client_ip", "op", F.lit(1).alias("authorised"))
    )
    users = rows.groupBy("ak", "day", "client_ip", "op").agg(F.max("authorised").alias("authorised"))
    return (
        users.groupBy("ak", "day", "client_ip")
        .agg(F.sum("authorised").alias("auth_count"), F.count("*").alias("uv"))
        .filter(F.col("auth_count") > threshold)
    )
