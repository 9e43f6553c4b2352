"""Reading logs: parquet by day and hour, JSON text, user lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import text, versions
from footfall.schema import OPENID_LENGTH, RAW_SCHEMA

VERSIONED_COLUMNS = "ak op img ifo client_ip scene link_key pp v day hour".split()


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None, merge_schema: bool = False) -> DataFrame:
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def of_hours(log: DataFrame, day: str, from_hour: str = "00", to_hour: str = "23") -> DataFrame:
    """One day, or some hours of it. Both are partition columns, so other files are not opened."""
    return log.filter((F.col("day") == day) & F.col("hour").between(from_hour, to_hour))


def of_days(log: DataFrame, last_day: str, days: int) -> DataFrame:
    """The last ``days`` days up to and including ``last_day`` (yyyyMMdd)."""
    first = F.date_format(F.date_sub(F.to_date(F.lit(last_day), "yyyyMMdd"), days - 1), "yyyyMMdd")
    return log.filter(F.col("day").between(first, F.lit(last_day)))


def of_apps(log: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    if include:
        log = log.filter(F.col("ak").isin(*include))
    if exclude:
        log = log.filter(~F.col("ak").isin(*exclude))
    return log


def link_visits(log: DataFrame) -> DataFrame:
    return log.filter(text.present(F.col("link_key")))


def recent_sdk(log: DataFrame, minimum: str = "7.3.0") -> DataFrame:
    """Rows of new SDKs, and only the columns the advertising jobs read."""
    return log.filter(versions.at_least(F.col("v"), minimum)).select(*VERSIONED_COLUMNS)


def read_json_log(spark: SparkSession, glob: str) -> DataFrame:
    """JSON text logs with a fixed schema, so files are read once."""
    return spark.read.schema(RAW_SCHEMA).json(glob)


def read_lines(spark: SparkSession, glob: str) -> DataFrame:
    """Raw lines with the file's time in ms, for ``normalize_log``."""
    return spark.read.text(glob).select("value", F.unix_millis("_metadata.file_modification_time").alias("ingest_ms"))


def read_known_users(spark: SparkSession, glob: str) -> DataFrame:
    """(ak, op) from files of one open id per line; the app key is the file's name."""
    app = F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return spark.read.text(glob).select(app.alias("ak"), F.trim("value").alias("op")).filter(F.length("op") == OPENID_LENGTH)


def with_row_id(log: DataFrame) -> DataFrame:
    """A row id that a rerun gives again: file and position in the file."""
    return log.withColumn("event_id", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index"))
