"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILES_PER_HOUR = 5


def write_log(log: DataFrame, path: str, files_per_hour: int | None = None, mode: str = "append") -> None:
    """Parquet by day and hour.

    By default hours are brought together and large ones split to an even size, whatever
    an hour holds. A fixed number of files per hour (``FILES_PER_HOUR``) is for small logs.
    """
    if files_per_hour is None:
        rows = log.hint("rebalance", "day", "hour")
    else:
        rows = log.repartition("day", "hour", F.pmod(F.xxhash64("att", "et"), F.lit(files_per_hour)))
    rows.write.mode(mode).partitionBy("day", "hour").parquet(path)


def replace_days(rows: DataFrame, path: str, *partition: str) -> None:
    """Replace the partitions that occur in the rows, leave the others."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(partition or ("day",)))
        .parquet(path)
    )


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def save_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)
