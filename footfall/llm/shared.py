"""What several operators of this package share: tables, staged tables, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import shared_dir

#: Six ASCII white-space characters separate words.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage: a lost executor costs its tasks, not what came before. Each call has
    a folder of its own, so reruns never meet.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str | Column = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def held_out(modulus: int, column: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves remainder 2; an unknown id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus == 2


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among ``keys`` (one column), with all their columns.

    The keys are written first, so Spark knows their size when it chooses the join.
    """
    name = unused(docs, "_gone")
    gone = staged(keys.select(F.col(keys.columns[0]).alias(name)).distinct(), "gone")
    return docs.join(gone, F.col(key).eqNullSafe(F.col(name)), "left_anti")
