"""Log streams: raw lines or log rows from any streaming source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.normalize import normalize_log


def normalized_stream(lines: DataFrame) -> DataFrame:
    """Normalised log from a stream with ``value`` and, where the source has one, an arrival time."""
    ingest = "ingest_ms" if "ingest_ms" in lines.columns else None
    keep = ("event_id",) if "event_id" in lines.columns else ()
    return normalize_log(lines, ingest_ms=ingest, keep=keep)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """A folder of Parquet files; each is a task of its batch at least."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def line_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw JSON lines from text files, with the file's time as arrival, for ``normalized_stream``."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.select("value", F.unix_millis("_metadata.file_modification_time").alias("ingest_ms"))


def run_available(writer, checkpoint: str) -> StreamingQuery:
    """Process all that is there, in batches, and stop. A backfill is this with its own checkpoint and run name."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def start_every(writer, checkpoint: str, interval: str) -> StreamingQuery:
    """The running job: a batch per interval."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()
