"""Streaming distinct counts, windows and first-seen users.

None of them drops a late record, however unordered the input is: what a batch counts is stored as
partials by day, and the totals of the days it touched are made from all of them. There is no
watermark; a day's partials shrink to its distinct identities, or windows, when they are compacted.
With ``job_day`` records of another day move to the day on which they arrived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from footfall.operators import first_seen
from footfall.schema import FIRST_SEEN_SCHEMA
from footfall.streaming.commits import Snapshot
from footfall.streaming.reports import ReportTables, Streamed, each_batch, stream
from footfall.streaming.tables import LIVE, read_batches

UNIQUES, WINDOWS, NEW = "unique_visitors", "windowed_views", "new_users"
DAY_SECONDS = 86_400


def unique_report(dims: list[str], identity: str = "uu") -> Streamed:
    """``uv``, the identities per day and dims. A partial is an identity once; records without one do not count."""
    keys = list(dict.fromkeys(["day", *dims]))
    return Streamed(
        UNIQUES,
        lambda log, _: log.filter(F.col(identity).isNotNull()).select(*keys, identity).distinct(),
        lambda rows: rows.distinct(),
        lambda rows, _: rows.groupBy(*keys).agg(F.count("*").alias("uv")),
    )


def window_report(dims: list[str], seconds: int = 3_600) -> Streamed:
    """``pv``, page views per tumbling window of event time, which begins at ``start_ms``. Windows divide the day."""
    if seconds <= 0 or DAY_SECONDS % seconds:
        raise ValueError("a day is not a whole number of such windows")
    keys = list(dict.fromkeys(["day", "start_ms", *dims]))
    window = F.window(F.timestamp_millis("et"), f"{seconds} seconds")

    def count(log: DataFrame, _: DataFrame | None) -> DataFrame:
        timed = log.withColumn("start_ms", F.unix_millis(window["start"]))
        return timed.groupBy(*keys).agg(F.count("*").alias("pv"))

    merge = lambda rows: rows.groupBy(*keys).agg(F.sum("pv").alias("pv"))
    return Streamed(WINDOWS, count, merge, lambda rows, _: rows)


def unique_stream(log: DataFrame, dims: list[str], root: str, job_day: Column | None = None, identity: str = "uu",
                  run: str = LIVE, replaces: list[str] | None = None) -> DataStreamWriter:
    """Keep the identities per day and dims."""
    return stream(log, unique_report(dims, identity), root, job_day, run, replaces)


def window_stream(log: DataFrame, dims: list[str], root: str, job_day: Column | None = None, seconds: int = 3_600,
                  run: str = LIVE, replaces: list[str] | None = None) -> DataStreamWriter:
    """Keep the page views per window and dims."""
    return stream(log, window_report(dims, seconds), root, job_day, run, replaces)


def running_totals(spark: SparkSession, path: str, schema, keys: list[str], sums: list[str]) -> DataFrame:
    """Increments of all batches folded."""
    return read_batches(spark, path, schema).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def mark_new_users(log: DataFrame, root: str, kind: str = first_seen.NEW_USER, run: str = LIVE) -> DataStreamWriter:
    """Write the record with which each user is seen first, against a state table in buckets.

    The state of a batch is what was entered before it, and a batch is entered once, so a replay
    decides the same. Only the buckets of the batch's users are read.
    """
    tables = ReportTables(root, NEW, run)

    def take(batch: DataFrame, batch_id: int) -> None:
        store = tables.open(batch.sparkSession)

        def write(snapshot: Snapshot, name: str) -> list[tuple]:
            state = store.read_keys(snapshot, "state", FIRST_SEEN_SCHEMA, first_seen.KEYS, batch)
            new = first_seen.first_seen_strict(batch, state, kind)
            days = store.write_days(new, "records", name)
            after = snapshot.changed()
            after.add_segment("records", name, run, 0, days)
            written = store.read_days(after, "records", new.schema, days, {name})
            rows = first_seen.update_state(None, written, kind).select(*FIRST_SEEN_SCHEMA.fieldNames())
            count = store.write_keys(rows, "state", name, first_seen.KEYS)
            return [("records", days, 0, new.schema), ("state", None, count, rows.schema)]

        store.enter(batch_id, write)
        store.settle(lambda *_: None)
        store.compact_days("records", lambda rows: rows)
        store.compact_keys("state", FIRST_SEEN_SCHEMA, first_seen.KEYS, first_seen.merge_state)

    return each_batch(log, None, tables, take)


def new_users(spark: SparkSession, root: str) -> DataFrame:
    """The records that ``mark_new_users`` has written."""
    store = ReportTables(root, NEW).open(spark)
    snapshot = store.snapshot()
    days = sorted({d for s in snapshot.segments("records", LIVE) for d in s["days"]})
    return store.read_days(snapshot, "records", store.schema_of(snapshot, "records"), days)
