"""Tables that a stream writes batch by batch.

Two kinds. *Increments* (``write_batch``): a batch replaces its own ``run`` and ``batch_id`` partitions
when it runs again. *Segments* (``SegmentTables``): what counts is named by a commit log, and is
compacted as it grows; partials of a day and first-seen state are kept like this.

A run is one checkpoint: batch ids start at 0 with each checkpoint, so a backfill with a
checkpoint of its own names its own run and leaves the live batches alone.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import times
from footfall.streaming.commits import CommitLog, Conflict, Snapshot

RUN, BATCH, BUCKET, SEGMENT = "run", "batch_id", "bucket", "seg"
LIVE = "live"
#: So many segments of one level become one of the next, so n batches leave about FANOUT * log(n) to read.
FANOUT = 8
#: Keys of a bucket of state, about. A compacted segment has as many buckets as its rows ask for.
BUCKET_ROWS = 20_000
MAX_BITS = 20


# -- increments -----------------------------------------------------------------------------


def write_batch(rows: DataFrame, path: str, batch_id: int, *partition: str, run: str = LIVE) -> None:
    (
        rows.withColumns({RUN: F.lit(run), BATCH: F.lit(batch_id).cast("long")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition, RUN, BATCH)
        .parquet(path)
    )


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])


def read_batches(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None, run: str = LIVE,
                 only: Column | None = None) -> DataFrame:
    """All rows, or without those of the run from batch ``before`` on. The schema is the written rows' own.

    ``only`` is a condition on partition columns with literal values, so that other folders are not read.
    """
    rows = spark.read.schema(_with_batch(schema)).parquet(path)
    if only is not None:
        rows = rows.filter(only)
    if before is not None:
        rows = rows.filter((F.col(RUN) != run) | (F.col(BATCH) < before))
    return rows.drop(RUN, BATCH)


def values_of(rows: DataFrame, column: str) -> list:
    """The few different values of a partition column in a batch: its days, its buckets."""
    return sorted(r[0] for r in rows.select(column).distinct().collect() if r[0] is not None)


# -- segments -------------------------------------------------------------------------------


def bucket_of(keys: tuple[str, ...], bits: int) -> Column:
    """The first bits of the keys' hash: with one bit more each bucket falls into two."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits).cast("int") if bits else F.lit(0)


class SegmentTables:
    """Tables of one stream under a folder, as one run sees them.

    Tables by day (partials, marks) are read by folder: only the segments and days that are asked
    for are listed. Tables by key (state) are read by the buckets of a batch's keys.
    """

    def __init__(self, spark: SparkSession, base: str, run: str = LIVE, replaces: list[str] | None = None):
        self.spark, self.base, self.run, self.replaces = spark, base.rstrip("/"), run, replaces or []
        self.log = CommitLog(spark, self.base)

    def snapshot(self) -> Snapshot:
        found = self.log.load().changed()
        found.declare(self.run, self.replaces)
        return found

    def schema_of(self, snapshot: Snapshot, table: str) -> T.StructType | None:
        """The schema that batches wrote, None before the first."""
        known = snapshot.content["schemas"].get(table)
        return T.StructType.fromJson(known) if known else None

    # A day's rows

    def write_days(self, rows: DataFrame, table: str, name: str) -> list[str]:
        """Write a segment by day; the days it has. It counts once a version lists it."""
        path = f"{table}/{SEGMENT}={name}"
        rows.write.mode("overwrite").partitionBy("day").parquet(f"{self.base}/{path}")
        return [x.partition("=")[2] for x in self.log.tables.names(path) if x.startswith("day=")]

    def read_days(self, snapshot: Snapshot, table: str, schema: T.StructType, days: list[str], names: set[str] | None = None) -> DataFrame:
        """The rows that count for these days, of all segments or of the named ones."""
        paths = [
            f"{self.base}/{table}/{SEGMENT}={s['name']}/day={day}"
            for s in snapshot.segments(table, self.run) if names is None or s["name"] in names
            for day in days if day in s["days"]
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*[x for x in schema.fields if x.name != "day"], T.StructField(SEGMENT, T.StringType()), T.StructField("day", T.StringType())])
        return self.spark.read.schema(whole).option("basePath", f"{self.base}/{table}").parquet(*paths).select(*schema.fieldNames())

    # Keyed rows

    def write_keys(self, rows: DataFrame, table: str, name: str, keys: tuple[str, ...], bits: int = 0) -> int:
        path = f"{self.base}/{table}/{SEGMENT}={name}"
        bucketed = rows.withColumn(BUCKET, bucket_of(keys, bits))
        if bits:
            bucketed = bucketed.repartition(BUCKET)
        bucketed.write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path).count()

    def read_keys(self, snapshot: Snapshot, table: str, schema: T.StructType, keys: tuple[str, ...], batch: DataFrame | None = None,
                  names: set[str] | None = None, ts: str = "first_ts") -> DataFrame:
        """The rows that count, in the buckets that the keys of ``batch`` fall into (or all)."""
        found = [s for s in snapshot.segments(table, self.run) if names is None or s["name"] in names]
        most = max([s["bits"] for s in found], default=0)
        touched = values_of(batch.select(bucket_of(keys, most).alias(BUCKET)), BUCKET) if batch is not None and most else None
        parts = []
        for segment in found:
            whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
            rows = self.spark.read.schema(whole).parquet(f"{self.base}/{table}/{SEGMENT}={segment['name']}")
            if touched is not None and segment["bits"]:
                own = sorted({b >> (most - segment["bits"]) for b in touched})
                if len(own) < 1 << segment["bits"]:
                    rows = rows.filter(F.col(BUCKET).isin(*own))
            gone = snapshot.retracted_days(segment, self.run)
            if gone:
                rows = rows.filter(~times.day_of(F.col(ts)).isin(*gone))
            parts.append(rows.select(*schema.fieldNames()))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    # Batches

    def enter(self, batch_id: int, write: Callable[[Snapshot, str], list[tuple]]) -> None:
        """Enter a batch once. ``write(snapshot, name)`` writes segments called ``name`` and tells for each
        its table, days (None of a keyed one), rows and schema. If another run commits meanwhile, it is done again.
        """
        while True:
            before = self.snapshot()
            if before.counted(self.run, batch_id):
                return
            name = before.name_segment(self.run)
            written = write(before, name)
            after = before.changed()
            after.content["next"] += 1
            for table, days, rows, schema in written:
                after.content["schemas"][table] = json.loads(schema.json())
                if days is None or days:
                    after.add_segment(table, name, self.run, 0, days, rows=rows)
            after.content["runs"][self.run]["batch"] = batch_id
            if not before.pending(self.run):
                after.content["stale"] = sorted({*after.content["stale"], *[d for _, days, *_ in written for d in days or []]})
            try:
                self.log.commit(after)
                return
            except Conflict:
                continue

    def swap(self) -> None:
        """Make the run's rows count instead of all others' for the days it replaces, in one version.

        First-seen times that others entered for those days go as well. Repeating it changes nothing.
        """
        snapshot = self.snapshot()
        if not snapshot.pending(self.run):
            if not snapshot.replaces(self.run):
                raise ValueError(f"run {self.run!r} replaces no days")
            return
        days, content = snapshot.replaces(self.run), snapshot.content
        for table, segments in list(content["segments"].items()):
            snapshot.drop_days(table, {s["name"] for s in segments if s["run"] != self.run and s["days"] is not None}, days)
        content["retracted"].append({"run": self.run, "days": days, "at": content["next"]})
        content["runs"][self.run]["pending"] = False
        content["stale"] = sorted({*content["stale"], *days})
        self.log.commit(snapshot)

    def settle(self, remake: Callable[[Snapshot, list[str]], None]) -> None:
        """Remake the totals of days whose rows changed. A failure in between is made up for by the next call."""
        snapshot = self.snapshot()
        if snapshot.pending(self.run):
            return
        days = snapshot.content["stale"]
        if days:
            remake(snapshot, days)
        if days or snapshot.content["garbage"]:
            done = self.log.sweep(snapshot)
            done.content["stale"] = []
            self._try(done)

    def _try(self, changed: Snapshot) -> bool:
        """Commit upkeep; if another run was first, it is left to the next batch."""
        try:
            self.log.commit(changed)
        except Conflict:
            return False
        return True

    # Compaction

    def compact_days(self, table: str, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Merge a day's segments of one level once there are ``FANOUT`` of them; a pending run's stay apart."""
        while True:
            snapshot = self.snapshot()
            schema = self.schema_of(snapshot, table)
            groups: dict[tuple, list[dict]] = {}
            for segment in snapshot.segments(table, self.run):
                standing = segment["run"] if snapshot.pending(segment["run"]) else ""
                if standing in ("", self.run) and not (snapshot.pending(self.run) and not standing):
                    for day in segment["days"]:
                        groups.setdefault((day, segment["level"], standing), []).append(segment)
            due = min((k for k, v in groups.items() if len(v) >= FANOUT), default=None)
            if due is None:
                return
            (day, level, standing), old = due, {s["name"] for s in groups[due]}
            name = snapshot.name_segment(f"{standing or 'all'}-level{level + 1}")
            merged = merge(self.read_days(snapshot, table, schema, [day], old)).select(*schema.fieldNames())
            days = self.write_days(merged.sortWithinPartitions(*[c for c in schema.fieldNames() if c != "day"]), table, name)
            snapshot.content["next"] += 1
            snapshot.drop_days(table, old, [day])
            if days:
                snapshot.add_segment(table, name, standing or LIVE, level + 1, days)
            if not self._try(snapshot):
                return

    def compact_keys(self, table: str, schema: T.StructType, keys: tuple[str, ...], merge: Callable[[DataFrame], DataFrame]) -> None:
        """The same for keyed rows; the merged segment is cut into buckets of about ``BUCKET_ROWS``."""
        while True:
            snapshot = self.snapshot()
            if snapshot.pending(self.run):
                return  # until the swap its rows stand beside those they may retract
            groups: dict[int, list[dict]] = {}
            for segment in snapshot.segments(table, self.run):
                groups.setdefault(segment["level"], []).append(segment)
            level = min((k for k, v in groups.items() if len(v) >= FANOUT), default=None)
            if level is None:
                return
            old = {s["name"] for s in groups[level]}
            name = snapshot.name_segment(f"all-level{level + 1}")
            bits = min(MAX_BITS, max(0, math.ceil(math.log2(max(1, sum(s["rows"] for s in groups[level])) / BUCKET_ROWS))))
            merged = merge(self.read_keys(snapshot, table, schema, keys, names=old)).select(*schema.fieldNames())
            rows = self.write_keys(merged, table, name, keys, bits)
            snapshot.content["next"] += 1
            snapshot.drop_days(table, old, None)
            snapshot.add_segment(table, name, LIVE, level + 1, None, bits, rows)
            if not self._try(snapshot):
                return
