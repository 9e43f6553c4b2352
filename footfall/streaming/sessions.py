"""Stateful sessions that emit changes: opens, bounces taken back, longer stays, moved entry pages.

Use these where every change has to be passed on as it happens. The reports themselves
use ``streaming.reports``, which needs no per-session state.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from footfall.functions.text import safe_ratio
from footfall.operators import enrich
from footfall.streaming.tables import LIVE, write_batch

STATE_HOURS = 50  # a day of events, and until 02:00 after the day in which they may arrive

#: Values that the sessions of a day are kept in, by the hash of their keys.
BUCKETS = 64

SUMS = ["new_comer_count", "open_count", "one_page_count", "total_stay_time", "pv"]
ENTRY_SUMS = ["entry_page_count", "one_page_count", "page_count", "total_time"]


_PAGES = ["first_page", "low_page", "high_page"]
_LONGS = ["pv", "first_ms", "stay", "is_new"]


def _fold(rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
    """The rows of a group as one, indexed by the group.

    A session counts as one of one page or of several, so of its pages the least and the greatest are kept
    beside the first, and its row does not grow. Pages are compared as numbers, as pandas has no fast least text.
    """
    codes, pages = pd.factorize(np.concatenate([rows[c].to_numpy(dtype=object) for c in _PAGES]), sort=True)
    numbers = pd.DataFrame(dict(zip(_PAGES, np.split(codes, len(_PAGES)))), index=rows.index)
    work = pd.concat([rows[_LONGS], numbers], axis=1).assign(_group=group)
    folded = work.sort_values(["first_ms", "first_page"]).groupby("_group", sort=True).agg(
        pv=("pv", "sum"), first_ms=("first_ms", "min"), stay=("stay", "max"), is_new=("is_new", "max"),
        first_page=("first_page", "first"), low_page=("low_page", "min"), high_page=("high_page", "max"),
    )
    return folded.assign(**{c: pages[folded[c].to_numpy()] for c in _PAGES})


def _groups(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """A number per row, the same for the same keys; the first row of each number comes in its order."""
    return rows.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()


def _keyed(rows: pd.DataFrame, keys: list[str], group: np.ndarray) -> pd.DataFrame:
    """The keys of each group, indexed by the group."""
    first = ~pd.Series(group).duplicated().to_numpy()
    return rows.loc[first, keys].set_axis(group[first]).sort_index()


def combine(log: DataFrame, dims: list[str]) -> DataFrame:
    """Fold the records of a session inside every Arrow batch, before the shuffle.

    State tasks get one row per session and input batch, however many records and pages a session has.
    """
    keys = [*dims, "att"]
    slim = log.select(
        *keys, F.coalesce("pp", F.lit("")).alias("first_page"), F.col("et").alias("first_ms"), F.col("dr").alias("stay"),
        F.coalesce((F.col("ifo") == "true").cast("int"), F.lit(0)).alias("is_new"),
    )
    schema = T.StructType(
        [*[slim.schema[k] for k in keys]]
        + [T.StructField(n, T.LongType()) for n in _LONGS]
        + [T.StructField(n, T.StringType()) for n in _PAGES]
    )

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            rows = batch.assign(pv=1, low_page=batch["first_page"], high_page=batch["first_page"])
            rows = rows.astype({c: "Int64" for c in _LONGS})
            group = _groups(rows, keys)
            yield pd.concat([_keyed(rows, keys, group), _fold(rows, group)], axis=1)[schema.fieldNames()]

    return slim.mapInPandas(fold, schema)


class _Sessions(StatefulProcessor):
    """Keeps the sessions of a bucket in one value, read and written once per batch.

    A call of its own per session, with its trips to the state store, took milliseconds each; here a call
    takes in all of a bucket's sessions at once. A session leaves ``hours`` after its last record.
    """

    def __init__(self, keys: list[str], hours: int):
        self.keys, self.ttl_ms = keys, hours * 3600 * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("sessions", "rows binary", ttlDurationMs=self.ttl_ms)

    def absorb(self, rows: Iterator[pd.DataFrame], now: int) -> tuple[pd.DataFrame, pd.DataFrame, pd.Series]:
        """Take the rows in. Of the sessions that they touch: as they are now, as they were (only some of them were), and
        which ones were there. Rows of both have the same index."""
        fresh = pd.concat([r for r in rows], ignore_index=True).astype({c: "Int64" for c in _LONGS})
        columns = [*self.keys, *_LONGS, *_PAGES]
        stored = pd.DataFrame(columns=[*columns, "seen_ms"])
        if self.kept.exists():
            stored = pa.ipc.open_stream(self.kept.get()[0]).read_pandas().astype({c: "Int64" for c in _LONGS})
            stored = stored[stored["seen_ms"] > now - self.ttl_ms].reset_index(drop=True)
        both = pd.concat([stored[columns], fresh[columns]], ignore_index=True) if len(stored) else fresh[columns]
        group = _groups(both, self.keys)
        old, touched = group[: len(stored)], np.unique(group[len(stored):])
        after = pd.concat([_keyed(both, self.keys, group), _fold(both, group)], axis=1)
        seen = pd.Series(now, index=after.index, dtype="int64")
        seen.loc[old] = stored["seen_ms"].to_numpy(dtype="int64")
        seen.loc[touched] = now
        self._keep(after.assign(seen_ms=seen))
        before = stored.set_axis(old).reindex(touched)
        return after.loc[touched], before, pd.Series(np.isin(touched, old), index=touched)

    def _keep(self, sessions: pd.DataFrame) -> None:
        table = pa.Table.from_pandas(sessions, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.kept.update((sink.getvalue().to_pybytes(),))

    def close(self) -> None:
        pass


def _one_page(sessions: pd.DataFrame) -> pd.Series:
    return (sessions["low_page"] == sessions["high_page"]).astype("int64")


class SessionChanges(_Sessions):
    """Changes of a session's part in its totals; a second page takes the bounce back."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        after, before, was = self.absorb(rows, timerValues.getCurrentProcessingTimeInMs())
        part = lambda s, there: pd.DataFrame(
            {"new_comer_count": s["is_new"], "open_count": 1, "one_page_count": _one_page(s), "total_stay_time": s["stay"], "pv": s["pv"]},
            index=s.index,
        ).astype("Int64").fillna(0).mul(there.astype("Int64"), axis=0)
        change = part(after, pd.Series(1, index=after.index)) - part(before, was)
        yield pd.concat([after[self.keys], change], axis=1)[[*self.keys, *SUMS]]


class EntryChanges(_Sessions):
    """Changes by entry page. When an earlier page arrives late the session moves to it."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        after, before, was = self.absorb(rows, timerValues.getCurrentProcessingTimeInMs())
        part = lambda s, sign: pd.concat(
            [
                after.loc[s.index, self.keys], s["first_page"].rename("page_path"),
                pd.DataFrame(
                    {"entry_page_count": 1, "one_page_count": _one_page(s), "page_count": s["pv"], "total_time": s["stay"]}, index=s.index
                ).astype("Int64").fillna(0) * sign,
            ],
            axis=1,
        )
        if was.any():
            yield part(before[was], -1)
        yield part(after, 1)


_SETTINGS = {
    # Custom state lives in RocksDB.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # State with a time to live asks for one more batch for ever; a run over what is
    # available would not end.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def state_settings(spark: SparkSession):
    """Settings the stateful streams need when they start; the session's own come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _changes(log: DataFrame, dims: list[str], processor: StatefulProcessor, extra: list[str], sums: list[str]) -> DataFrame:
    keys = [*dims, "att"]
    out = T.StructType(
        [log.schema[k] for k in keys] + [T.StructField(c, T.StringType()) for c in extra] + [T.StructField(c, T.LongType()) for c in sums]
    )
    # A day's sessions stand apart, so that a batch reads and writes those of its own days only.
    day = F.col("day") if "day" in dims else F.lit("")
    bucketed = combine(log, dims).withColumns({"_day": day, "_bucket": F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))})
    changed = bucketed.groupBy("_day", "_bucket").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="ProcessingTime",
    )
    return changed.drop("att")


def session_changes(log: DataFrame, dims: list[str], job_day: Column, hours: int = STATE_HOURS) -> DataFrame:
    """``job_day`` is the day a record arrived: records of another day belong to a session of that
    day, so no session is opened a second time after its state has gone (``hours`` after its last record).
    """
    return _changes(enrich.align_day(log, job_day), dims, SessionChanges([*dims, "att"], hours), [], SUMS)


def entry_changes(log: DataFrame, dims: list[str], job_day: Column, hours: int = STATE_HOURS) -> DataFrame:
    return _changes(enrich.align_day(log, job_day), dims, EntryChanges([*dims, "att"], hours), ["page_path"], ENTRY_SUMS)


def keep_changes(changes: DataFrame, keys: list[str], sums: list[str], path: str, run: str = LIVE) -> DataStreamWriter:
    """Fold each batch's changes per key and store them; totals are the sums over batches."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]), path, batch_id, run=run)

    return changes.writeStream.foreachBatch(each)


def with_session_ratios(totals: DataFrame) -> DataFrame:
    return totals.withColumns(
        {
            "secondary_avg_stay_time": safe_ratio(F.col("total_stay_time"), F.col("open_count")),
            "bounce_rate": safe_ratio(F.col("one_page_count"), F.col("open_count")),
        }
    )
