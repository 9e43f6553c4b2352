"""First-seen state: who is new to an app, and who authorised for the first time.

State is a table (ak, op, kind, first_ts). Events reduce to one row per key on the map
side before the state is joined, so neither side of that join holds a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import times
from footfall.operators import filters

KEYS = ("ak", "op")
NEW_USER, AUTH, ACTIVITY = "new_user", "auth", "adxlink"


def slim(events: DataFrame, columns) -> DataFrame:
    """The named columns that are there. First records are kept whole, so prune before finding them."""
    return events.select(*dict.fromkeys(c for c in columns if c in events.columns))


def first_records(events: DataFrame, keys=KEYS, order=("et", "event_id")) -> DataFrame:
    """The earliest record of every key, whole. Equal order values fall back to the other columns."""
    order = [c for c in order if c in events.columns]
    others = sorted(c for c in events.columns if c not in keys and c not in order)
    first = F.min(F.struct(*order, *others)).alias("_first")
    return events.groupBy(*keys).agg(first).select(*keys, "_first.*")


def state_of(state: DataFrame, kind: str, name: str = "_known") -> DataFrame:
    """One row per key of one kind of state, with its first time."""
    return state.filter(F.col("kind") == kind).groupBy(*KEYS).agg(F.min("first_ts").alias(name))


def first_seen(events: DataFrame, state: DataFrame | None = None, kind: str = NEW_USER,
               order=("et", "event_id"), strict: bool = False) -> DataFrame:
    """The first record of each key that is new.

    New: the key is not in the state, or the state got it on that same day, so that a
    second run over the day gives the first run's answer. ``strict`` is the rule of
    streams, where the state holds what earlier batches of the day saw: not in the state.
    """
    if strict and state is not None:
        return first_seen_strict(events, state, kind, order)
    firsts = first_records(events, KEYS, order)
    if state is None:
        return firsts
    joined = firsts.join(state_of(state, kind), list(KEYS), "left")
    fresh = F.col("_known").isNull() | (F.col("_known") >= times.day_start(F.col("day")))
    return joined.filter(fresh).drop("_known")


def first_seen_strict(events: DataFrame, state: DataFrame, kind: str = NEW_USER,
                      order=("et", "event_id")) -> DataFrame:
    """The streaming rule: new only when the state does not hold the key."""
    firsts = first_records(events, KEYS, order)
    return firsts.join(state_of(state, kind), list(KEYS), "left_anti")


def lookup_or_insert(events: DataFrame, state: DataFrame, kind: str = NEW_USER) -> DataFrame:
    """Per key the stored first time (null when absent) and the time the state will hold."""
    seen = events.groupBy(*KEYS).agg(F.min("et").alias("seen_ts"))
    joined = seen.join(state_of(state, kind, "stored_ts"), list(KEYS), "left")
    return joined.withColumn("first_ts", F.least("stored_ts", "seen_ts"))


def update_state(state: DataFrame | None, events: DataFrame, kind: str = NEW_USER, ts: str | Column = "et") -> DataFrame:
    """State after the events: the smallest time per key and kind."""
    moment = F.col(ts) if isinstance(ts, str) else ts
    seen = events.select(*KEYS, F.lit(kind).alias("kind"), moment.cast("long").alias("first_ts"))
    return merge_state(seen if state is None else state.select(*KEYS, "kind", "first_ts").unionByName(seen))


def merge_state(rows: DataFrame) -> DataFrame:
    """Several states as one."""
    return rows.groupBy(*KEYS, "kind").agg(F.min("first_ts").alias("first_ts"))


def load_known_users(known: DataFrame, state: DataFrame | None, fixed_ts: int, kind: str = NEW_USER) -> DataFrame:
    """Enter (ak, op) lists into the state with one fixed time."""
    return update_state(state, known, kind, F.lit(fixed_ts))


def mark_first(events: DataFrame, firsts: DataFrame, flag: str = "is_first",
               row_id=("et", "event_id")) -> DataFrame:
    """Every event with a flag on first records. Joins on the row id, which is unique."""
    on = [*KEYS, *row_id]
    side = firsts.select(*on).withColumn(flag, F.lit(True))
    return events.join(side, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


# -- rows that carry marks into a report -----------------------------------------
#
# A report needs a mark only in the groups its record belongs to. So the log is not
# joined with its marks; a copy of each marked record that counts no page view is
# appended. Its session, visitor and page are those of the original, so distinct
# counts and maxima stay the same.


def counted(log: DataFrame) -> DataFrame:
    return log.withColumns({"_counted": F.lit(1), "_auth_first": F.lit(0), "_auth_id": F.lit(None).cast("string")})


def append_marks(rows: DataFrame, marked: DataFrame, **values: Column) -> DataFrame:
    extra = counted(marked).withColumn("_counted", F.lit(0)).withColumns(values)
    return rows.unionByName(extra)


def with_new_users(log: DataFrame, firsts: DataFrame) -> DataFrame:
    """Log in which only the first record of a new user carries ``ifo = true``."""
    rows = counted(log.withColumn("ifo", F.lit("false")))
    return append_marks(rows, firsts, ifo=F.lit("true"))


def with_first_auth(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    return append_marks(rows, firsts, _auth_first=F.lit(1))


def auth_records(log: DataFrame) -> DataFrame:
    """Records in which a user with an open id authorised."""
    return log.filter(filters.has_openid() & filters.is_authorised())


def old_rule_auth(log: DataFrame) -> DataFrame:
    """Records that count as an authorisation when there is no open id."""
    return log.filter(~filters.has_openid() & filters.is_authorised() & (F.col("ifo") == "true"))
