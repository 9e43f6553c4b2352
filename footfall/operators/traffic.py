"""The report core: sessions, visitors and page views per dimension in one pass.

Every log row becomes one entry per counted identity (its session, its visitor, and
where it applies its old-rule authorisation). Entries reduce to one row per
identity, then to one row per dimension value. That is one scan and no join
of large results; the first shuffle follows a map-side combine, so the rows of a hot session,
user or dimension value have shrunk before they move. With several rollup levels the reduced
entries move once more, and are repeated per level (``levels``) where they arrive.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.text import safe_ratio
from footfall.operators import filters
from footfall.operators.levels import AUTH, COUNTS, MARK, SESSION, VISITOR, level_totals
from footfall.schema import ALL

BASE = ("ak", "day")
Levels = tuple[tuple[str, ...], ...]


def cube_levels(dims: tuple[str, ...]) -> Levels:
    return tuple(c for n in range(len(dims) + 1) for c in combinations(dims, n))


def level_name(level: tuple[str, ...]) -> str:
    return "+".join(level) or "app"


def dims_of(levels: Levels) -> list[str]:
    return list(dict.fromkeys(d for level in levels for d in level))


def _facts(log: DataFrame, dims: list[str], identity: str, page_level: bool) -> DataFrame:
    """The columns a report needs, typed.

    Page views are the records that show a page, or with ``page_level`` those of the
    page level; visitors are counted on shown pages, or on all records.
    """
    has = set(log.columns)
    counted = F.col("_counted") if "_counted" in has else F.lit(1)
    shown = F.col("ev") == "page" if page_level else filters.is_page_view()
    page_view = F.when(shown, counted).otherwise(F.lit(0))
    visitor = F.col(identity) if page_level else F.when(shown, F.col(identity))
    return log.select(
        *BASE,
        *dims,
        "att",
        "pp",
        visitor.alias("visitor"),
        (F.col("_auth_id") if "_auth_id" in has else F.lit(None).cast("string")).alias("auth_id"),
        page_view.alias("pv"),
        F.col("dr").alias("stay") if "dr" in has else F.lit(0).cast("long").alias("stay"),
        (F.col("ifo") == "true").cast("int").alias("is_new"),
        (F.col("_auth_first") if "_auth_first" in has else F.lit(0)).alias("auth_first"),
    )


def _entries(rows: DataFrame, dims: list[str], auth: bool) -> DataFrame:
    """A row per identity that a row counts for."""
    kinds = [SESSION, VISITOR, *([AUTH] if auth else [])]
    entries = rows.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds])))
    is_session = F.col("kind") == SESSION
    identity_of = F.when(is_session, F.col("att")).when(F.col("kind") == VISITOR, F.col("visitor"))
    return entries.select(
        *BASE,
        *dims,
        "kind",
        identity_of.otherwise(F.col("auth_id")).alias("id"),
        *[F.when(is_session, F.col(c)).alias(c) for c in ("pp", *MEASURES)],
    ).filter(F.col("id").isNotNull())


def traffic_partials(log: DataFrame, levels: Levels, identity: str = "uu", auth: bool = False,
                     page_level: bool = False) -> DataFrame:
    """What the totals are made of: one row per dimension value, identity and page; of several levels,
    one row per value of all dimensions, session, page and user, which the totals repeat per level.

    Partials of different parts of a log merge (sums add, maxima win), so a stream can
    store them per batch and a total over all of them is exact.
    """
    dims = dims_of(levels)
    rows = _facts(log, dims, identity, page_level)
    if len(levels) > 1:
        return _merge(rows, [*BASE, *dims, "att", "pp", "visitor", "auth_id"])
    return _merge(_entries(rows, dims, auth), [*BASE, *dims, "kind", "id", "pp"])


#: What rows carry beside their keys, and how it merges.
MEASURES = {"pv": "sum", "stay": "max", "is_new": "max", "auth_first": "sum"}


def _merge(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("pv").alias("pv"),
        F.max("stay").alias("stay"),
        F.max("is_new").alias("is_new"),
        F.sum("auth_first").alias("auth_first"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partials of several batches as those of one."""
    return _merge(partials, [c for c in partials.columns if c not in MEASURES])


def totals_of(partials: DataFrame, levels: Levels, marks: DataFrame | None = None, auth: bool = False) -> DataFrame:
    """Totals per dimension value from merged partials, for every level."""
    if len(levels) > 1:
        return _auth_count(_totals_of_levels(partials, levels, marks, auth), auth)
    group = [*BASE, *dims_of(levels)]
    is_session = F.col("kind") == SESSION
    ids = partials.groupBy(*group, "kind", "id").agg(
        F.count("pp").alias("pages"),
        F.sum("pv").alias("pv"),
        F.max("stay").alias("stay"),
        F.max("is_new").alias("is_new"),
        F.sum("auth_first").alias("auth_first"),
    )
    if marks is not None:
        # Sessions are reduced by now: a session has one row per dimension value it touched.
        side = marks.select("day", F.col("att").alias("id"), F.lit(SESSION).alias("kind"), F.lit(1).alias("_mark"))
        ids = ids.join(side, ["day", "kind", "id"], "left").withColumn("is_new", F.greatest("is_new", "_mark"))

    totals = ids.groupBy(*group).agg(
        F.coalesce(F.sum("is_new"), F.lit(0)).alias("new_comer_count"),
        F.count_if(F.col("kind") == VISITOR).alias("visitor_count"),
        F.count_if(is_session).alias("open_count"),
        F.coalesce(F.sum("pv"), F.lit(0)).alias("total_page_count"),
        F.coalesce(F.sum("stay"), F.lit(0)).alias("total_stay_time"),
        F.count_if(is_session & (F.col("pages") == 1)).alias("one_page_count"),
        F.count_if(F.col("kind") == AUTH).alias("old_auth"),
        F.coalesce(F.sum("auth_first"), F.lit(0)).alias("first_auth"),
    )
    return _auth_count(totals, auth)


def _auth_count(totals: DataFrame, auth: bool) -> DataFrame:
    if auth:
        both = F.when(F.col("first_auth") != 0, F.col("first_auth")).otherwise(F.col("old_auth"))
        totals = totals.withColumn("new_auth_count", both)
    return totals.drop("old_auth", "first_auth")


def _totals_of_levels(partials: DataFrame, levels: Levels, marks: DataFrame | None, auth: bool) -> DataFrame:
    """All rows of an identity, with its mark, go to one task once, and are counted there for every level."""
    dims = dims_of(levels)
    entries = _entries(partials, dims, auth)
    if marks is not None:
        side = marks.select("day", F.col("att").alias("id"), F.lit(MARK).alias("kind"))
        entries = entries.unionByName(side, allowMissingColumns=True)
    kinds = dict(partials.dtypes)
    group = ", ".join(f"{c} {kinds[c]}" for c in (*BASE, *dims))
    parts = entries.repartition("day", "id").sortWithinPartitions("day", "id").mapInArrow(
        level_totals(list(BASE), dims, levels, MEASURES), f"{group}, _level int, {', '.join(f'{c} long' for c in COUNTS)}"
    )
    totals = parts.groupBy(*BASE, "_level", *dims).agg(*[F.sum(c).alias(c) for c in COUNTS])
    return _named_levels(totals, levels)


def _named_levels(totals: DataFrame, levels: Levels) -> DataFrame:
    """Levels by name instead of number; dimensions outside a level read ``all``."""
    named = {"level": F.element_at(F.array(*[F.lit(level_name(level)) for level in levels]), F.col("_level") + 1)}
    for dim in dims_of(levels):
        inside = [n for n, level in enumerate(levels) if dim in level]
        named[dim] = F.when(F.col("_level").isin(*inside), F.col(dim)).otherwise(F.lit(ALL))
    return totals.withColumns(named).drop("_level")


def traffic_totals(log: DataFrame, levels: Levels, identity: str = "uu", marks: DataFrame | None = None,
                   auth: bool = False, page_level: bool = False) -> DataFrame:
    """Totals for every level, a tuple of dimensions under (ak, day).

    With several levels the result has a ``level`` column, and dimensions outside a
    level read ``all``. ``marks`` is a table (day, att) of sessions to count as new.
    """
    return totals_of(traffic_partials(log, levels, identity, auth, page_level), levels, marks, auth)


def at_levels(rows: DataFrame, levels: Levels, dims: list[str]) -> DataFrame:
    """Repeat rows once per level, dimensions outside the level set to ``all``."""
    repeated = rows.withColumn("level", F.explode(F.array(*[F.lit(level_name(lv)) for lv in levels])))
    masked = {}
    for dim in dims:
        inside = [level_name(lv) for lv in levels if dim in lv]
        masked[dim] = F.when(F.col("level").isin(*inside), F.col(dim)).otherwise(F.lit(ALL))
    return repeated.withColumns(masked)


RATIOS = {
    "avg_stay_time": ("total_stay_time", "total_page_count"),
    "secondary_avg_stay_time": ("total_stay_time", "open_count"),
    "bounce_rate": ("one_page_count", "open_count"),
    "share_reflux_ratio": ("share_open_count", "share_count"),
}


def add_ratios(totals: DataFrame, names) -> DataFrame:
    return totals.withColumns({n: safe_ratio(F.col(RATIOS[n][0]), F.col(RATIOS[n][1])) for n in names})
