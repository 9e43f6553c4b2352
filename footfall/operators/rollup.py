"""Several rollup levels of one result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.traffic import BASE, Levels, at_levels, cube_levels, level_name

# The levels of the offline link report, under (ak, day).
LINK_LEVELS: Levels = (
    (),
    ("hour",),
    ("link_key",),
    ("media_id",),
    ("hour", "media_id"),
    ("hour", "link_key"),
    ("position_id",),
    ("hour", "position_id"),
)

# Every combination of link, media and position, by day and by hour. The finest one by
# day is reported too.
CUBE_LEVELS: Levels = tuple(
    (*hour, *level)
    for hour in ((), ("hour",))
    for level in cube_levels(("link_key", "media_id", "position_id"))
)


def roll_up(finest: DataFrame, levels: Levels, values: list[str]) -> DataFrame:
    """Sum a finest-grain result up to coarser levels.

    Only for values that add up, such as first-seen flags. Distinct counts do not: a
    visitor of two links is one visitor of the app.
    """
    dims = list(dict.fromkeys(d for level in levels for d in level))
    group = [*BASE, "level", *dims]
    # Sum the dimensions outside all levels away before rows are repeated per level.
    small = finest.groupBy(*BASE, *dims).agg(*[F.sum(v).alias(v) for v in values])
    return at_levels(small, levels, dims).groupBy(*group).agg(*[F.sum(v).alias(v) for v in values])


def pick_level(rolled: DataFrame, level: tuple[str, ...]) -> DataFrame:
    """One level of a multi-level result, with its own dimensions only."""
    dims = [c for c in ("hour", "link_key", "media_id", "position_id") if c in rolled.columns]
    return rolled.filter(F.col("level") == level_name(level)).drop("level", *[d for d in dims if d not in level])
