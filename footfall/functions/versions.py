"""SDK version tests. Versions compare number by number, not as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.schema import LEGACY_CUSTOM_SDKS


def version_part(version: Column, index: int) -> Column:
    """The index-th dot-separated number, null when it is missing or not a number."""
    return F.try_element_at(F.split(version, r"\."), F.lit(index + 1)).try_cast("int")


def is_old_sdk(version: Column) -> Column:
    """Before 7.0.0, or one of the legacy custom builds."""
    major = F.regexp_extract(version, r"^(\d+)", 1).try_cast("int")
    return F.coalesce(major < 7, version.isin(*LEGACY_CUSTOM_SDKS), F.lit(False))


def at_least(version: Column, minimum: str) -> Column:
    """``version >= minimum``; a version that does not start with a number is not."""
    wanted = [int(p) for p in minimum.split(".")]
    have = [F.coalesce(version_part(version, i), F.lit(0)) for i in range(len(wanted))]
    *head, last = list(zip(have, wanted))
    compared = reduce(
        lambda rest, pair: (pair[0] > pair[1]) | ((pair[0] == pair[1]) & rest),
        reversed(head),
        last[0] >= last[1],
    )
    return F.coalesce(version_part(version, 0).isNotNull() & compared, F.lit(False))


def is_proper_sdk(version: Column) -> Column:
    return F.coalesce(version.rlike("[0-9].[0-9].[0-9]"), F.lit(False))


def is_third_party(version: Column) -> Column:
    """1 when a three-part version ends in an odd number, else 0."""
    odd = (F.size(F.split(version, r"\.")) == 3) & (version_part(version, 2) % 2 != 0)
    return F.coalesce(odd, F.lit(False)).cast("int")
