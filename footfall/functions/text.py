"""String, JSON and ratio functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.schema import NULL_TEXT


def blank_to_null(col: Column) -> Column:
    """Blank text and the literal ``null`` both mean "missing"."""
    return F.when((F.trim(col) != "") & (col != NULL_TEXT), col)


def present(col: Column) -> Column:
    """Neither null, blank nor ``null``. Plain conjuncts, so a file scan can take part of them."""
    return col.isNotNull() & (col != NULL_TEXT) & (F.trim(col) != "")


def or_default(col: Column, default: str) -> Column:
    return F.coalesce(blank_to_null(col), F.lit(default))


def or_unknown(col: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(col), F.lit("")), F.lit("unknown"))


def is_integer(col: Column) -> Column:
    return F.coalesce(col.cast("string").rlike(r"^\d+$"), F.lit(False))


def url_without_params(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def lower_host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def query_param(url: Column, name: str) -> Column:
    """Value of one ``name=value`` parameter of a path, null when absent or empty."""
    return F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&=#]+)(?:&|#|$)", 1), F.lit(""))


def without_leading_slash(path: Column) -> Column:
    return F.regexp_replace(path, "^/(?=.)", "")


def key_hash(*cols: Column) -> Column:
    """First eight hex digits of the keys' md5, for spreading rows; never an identity."""
    return F.substring(F.md5(F.concat_ws("\x1f", *cols).cast("binary")), 1, 8)


def safe_ratio(part: Column, whole: Column) -> Column:
    """``round(part / whole, 2)``, 0 for an empty whole.

    Rounded half up in whole numbers, so that ties do not depend on how a binary
    fraction prints. Both inputs are counts or sums, never negative.
    """
    part, whole = part.cast("long"), whole.cast("long")
    twice = F.nullif(whole * 2, F.lit(0).cast("long"))
    hundredths = F.call_function("div", part * 200 + whole, twice)
    return F.coalesce(hundredths / F.lit(100.0), F.lit(0.0))
