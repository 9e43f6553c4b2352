"""Raw JSON log lines -> typed, defaulted log rows. One projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall import schema as S
from footfall.functions import text, times, versions

_UTM = ("ct_utm_s", "ct_utm_m", "ct_utm_p", "wsr_query_utm_s", "wsr_query_utm_m", "wsr_query_utm_p")
_CORRUPT = "_malformed"


def _parsed(value: str) -> Column:
    """The line as a struct, with the line itself in ``_malformed`` where it does not parse."""
    schema = T.StructType([*S.RAW_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return F.when(F.trim(F.col(value)).startswith("{"), F.from_json(F.col(value), schema, options))


def parse_lines(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per well-formed JSON line with every raw field as text; malformed lines go.

    The struct is unpacked by a generator, not by field access: a filter on a field would
    be pushed below the parse and parse every line again.
    """
    unpacked = lines.select(*keep, _parsed(value).alias("r")).select(*keep, F.inline(F.array(F.col("r"))))
    is_line = F.col(_CORRUPT).isNull() & F.coalesce(*S.RAW_FIELDS).isNotNull()
    return unpacked.filter(is_line).select(*keep, *S.RAW_FIELDS)


def count_rejects(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines read and lines rejected, for monitoring a source."""
    parsed = lines.select(_parsed(value).alias("r"))
    empty = F.coalesce(*[F.col(f"r.{f}") for f in S.RAW_FIELDS]).isNull()
    bad = F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull() | empty
    return parsed.agg(F.count("*").alias("lines"), F.count_if(bad).alias("rejected"))


def normalize_log(lines: DataFrame, value: str = "value", ingest_ms: str | None = None,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse and normalise raw lines.

    ``ingest_ms`` names a column with the arrival time in ms (Kafka record time, file
    time); it dates lines whose own event time does not parse. Without it such lines
    have no day and fail the required-field filters.
    """
    kept = tuple(dict.fromkeys([*keep, *([ingest_ms] if ingest_ms else [])]))
    return normalize_fields(parse_lines(lines, value, kept), ingest_ms)


def normalize_fields(raw: DataFrame, ingest_ms: str | None = None) -> DataFrame:
    """Apply the field rules to rows that already carry the raw fields as text columns."""
    extra = [c for c in raw.columns if c not in S.RAW_FIELDS]
    clean = raw.select(*extra, *[text.blank_to_null(F.col(f)).alias(f) for f in S.RAW_FIELDS])

    # Nested JSON is read into columns of its own first, so that each read happens once.
    nested = clean.withColumns(
        {
            "_scene": F.get_json_object("wsr", "$.scene"),
            "_path": F.get_json_object("wsr", "$.path"),
            "_gender": F.get_json_object(F.get_json_object("ufo", "$.userInfo"), "$.gender"),
        }
    )
    first = nested.withColumns(
        {
            "scene": F.coalesce("scene", text.blank_to_null(F.col("_scene"))),
            "path": F.coalesce(
                text.blank_to_null(text.url_without_params(F.col("ct_path"))),
                F.col("path"),
                text.blank_to_null(F.col("_path")),
            ),
            "ct_utm_s": F.coalesce(text.query_param(F.col("ct_path"), "utm_s"), F.col("ct_utm_s")),
            "gender": F.coalesce(text.blank_to_null(F.col("_gender")), F.col("gender")),
            "img": F.coalesce("img", F.lit(S.NO_IMG)),
            "ifo": F.coalesce("ifo", F.lit("false")),
            "te": F.coalesce("te", F.lit(S.DEFAULT_PLATFORM)),
            "op": F.coalesce("op", F.lit(S.NO_OPENID)),
            "v": F.coalesce("v", F.lit(S.DEFAULT_SDK)),
        }
    ).drop("_scene", "_path", "_gender")

    utm_s, utm_m = F.col("wsr_query_utm_s"), F.col("wsr_query_utm_m")
    from_utm_qr = F.col("qr").isNull() & F.col("scene").isin(*S.QR_SCENES) & utm_s.isNotNull()
    from_utm_link = (
        F.col("wsr_query_ald_link_key").isNull()
        & F.col("scene").isin(*S.AD_SCENES)
        & utm_s.isNotNull()
        & utm_m.isNotNull()
    )
    auth_only = (F.col("img") != S.NO_IMG) & (F.col("ifo") == "true")

    def default_if_auth(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.when(auth_only, F.lit(default)))

    second = first.withColumns(
        {
            "qr_group": F.when(from_utm_qr, F.coalesce(utm_m, F.col("qr_group"))).otherwise(F.col("qr_group")),
            "qr": F.when(from_utm_qr, utm_s).otherwise(F.col("qr")),
            "wsr_query_ald_link_key": F.when(from_utm_link, utm_s).otherwise(F.col("wsr_query_ald_link_key")),
            "wsr_query_ald_media_id": F.when(from_utm_link, utm_m).otherwise(F.col("wsr_query_ald_media_id")),
            "dr": default_if_auth("dr", "0"),
            "ev": default_if_auth("ev", S.NO_LEVEL),
            "pp": default_if_auth("pp", S.NO_PAGE),
            "et": _event_millis(ingest_ms),
        }
    )

    return second.withColumns(
        {
            **{name: F.coalesce(F.col(name), F.lit(S.NULL_TEXT)) for name in _UTM},
            "dr": _stay_seconds(),
            "day": times.day_of(F.col("et")),
            "hour": times.hour_of(F.col("et")),
        }
    ).withColumnsRenamed(S.RENAMED)


def _event_millis(ingest_ms: str | None) -> Column:
    own = times.to_millis(F.col("et").try_cast("long"))
    return F.coalesce(own, F.col(ingest_ms).cast("long")) if ingest_ms else own


def _stay_seconds() -> Column:
    """New SDKs send milliseconds, old ones seconds.

    A missing value, a negative one, or an unreadable one of an old SDK gets 10 to 59 s
    derived from the row itself, so a rerun gives the same total. An unreadable one of a new SDK is 0.
    """
    dr = F.col("dr")
    number = dr.try_cast("long")
    key = F.concat_ws("|", F.coalesce("ak", F.lit("")), F.coalesce("at", F.lit("")), F.coalesce(F.col("et").cast("string"), F.lit("")))
    filler = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 50 + 10
    seconds = F.coalesce(F.call_function("div", number, F.lit(1000).cast("long")), F.lit(0).cast("long"))
    return (
        F.when(dr.isNull(), filler)
        .when(~versions.is_old_sdk(F.col("v")), F.when(seconds < 0, filler).otherwise(seconds))
        .when(text.is_integer(dr) & number.isNotNull(), number)
        .otherwise(filler)
    )
