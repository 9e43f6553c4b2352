"""Reports as streams, with the totals of the batch report.

A batch reduces its rows to partials and stores them by day. The totals of the days it
touched are then made from all stored partials of those days and replace the day's result
rows. Visitors, sessions, bounces that a second page takes back, and late records of
a session all come out exact, because partials are merged before anything is counted.

What counts is named by the commit log of the report's tables (``commits``): a batch is entered once,
against what was entered before it by all runs. What a batch reads back is bounded: the folders of
its days, which are compacted as batches add up, and the buckets of the first-seen state that its
users fall into. With ``job_day`` records of another day are first moved to the day they arrived on, so a
batch touches the days on which it arrived only.

A backfill is a run of its own. It adds records that are missing; or, with ``replaces``, it counts whole
days again, whether or not they were counted before, and ``swap`` puts its rows in their place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.storagelevel import StorageLevel

from footfall.operators import enrich, filters, first_seen, sessions, share
from footfall.operators.rollup import LINK_LEVELS
from footfall.operators.traffic import Levels, merge_partials
from footfall.plans import reports
from footfall.plans.reports import Lookups, ad_link_partials, finish, finish_ads, report_partials, report_rows
from footfall.plans.specs import TERMINAL, ReportSpec
from footfall.schema import FIRST_SEEN_SCHEMA
from footfall.sinks.files import replace_days
from footfall.streaming.commits import Snapshot
from footfall.streaming.tables import LIVE, SegmentTables

ADS, HOME, ACTIVITY = "ad_reports", "ad_home", "ad_activity_detail"
APP_AUTH = "app_auth"


PARTIALS, MARKS, PROFILES, FIRSTS, STATE = "partials", "marks", "profiles", "firsts", "state"


class ReportTables:
    """Where one streamed report keeps its tables. A run has a checkpoint of its own.

    ``replaces`` are the days (``yyyyMMdd``) that a backfill run counts anew; records of other days are
    not its business and left out.
    """

    def __init__(self, root: str, name: str, run: str = LIVE, replaces: list[str] | None = None):
        self.base = f"{root.rstrip('/')}/{name}"
        self.totals = f"{self.base}/totals"
        self.checkpoint = f"{self.base}/checkpoint" if run == LIVE else f"{self.base}/checkpoint-{run}"
        self.run, self.replaces = run, replaces

    def open(self, spark: SparkSession) -> SegmentTables:
        return SegmentTables(spark, self.base, self.run, self.replaces)


@dataclass(frozen=True)
class Side:
    """Rows of a day that a report keeps beside its partials, and how those of several batches are merged."""

    rows: Callable[[DataFrame, DataFrame | None], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Streamed:
    """How a report is made of parts: partials of a batch (against first-seen state, if it has one), their merge,
    result rows from merged ones and sides. ``columns`` are those it reads of the log, None for all."""

    name: str
    partials: Callable[[DataFrame, DataFrame | None], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame, dict[str, DataFrame]], DataFrame]
    sides: dict[str, Side] = field(default_factory=dict)
    columns: list[str] | None = None


_distinct = lambda rows: rows.distinct()
NEW_SESSIONS = {MARKS: Side(lambda log, _: enrich.new_session_marks(log), _distinct)}


def _share(name: str, records: Callable[[DataFrame], DataFrame], dims: list[str]) -> Streamed:
    return Streamed(
        name, lambda log, _: share.share_partials(records(log), dims), share.merge_share,
        lambda partials, sides: share.finish_share(partials, sides[MARKS]), NEW_SESSIONS,
    )


def _finish_user_share(partials: DataFrame, sides: dict[str, DataFrame]) -> DataFrame:
    return reports.with_profiles(share.finish_share(partials, sides[MARKS]), sides[PROFILES].drop("et"), ["ak", "day"])


#: Streamed reports that are no plain ``ReportSpec``.
STREAMED: dict[str, Streamed] = {
    s.name: s
    for s in (
        _share("daily_share_summary", filters.share_records, ["te"]),
        _share("hourly_share_summary", filters.share_records, ["te", "hour"]),
        _share("daily_page_share", reports.page_share_records, reports.PAGE_SHARE),
        Streamed(
            # A sharer's profile is the latest of the day.
            "daily_user_share",
            lambda log, _: share.share_partials(reports.user_share_records(log), reports.USER_SHARE),
            share.merge_share,
            _finish_user_share,
            NEW_SESSIONS | {PROFILES: Side(lambda log, _: enrich.latest_profiles(log, "day"), enrich.merge_profiles)},
        ),
        Streamed(
            "daily_entrance_page",
            lambda log, _: sessions.session_pages(reports.entry_rows(log), ["ak", "day"]),
            sessions.merge_pages,
            lambda pages, _: sessions.entry_totals_of(pages),
        ),
        Streamed(
            "daily_terminal",
            lambda log, _: report_partials(TERMINAL, reports.terminal_rows(log)),
            merge_partials,
            lambda partials, _: reports.stack_terminal(finish(TERMINAL, partials, None)),
            columns=reports.columns_of(TERMINAL),
        ),
        Streamed("sdk_versions", lambda log, _: reports.sdk_versions(log), _distinct, lambda rows, _: rows),
    )
}


def spec_report(spec: ReportSpec, lookups: Lookups = Lookups()) -> Streamed:
    """A report by specification."""
    return Streamed(
        spec.name,
        lambda rows, state: report_partials(spec, rows, lookups, state, strict=True),
        merge_partials,
        lambda partials, sides: finish(spec, partials, sides.get(MARKS)),
        NEW_SESSIONS if spec.session_marks else {},
    )


def ads_report(links: DataFrame, levels: Levels = LINK_LEVELS) -> Streamed:
    return Streamed(
        ADS,
        lambda rows, state: ad_link_partials(rows, links, levels, state, state, strict=True),
        merge_partials,
        lambda partials, _: finish_ads(partials, levels),
    )


def home_report(links: DataFrame, by_hour: bool = False) -> Streamed:
    def partials(rows: DataFrame, state: DataFrame) -> DataFrame:
        in_app = state.filter(F.col("kind") == APP_AUTH).withColumn("kind", F.lit(first_seen.AUTH))
        return reports.home_partials(rows, links, by_hour, state, state, in_app, strict=True)

    return Streamed(HOME, partials, merge_partials, lambda merged, _: reports.finish_home(merged, by_hour))


def activity_report(links: DataFrame, media: DataFrame) -> Streamed:
    """Activity detail. A visit's partial carries when its user was first seen by earlier batches; first visits of
    the day stand beside it."""

    def visits(log: DataFrame, state: DataFrame) -> DataFrame:
        rows = reports.activity_rows(log, links, media)
        last = rows.groupBy(*reports.ACTIVITY_KEYS).agg(F.max("et").alias("last_at"))
        return last.join(first_seen.state_of(state, first_seen.ACTIVITY, "first_ts"), list(first_seen.KEYS), "left")

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*reports.ACTIVITY_KEYS).agg(F.max("last_at").alias("last_at"), F.min("first_ts").alias("first_ts"))

    def finished(rows: DataFrame, sides: dict[str, DataFrame]) -> DataFrame:
        firsts = sides[FIRSTS]
        seen = firsts.select(*first_seen.KEYS, F.col("first_at").alias("first_ts"))
        seen = seen.unionByName(rows.select(*first_seen.KEYS, "first_ts").filter(F.col("first_ts").isNotNull()))
        known = seen.groupBy(*first_seen.KEYS).agg(F.min("first_ts").alias("first_ts"))
        return reports.finish_activity(rows.drop("first_ts"), firsts, known)

    firsts = Side(lambda log, state: reports.activity_firsts(reports.activity_rows(log, links, media), state, strict=True), _distinct)
    return Streamed(ACTIVITY, visits, merge, finished, {FIRSTS: firsts})


def enter(report: Streamed, log: DataFrame, batch_id: int, tables: ReportTables, users: DataFrame | None = None,
          entered: DataFrame | None = None) -> None:
    """Enter one batch and bring the result rows of its days up to date.

    A report with first-seen state names the ``users`` that it looks up and the rows that it enters.
    """
    store = tables.open(log.sparkSession)

    def write(snapshot: Snapshot, name: str) -> list[tuple]:
        state = None if users is None else store.read_keys(snapshot, STATE, FIRST_SEEN_SCHEMA, first_seen.KEYS, users)
        partials = report.partials(log, state)
        out = [(PARTIALS, store.write_days(partials, PARTIALS, name), 0, partials.schema)]
        for table, side in report.sides.items():
            rows = side.rows(log, state)
            out.append((table, store.write_days(rows, table, name), 0, rows.schema))
        if entered is not None:
            rows = entered.select(*FIRST_SEEN_SCHEMA.fieldNames())
            out.append((STATE, None, store.write_keys(rows, STATE, name, first_seen.KEYS), rows.schema))
        return out

    store.enter(batch_id, write)
    _settle(report, store, tables)
    store.compact_days(PARTIALS, report.merge)
    for table, side in report.sides.items():
        store.compact_days(table, side.merge)
    if entered is not None:
        store.compact_keys(STATE, FIRST_SEEN_SCHEMA, first_seen.KEYS, first_seen.merge_state)


def _settle(report: Streamed, store: SegmentTables, tables: ReportTables) -> None:
    def remake(snapshot: Snapshot, days: list[str]) -> None:
        read = lambda table: store.read_days(snapshot, table, store.schema_of(snapshot, table), days)
        sides = {table: side.merge(read(table)) for table, side in report.sides.items()}
        replace_days(report.finish(report.merge(read(PARTIALS)), sides), tables.totals)
        counted = {d for s in snapshot.segments(PARTIALS, store.run) for d in s["days"]}
        for day in set(days) - counted:
            store.log.tables.delete(f"totals/day={day}")

    store.settle(remake)


def swap(report: Streamed, spark: SparkSession, tables: ReportTables) -> None:
    """Put a run's rows in place of what stands for the days it replaces, and remake their totals.

    A user whose first time was entered by a replaced row alone is not known any more; marks
    on other days stay as they are.
    """
    store = tables.open(spark)
    store.swap()
    _settle(report, tables.open(spark), tables)


def refresh(spec: ReportSpec, log: DataFrame, batch_id: int, tables: ReportTables, lookups: Lookups) -> None:
    """Enter one batch of a report by specification."""
    seen = entered = None
    if spec.auth:
        # Only authorisations of the report's own rows count as seen.
        seen = first_seen.auth_records(report_rows(replace(spec, auth=False), log, lookups))
        entered = first_seen.update_state(None, seen, first_seen.AUTH)
    enter(spec_report(spec, lookups), log, batch_id, tables, seen, entered)


def _ad_state(log: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Users with an open id, and the first times that the advertising reports enter for them."""
    known = log.filter(filters.has_openid())
    visits = enrich.add_media(filters.require(known, "ad"), links)
    seen = first_seen.update_state(None, known, first_seen.NEW_USER)
    return known, seen.unionByName(first_seen.update_state(None, first_seen.auth_records(visits), first_seen.AUTH))


def refresh_ads(log: DataFrame, batch_id: int, tables: ReportTables, links: DataFrame, levels: Levels) -> None:
    """The advertising reports, with new and authorised users against one state table."""
    known, entered = _ad_state(log, links)
    enter(ads_report(links, levels), log, batch_id, tables, known, entered)


def refresh_home(log: DataFrame, batch_id: int, tables: ReportTables, links: DataFrame, by_hour: bool) -> None:
    """Link totals beside the app's. A user's first authorisation in a link and in the app are two states."""
    known, entered = _ad_state(log, links)
    entered = entered.unionByName(first_seen.update_state(None, first_seen.auth_records(known), APP_AUTH))
    enter(home_report(links, by_hour), log, batch_id, tables, known, entered)


def refresh_activity(log: DataFrame, batch_id: int, tables: ReportTables, links: DataFrame, media: DataFrame) -> None:
    """Activity detail, with users' first visits against a state table."""
    rows = reports.activity_rows(log, links, media)
    entered = first_seen.update_state(None, rows.filter(F.col("ifo") == "true"), first_seen.ACTIVITY)
    enter(activity_report(links, media), log, batch_id, tables, rows, entered)


def stream(log: DataFrame, report: str | Streamed, root: str, job_day: Column | None = None, run: str = LIVE,
           replaces: list[str] | None = None) -> DataStreamWriter:
    """A report of ``STREAMED``, or one made of parts, as a stream."""
    report = STREAMED[report] if isinstance(report, str) else report
    tables = ReportTables(root, report.name, run, replaces)
    return each_batch(log, job_day, tables, lambda batch, batch_id: enter(report, batch, batch_id, tables), report.columns)


def stream_report(log: DataFrame, spec: ReportSpec, root: str, lookups: Lookups = Lookups(), job_day: Column | None = None,
                  run: str = LIVE, replaces: list[str] | None = None) -> DataStreamWriter:
    """A writer that keeps the report's totals; start it with ``ingest.run_available`` or ``start_every``."""
    tables = ReportTables(root, spec.name, run, replaces)
    return each_batch(log, job_day, tables, lambda batch, batch_id: refresh(spec, batch, batch_id, tables, lookups), reports.columns_of(spec))


def stream_ads(log: DataFrame, root: str, links: DataFrame, levels: Levels = LINK_LEVELS, job_day: Column | None = None,
               run: str = LIVE, replaces: list[str] | None = None) -> DataStreamWriter:
    """The advertising reports as a stream."""
    tables = ReportTables(root, ADS, run, replaces)
    return each_batch(log, job_day, tables, lambda batch, batch_id: refresh_ads(batch, batch_id, tables, links, levels), reports.AD_COLUMNS)


def stream_home(log: DataFrame, root: str, links: DataFrame, by_hour: bool = False, job_day: Column | None = None,
                run: str = LIVE, replaces: list[str] | None = None) -> DataStreamWriter:
    """The advertising home report as a stream."""
    tables = ReportTables(root, HOME, run, replaces)
    return each_batch(log, job_day, tables, lambda batch, batch_id: refresh_home(batch, batch_id, tables, links, by_hour))


def stream_activity(log: DataFrame, root: str, links: DataFrame, media: DataFrame, job_day: Column | None = None,
                    run: str = LIVE, replaces: list[str] | None = None) -> DataStreamWriter:
    """Activity detail as a stream. A first visit goes to the batch that sees it first."""
    tables = ReportTables(root, ACTIVITY, run, replaces)
    return each_batch(log, job_day, tables, lambda batch, batch_id: refresh_activity(batch, batch_id, tables, links, media))


def each_batch(log: DataFrame, job_day: Column | None, tables: ReportTables, take: Callable[[DataFrame, int], None],
               columns: Sequence[str] | None = None) -> DataStreamWriter:
    """A batch is kept while it is taken in, of its ``columns`` only those named."""

    def each(batch: DataFrame, batch_id: int) -> None:
        if tables.replaces:
            batch = batch.filter(F.col("day").isin(*tables.replaces))
        if columns is not None:
            batch = first_seen.slim(batch, columns)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            take(batch, batch_id)
        finally:
            batch.unpersist()

    aligned = log if job_day is None else enrich.align_day(log, job_day)
    return aligned.writeStream.foreachBatch(each)
