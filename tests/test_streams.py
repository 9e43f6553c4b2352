"""The commit log of streamed tables: replays, several runs, compaction, state that grows."""

from __future__ import annotations

import contextlib
import io
import json

import pytest
from pyspark.sql import functions as F

from footfall.operators import first_seen
from footfall.schema import FIRST_SEEN_SCHEMA
from footfall.streaming import ingest, reports, tables, uniques
from footfall.streaming.commits import CommitLog, Conflict
from footfall.streaming.tables import SegmentTables

LOG = "ak string, uu string, day string, et long"
DAY_MS = 86_400_000
UNIQUES = uniques.unique_report(["ak"])


def rows(spark, *values):
    return spark.createDataFrame([("a", u, d, 0) for u, d in values], LOG)


def totals(spark, kept):
    return {(r.day, r.uv) for r in spark.read.parquet(kept.totals).withColumn("day", F.col("day").cast("string")).collect()}


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_a_version_is_made_by_one_writer(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    first, second = log.load().changed(), log.load().changed()
    first.content["next"], second.content["next"] = 1, 2
    log.commit(first)
    with pytest.raises(Conflict):
        log.commit(second)
    assert log.load().content["next"] == 1
    for _ in range(15):
        log.commit(log.load().changed())
    assert log.load().number == 16 and len(log.folder.names()) <= 12
    assert not [n for n in log.folder.names() if "draft" in n]


def test_a_batch_is_entered_once(spark, tmp_path):
    kept = reports.ReportTables(str(tmp_path), UNIQUES.name)
    for _ in range(2):
        reports.enter(UNIQUES, rows(spark, ("u", "20240101"), ("v", "20240101")), 0, kept)
    reports.enter(UNIQUES, rows(spark, ("v", "20240101"), ("w", "20240101"), (None, "20240101"), ("w", "20240102")), 1, kept)
    assert totals(spark, kept) == {("20240101", 3), ("20240102", 1)}


def test_a_batch_without_rows(spark, tmp_path):
    kept = reports.ReportTables(str(tmp_path), UNIQUES.name)
    reports.enter(UNIQUES, spark.createDataFrame([], LOG), 0, kept)
    reports.enter(UNIQUES, rows(spark, ("u", "20240101")), 1, kept)
    assert totals(spark, kept) == {("20240101", 1)}


def test_an_attempt_that_fails_half_way(spark, tmp_path, monkeypatch):
    kept = reports.ReportTables(str(tmp_path), UNIQUES.name)
    reports.enter(UNIQUES, rows(spark, ("u", "20240101")), 0, kept)
    # Rows are written, but no version says so.
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            reports.enter(UNIQUES, rows(spark, ("v", "20240101"), ("x", "20240102")), 1, kept)
    assert totals(spark, kept) == {("20240101", 1)}
    # The batch is counted, but its totals are not remade: the replay makes up for it.
    with monkeypatch.context() as m:
        m.setattr(reports, "replace_days", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            reports.enter(UNIQUES, rows(spark, ("v", "20240101")), 1, kept)
    reports.enter(UNIQUES, rows(spark, ("v", "20240101")), 1, kept)
    assert totals(spark, kept) == {("20240101", 2)}


def test_two_runs_at_once_know_each_others_users(spark, tmp_path):
    """The batch that is second to commit is done again, against the state of the first."""
    users = spark.createDataFrame([("a", "o1")], "ak string, op string")
    entered = first_seen.update_state(None, users, ts=F.lit(5)).select(*FIRST_SEEN_SCHEMA.fieldNames())
    live, again = SegmentTables(spark, str(tmp_path)), SegmentTables(spark, str(tmp_path), "again")
    seen = []

    def write(store, before=None):
        def entry(snapshot, name):
            known = store.read_keys(snapshot, "state", FIRST_SEEN_SCHEMA, first_seen.KEYS, users)
            seen.append((store.run, users.join(known, list(first_seen.KEYS), "left_anti").count()))
            count = store.write_keys(entered, "state", name, first_seen.KEYS)
            if before and len(seen) == 1:
                before()
            return [("state", None, count, entered.schema)]

        return entry

    live.enter(0, write(live, lambda: again.enter(0, write(again))))
    assert seen == [("live", 1), ("again", 1), ("live", 0)]


def test_a_backfill_counts_days_again(spark, tmp_path):
    live = reports.ReportTables(str(tmp_path), UNIQUES.name)
    again = reports.ReportTables(str(tmp_path), UNIQUES.name, "again", ["20240101", "20240103"])
    reports.enter(UNIQUES, rows(spark, ("u", "20240101"), ("wrong", "20240101"), ("u", "20240102"), ("gone", "20240103")), 0, live)
    reports.enter(UNIQUES, rows(spark, ("u", "20240101"), ("x", "20240101"), ("y", "20240101")), 0, again)
    before = {("20240101", 2), ("20240102", 1), ("20240103", 1)}
    assert totals(spark, live) == before  # nothing counts before the swap
    reports.enter(UNIQUES, rows(spark, ("z", "20240101")), 1, again)
    for _ in range(2):
        reports.swap(UNIQUES, spark, again)
        assert totals(spark, live) == {("20240101", 4), ("20240102", 1)}
    reports.enter(UNIQUES, rows(spark, ("late", "20240101")), 1, live)
    reports.enter(UNIQUES, rows(spark, ("wrong", "20240101")), 0, live)
    assert totals(spark, live) == {("20240101", 5), ("20240102", 1)}
    with pytest.raises(ValueError):
        reports.swap(UNIQUES, spark, live)


def test_state_of_replaced_days_goes(spark, tmp_path):
    state = lambda *v: spark.createDataFrame([("a", o, "auth", ts) for o, ts in v], FIRST_SEEN_SCHEMA)
    store = lambda run="live", days=None: SegmentTables(spark, str(tmp_path), run, days)
    enter = lambda s, n, *v: s.enter(n, lambda _, name: [("state", None, s.write_keys(state(*v), "state", name, first_seen.KEYS), FIRST_SEEN_SCHEMA)])
    known = lambda s: {(r.op, r.first_ts // DAY_MS) for r in s.read_keys(s.snapshot(), "state", FIRST_SEEN_SCHEMA, first_seen.KEYS).collect()}
    enter(store(), 0, ("o1", 0), ("o2", DAY_MS), ("o3", 2 * DAY_MS))
    again = store("again", ["19700102"])
    assert known(again) == {("o1", 0), ("o3", 2)} and known(store()) == {("o1", 0), ("o2", 1), ("o3", 2)}
    enter(again, 0, ("o4", DAY_MS))
    assert ("o4", 1) not in known(store())
    again.swap()
    assert known(store()) == known(store("other")) == {("o1", 0), ("o3", 2), ("o4", 1)}


class Unwritten(SegmentTables):
    """Keeps the log only."""

    def write_days(self, rows, table, name):
        return ["20240101"]

    def read_days(self, snapshot, table, schema, days, names=None):
        self.read = names
        return self.spark.createDataFrame([], schema)


def test_batches_of_a_day_leave_few_segments(spark, tmp_path):
    store = Unwritten(spark, str(tmp_path))
    schema = spark.createDataFrame([], LOG).schema
    most = 0
    for n in range(200):
        store.enter(n, lambda _, name: [("partials", ["20240101"], 0, schema)])
        store.compact_days("partials", lambda found: found)
        most = max(most, len(store.snapshot().segments("partials", "live")))
    assert most <= 3 * tables.FANOUT
    assert len(json.dumps(store.snapshot().content)) < 100_000


def test_compaction_changes_no_total_and_removes_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FANOUT", 3)
    kept = reports.ReportTables(str(tmp_path), UNIQUES.name)
    for n in range(7):
        reports.enter(UNIQUES, rows(spark, (f"u{n % 4}", "20240101"), (f"v{n}", "20240102")), n, kept)
    assert totals(spark, kept) == {("20240101", 4), ("20240102", 7)}
    store = kept.open(spark)
    segments = store.snapshot().segments("partials", "live")
    assert max(s["level"] for s in segments) == 1 and len(segments) <= 6
    reports.enter(UNIQUES, rows(spark, ("u9", "20240102")), 7, kept)  # the next batch sweeps
    counted = {f"seg={s['name']}" for s in store.snapshot().segments("partials", "live")}
    assert set(store.log.tables.names("partials")) == counted and totals(spark, kept) == {("20240101", 4), ("20240102", 8)}


def test_state_is_cut_into_more_buckets_as_it_grows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FANOUT", 2)
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    store = SegmentTables(spark, str(tmp_path))
    users = spark.range(6_000).select(F.lit("a").alias("ak"), F.col("id").cast("string").alias("op"), F.lit("new_user").alias("kind"), F.col("id").alias("first_ts"))
    for n in range(2):
        part = users.where(F.col("first_ts") % 2 == n)
        store.enter(n, lambda _, name, part=part: [("state", None, store.write_keys(part, "state", name, first_seen.KEYS), FIRST_SEEN_SCHEMA)])
        store.compact_keys("state", FIRST_SEEN_SCHEMA, first_seen.KEYS, first_seen.merge_state)
    (segment,) = store.snapshot().segments("state", "live")
    assert segment["bits"] == 6 and segment["rows"] == 6_000
    batch = users.where("first_ts % 200 = 0")  # 30 users, more than one bucket's
    found = store.read_keys(store.snapshot(), "state", FIRST_SEEN_SCHEMA, first_seen.KEYS, batch)
    assert "bucket" in plan_of(found) and batch.join(found, list(first_seen.KEYS), "left_anti").count() == 0
    assert found.count() < 3_600 and found.groupBy("ak", "op").count().where("count > 1").count() == 0


def test_records_in_any_order_are_counted(spark, tmp_path):
    """Days apart, newest first; no delay and no watermark is set."""
    log = lambda *v: spark.createDataFrame([("a", u, f"202401{d:02}", (1704067200 + (d - 1) * 86400) * 1000) for u, d in v], LOG)
    schema = log(("u", 1)).schema
    for n, part in enumerate([log(("u", 20), ("v", 20)), log(("u", 1), ("w", 1)), log(("x", 20), ("u", 9)), log(("u", 1), ("y", 1))]):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{n}")
    for report in (UNIQUES, uniques.window_report(["ak"])):
        stream = reports.stream(ingest.file_stream(spark, f"{tmp_path}/in/*", schema, 1), report, str(tmp_path))
        ingest.run_available(stream, f"{tmp_path}/{report.name}-checkpoint")
    assert totals(spark, reports.ReportTables(str(tmp_path), UNIQUES.name)) == {("20240120", 3), ("20240101", 3), ("20240109", 1)}
    views = spark.read.parquet(reports.ReportTables(str(tmp_path), uniques.WINDOWS).totals)
    assert {(str(r.day), r.pv) for r in views.collect()} == {("20240120", 3), ("20240101", 4), ("20240109", 1)}
    with pytest.raises(ValueError):
        uniques.window_report(["ak"], 7 * 3_600)
