"""Sinks, sources, streams: replays, restarts and hand-made inputs."""

import json

from pyspark.sql import functions as F

from footfall.functions import times
from footfall.operators import first_seen
from footfall.operators.filters import has_openid
from footfall.plans import reports
from footfall.plans.specs import JOBS
from footfall.sinks.upsert import merge_totals, upsert_table
from footfall.sources import kafka, logs, lookups
from footfall.streaming import ingest, sessions, tables, uniques
from footfall.streaming import reports as streamed
from footfall.workload.log import log_of, lookups_of


def _rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_upsert_repeats_without_change(spark, tmp_path):
    path, staged = str(tmp_path / "t"), str(tmp_path / "staged")
    schema = "ak string, n long, day string"
    first = spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d2")], schema)
    second = spark.createDataFrame([("a", 5, "d1")], schema)
    read = lambda: sorted((r.ak, r.n, r.day) for r in spark.read.schema(schema).parquet(path).collect())
    for policy, expected in (("acc", [("a", 6, "d1"), ("b", 2, "d2")]), ("set", [("a", 5, "d1"), ("b", 2, "d2")])):
        for step, delta in ((0, first), (1, second), (1, second)):
            if policy == "set" or step or not (tmp_path / "t").exists():
                upsert_table(delta, path, f"{staged}/{policy}/{step}", ["ak", "day"], policy, ["n"])
        assert read() == expected


def test_merge_recomputes_ratios(spark):
    schema = "ak string, open_count long, one_page_count long"
    a = spark.createDataFrame([("a", 2, 1)], schema)
    b = spark.createDataFrame([("a", 2, 2), ("b", 1, 1)], schema)
    merged = merge_totals(a, b, ["ak"], "acc", ["open_count", "one_page_count"], ["bounce_rate"])
    assert _rows(merged) == [("a", 0.75, 3, 4), ("b", 1.0, 1, 1)]


def test_first_seen_is_rerun_safe(spark, sf_dir):
    day = log_of(spark, sf_dir).filter(has_openid() & (F.col("day") == "20240110"))
    once = first_seen.first_seen(day, first_seen.update_state(None, day.limit(0)))
    again = first_seen.first_seen(day, first_seen.update_state(None, day))
    assert _rows(once) == _rows(again) and once.count() > 0
    later = log_of(spark, sf_dir).filter(has_openid() & (F.col("day") == "20240111"))
    known = first_seen.first_seen(later, first_seen.update_state(None, day))
    assert not {(r.ak, r.op) for r in known.collect()} & {(r.ak, r.op) for r in day.collect()}


def test_known_users_from_files(spark, tmp_path):
    (tmp_path / "app1.csv").write_text("x" * 28 + "\nshort\n" + "y" * 28 + "\n")
    (tmp_path / "app2.csv").write_text(" " + "z" * 28 + " \n")
    users = logs.read_known_users(spark, f"{tmp_path}/*.csv")
    assert _rows(users) == [("app1", "x" * 28), ("app1", "y" * 28), ("app2", "z" * 28)]


def test_raw_lines_carry_their_file_time(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"ak": "a"}\n')
    row = logs.read_lines(spark, str(tmp_path / "a.json")).collect()[0]
    assert row.value == '{"ak": "a"}' and row.ingest_ms > 1_700_000_000_000


def test_row_ids_repeat(spark, sf_dir):
    read = lambda: logs.with_row_id(spark.read.parquet(f"{sf_dir}/nation.parquet")).select("event_id", "n_name")
    assert _rows(read()) == _rows(read()) and read().select("event_id").distinct().count() == 25


def test_first_source_of_a_lookup_wins(spark):
    a = spark.createDataFrame([("q1", "a")], "k string, v string")
    b = spark.createDataFrame([("q1", "b"), ("q2", "b")], "k string, v string")
    assert _rows(lookups.lookup_first_wins([a, b], ["k"])) == [("q1", "a"), ("q2", "b")]


def test_kafka_options():
    options = kafka.range_options("h:1", "t", {0: 5}, {0: 9})
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 5}} and json.loads(options["endingOffsets"]) == {"t": {"0": 9}}
    assert kafka.stream_options("h:1", "t")["startingOffsets"] == "latest"
    assert kafka.stream_options("h:1", "t", max_offsets=kafka.CHUNK_OFFSETS)["maxOffsetsPerTrigger"] == "4000000"
    assert json.loads(kafka.time_range_options("h:1", "t", 2, 10, 20)["endingOffsetsByTimestamp"]) == {"t": {"0": 20, "1": 20}}
    assert kafka.clamp_offsets({0: 3, 1: 50}, {0: 10, 1: 0}, {0: 40, 1: 45, 2: 7}) == {0: 10, 1: 45, 2: 7}


def test_kafka_rows_become_log_lines(spark):
    source = spark.createDataFrame([(bytearray(b'{"ak":"a"}'), "t", 0, 7)], "value binary, topic string, partition int, offset long")
    row = kafka.lines(source.withColumn("timestamp", F.timestamp_millis(F.lit(1_704_880_800_000)))).collect()[0]
    assert tuple(row) == ('{"ak":"a"}', 1_704_880_800_000, "t-0-7")


def test_replayed_batch_leaves_totals(spark, sf_dir, tmp_path):
    """A batch that is entered again after a failure changes nothing."""
    spec, kept = JOBS["trend_job"], streamed.ReportTables(str(tmp_path), "trend_job")
    log = log_of(spark, sf_dir)
    parts = [log.filter(F.col("event_id") % 3 == i) for i in range(3)]
    for batch_id in (0, 1, 1, 2, 2):
        streamed.refresh(spec, parts[batch_id], batch_id, kept, lookups_of(spark))
    want = reports.report("trend_job", log)
    got = spark.read.parquet(kept.totals).withColumn("day", F.col("day").cast("string")).select(*want.columns)
    assert _rows(got) == _rows(want)


def test_bounce_is_taken_back_across_batches(spark, tmp_path):
    """One page in the first batch, a second page in the next, an earlier page in the last."""
    schema = "ak string, day string, att string, pp string, et long, dr long, ifo string"
    batches = [
        [("a", "d", "s", "p1", 20, 5, "false"), ("a", "d", "t", "p1", 20, 1, "false")],
        [("a", "d", "s", "p2", 30, 9, "true")],
        [("a", "d", "s", "p0", 10, 3, "false")],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/b={i}")
    files = spark.read.parquet(f"{tmp_path}/in").drop("b").schema

    def run(name, changes, keys, sums):
        with sessions.state_settings(spark):
            ingest.run_available(sessions.keep_changes(changes, keys, sums, f"{tmp_path}/{name}"), f"{tmp_path}/{name}_cp")
        return spark.read.parquet(f"{tmp_path}/{name}")

    stream = ingest.file_stream(spark, f"{tmp_path}/in/*", files, 1)
    changes = run("s", sessions.session_changes(stream, ["ak", "day"], times.day_of(F.col("et"))), ["ak", "day"], sessions.SUMS)
    by_batch = {r.batch_id: r for r in changes.collect()}
    assert sum(r.one_page_count for r in by_batch.values()) == 1
    assert min(r.one_page_count for r in by_batch.values()) == -1
    assert sum(r.total_stay_time for r in by_batch.values()) == 10 and sum(r.open_count for r in by_batch.values()) == 2

    stream = ingest.file_stream(spark, f"{tmp_path}/in/*", files, 1)
    moved = run("e", sessions.entry_changes(stream, ["ak", "day"], times.day_of(F.col("et"))), ["ak", "day", "page_path"], sessions.ENTRY_SUMS)
    totals = moved.groupBy("page_path").agg(F.sum("entry_page_count").alias("n")).filter("n <> 0")
    assert _rows(totals) == [(1, "p0"), (1, "p1")]


def test_stored_increments_ignore_replays(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2)], "ak string, uv long")
    for batch_id in (0, 1, 1):
        tables.write_batch(rows, f"{tmp_path}/uv", batch_id)
    assert _rows(uniques.running_totals(spark, f"{tmp_path}/uv", rows.schema, ["ak"], ["uv"])) == [("a", 4)]


def test_two_checkpoints_on_one_table_keep_both(spark, tmp_path):
    rows = lambda n: spark.createDataFrame([("a", n)], "ak string, uv long")
    for run, n in (("live", 1), ("again", 2), ("again", 2)):
        tables.write_batch(rows(n), f"{tmp_path}/uv", 0, run=run)
    schema = rows(0).schema
    assert _rows(uniques.running_totals(spark, f"{tmp_path}/uv", schema, ["ak"], ["uv"])) == [("a", 3)]
    before = tables.read_batches(spark, f"{tmp_path}/uv", schema, before=0, run="again")
    assert _rows(before) == [("a", 1)]


def test_day_policy_replaces_whole_days(spark, tmp_path):
    schema = "ak string, n long, day string"
    path = str(tmp_path / "t")
    upsert_table(spark.createDataFrame([("a", 1, "d1"), ("gone", 2, "d1"), ("b", 3, "d2")], schema), path, f"{tmp_path}/s/0", ["ak", "day"])
    upsert_table(spark.createDataFrame([("a", 5, "d1")], schema), path, f"{tmp_path}/s/1", ["ak", "day"], "days")
    rows = spark.read.schema(schema).parquet(path).collect()
    assert sorted((r.ak, r.n, r.day) for r in rows) == [("a", 5, "d1"), ("b", 3, "d2")]


def test_long_sources_stay_apart(spark, sf_dir):
    long = F.concat(F.lit("x" * 300), (F.col("event_id") % 3).cast("string"))
    log = log_of(spark, sf_dir).withColumns({"ct_utm_s": long, "wsr_query_utm_s": long})
    assert reports.page_share(log).select("source").distinct().count() == 3


def test_retention_mask_holds_many_days(spark):
    import pytest

    from footfall.operators import retention

    base = spark.createDataFrame([("20240101", "a", "o"), ("20240220", "a", "o")], "day string, ak string, op string")
    masks = {r.day: r.mask for r in retention.return_days(base, 55).collect()}
    assert masks["20240101"] == 1 | 1 << 50
    with pytest.raises(ValueError):
        retention.return_days(base, 63)


class _Kept:
    """State of one group, as a processor sees it."""

    value, calls = None, 0

    def getValueState(self, *_, **__):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.calls = value, self.calls + 1

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_sessions_of_a_bucket_are_taken_in_at_once():
    """One call and one write for all of them; a session without records for the hours begins anew."""
    import pandas as pd

    kept, keys = _Kept(), ["ak", "att"]
    processor = sessions.SessionChanges(keys, 1)
    processor.init(kept)

    def take(now, *values):
        kept.now = now
        columns = [*keys, "pv", "first_ms", "stay", "is_new", "first_page", "low_page", "high_page"]
        rows = pd.DataFrame([("a", att, 1, 5, stay, 0, p, p, p) for att, stay, p in values], columns=columns)
        (out,) = processor.handleInputRows(("d", 0), iter([rows]), kept)
        return {r.att: (r.open_count, r.one_page_count, r.total_stay_time, r.pv) for r in out.itertuples()}

    many = [(f"s{i}", i, "p") for i in range(500)]
    assert take(0, *many) == {f"s{i}": (1, 1, i, 1) for i in range(500)} and kept.calls == 1
    assert take(1_000, ("s1", 3, "q"), ("s1", None, "p"), ("new", None, "p")) == {"s1": (0, -1, 2, 2), "new": (1, 1, 0, 1)}
    assert take(3_600_500, ("s1", 9, "p"), ("s2", 9, "p")) == {"s1": (0, 0, 6, 1), "s2": (1, 1, 9, 1)}
    assert kept.calls == 3
