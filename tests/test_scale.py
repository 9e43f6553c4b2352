"""Hot keys, lookups beyond the broadcast bound, and the plans behind the reports."""

from pyspark.sql import functions as F

from footfall.operators import enrich
from footfall.operators.traffic import traffic_totals
from footfall.plans import reports
from footfall.workload.log import log_of, lookup


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_log(spark):
    """A third of all rows in one session of one user and link."""
    hot = F.col("id") % 3 == 0
    return spark.range(6000).select(
        F.col("id").alias("event_id"), F.lit("app1").alias("ak"), F.lit("wx").alias("te"), F.lit("20240110").alias("day"),
        F.lit("10").alias("hour"), F.when(hot, "hot").otherwise(F.concat(F.lit("s"), F.col("id").cast("string"))).alias("att"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 50).cast("string"))).alias("uu"),
        F.concat(F.lit("p"), (F.col("id") % 7).cast("string")).alias("pp"), (F.col("id") % 60).alias("dr"),
        (F.col("id") + 1_704_880_800_000).alias("et"), F.lit("page").alias("ev"),
        F.when(F.col("id") == 3, "true").otherwise("false").alias("ifo"), F.lit("6.0.0").alias("v"),
        F.when(hot, "L1").otherwise("L2").alias("link_key"), F.lit("useless_img").alias("img"), F.lit("o").alias("op"),
    )


def test_lookups_fold_to_one_row_per_key(spark):
    log = hot_log(spark).withColumn("scene", F.lit("1001"))
    twice = lookup(spark, "links").unionByName(lookup(spark, "links").withColumn("media_id", F.lit(9)))
    media = lookup(spark, "media").unionByName(lookup(spark, "media").withColumn("media_name", F.lit("zz")))
    assert enrich.add_media(log, twice).count() == enrich.add_media(log, lookup(spark, "links")).count() == 6000
    assert enrich.add_activity_channel(log, twice, media).count() == 6000


def test_lookup_size_decides_at_run_time(spark):
    """Whether Spark broadcasts the lookup or not, rows are the same; nothing is forced or counted ahead."""
    log = hot_log(spark)
    rows = lambda: _rows(enrich.add_media(log, lookup(spark, "links")).select("event_id", "media_id"))
    want, old = rows(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in _plan(enrich.add_media(log, lookup(spark, "links"))) and rows() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_session_totals(spark):
    row = traffic_totals(hot_log(spark), (("te",),)).collect()[0]
    assert row.open_count == 4001 and row.visitor_count == 51 and row.total_page_count == 6000
    assert row.one_page_count == 4000 and row.new_comer_count == 1


def test_propagation_reaches_all_records_of_a_hot_session(spark):
    marked = enrich.propagate_new_user(hot_log(spark)).filter("ifo = 'true'")
    assert marked.count() == 2000


def test_report_scans_needed_columns_once_per_use(spark, sf_dir):
    log = log_of(spark, sf_dir)
    path_plan = _plan(reports.report("daily_trend", log))
    assert "CartesianProduct" not in path_plan and "BroadcastNestedLoop" not in path_plan
    assert "PythonUDF" not in path_plan and "MapInPandas" not in path_plan


def test_page_views_read_only_their_columns(spark, sf_dir, tmp_path):
    from footfall.operators import metrics
    from footfall.sinks import files
    from footfall.sources import logs

    files.write_log(log_of(spark, sf_dir), str(tmp_path / "log"), files_per_hour=files.FILES_PER_HOUR)
    stored = logs.read_log(spark, str(tmp_path / "log"), log_of(spark, sf_dir).schema)
    plan = _plan(metrics.unique(logs.of_hours(stored, "20240110", "00", "05"), ["ak"], "uu"))
    scan = plan[plan.index("ReadSchema"):]
    assert "struct<ak:string,uu:string>" in scan
    assert "day#" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_required_fields_reach_the_scan(spark, sf_dir, tmp_path):
    from footfall.operators import filters

    log_of(spark, sf_dir).write.parquet(str(tmp_path / "log"))
    plan = _plan(filters.require(spark.read.parquet(str(tmp_path / "log")), "qr").select("ak"))
    pushed = plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
    assert "IsNotNull(ak)" in pushed and "Not(EqualTo(ak,null))" in pushed


def test_lookup_with_hot_link(spark):
    from footfall.operators.enrich import add_media

    links = lookup(spark, "links")
    assert add_media(hot_log(spark), links).count() == 6000
