"""Hand-made rows, one per rule of the normaliser, the filters and the scalar functions."""

import json

import pytest
from pyspark.sql import functions as F

from footfall import schema as S
from footfall.functions import text, times, versions
from footfall.operators import enrich, filters
from footfall.operators.normalize import count_rejects, normalize_log

ET = 1_704_880_800_000  # 2024-01-10 10:00:00 UTC
BASE = {"ak": "a", "at": "s", "uu": "u", "et": str(ET), "ev": "page", "pp": "p", "dr": "5000", "v": "7.3.0", "te": "wx"}


@pytest.fixture(scope="module")
def normalize(spark):
    def run(*records, **options):
        lines = [(i, r if isinstance(r, str) else json.dumps({**BASE, **r})) for i, r in enumerate(records)]
        df = spark.createDataFrame(lines, "i int, value string").withColumn("arrived", F.lit(ET + 86_400_000))
        rows = normalize_log(df, keep=("i",), **options).orderBy("i").collect()
        return [r.asDict() for r in rows]

    return run


def test_malformed_lines_are_dropped_and_counted(spark, normalize):
    bad = ["{not json", "", "[1, 2]", '"text"', '{"ak": "a"']
    assert [r["i"] for r in normalize(*bad, {})] == [5]
    assert normalize("{}") == []
    lines = spark.createDataFrame([(b,) for b in [*bad, "{}", json.dumps(BASE)]], "value string")
    assert count_rejects(lines).collect()[0].asDict() == {"lines": 7, "rejected": 6}


def test_blank_null_and_null_text_are_missing(normalize):
    for value in ("", "  ", "null", None):
        row = normalize({"te": value, "op": value, "img": value, "ifo": value, "v": value})[0]
        assert (row["te"], row["op"], row["img"], row["ifo"], row["v"]) == ("wx", S.NO_OPENID, S.NO_IMG, "false", "7.0.0")


def test_scene_and_path_from_nested_json(normalize):
    wsr = json.dumps({"scene": 1035, "path": "start"})
    own, nested, shared, plain = normalize(
        {"wsr": wsr, "scene": "1001", "path": "own"},
        {"wsr": wsr, "scene": "null"},
        {"wsr": wsr, "ct_path": "share/page?x=1&utm_s=src&y=2", "path": "own"},
        {"wsr": wsr, "ct_path": "share/page", "path": "own"},
    )
    assert (own["scene"], own["path"]) == ("1001", "own")
    assert (nested["scene"], nested["path"]) == ("1035", "start")
    assert (shared["path"], shared["ct_utm_s"]) == ("share/page", "src")
    assert (plain["path"], plain["ct_utm_s"]) == ("share/page", "null")


def test_gender_from_user_info(normalize):
    ufo = json.dumps({"userInfo": json.dumps({"gender": "2", "nickName": "n"})})
    assert [r["gender"] for r in normalize({"ufo": ufo}, {"ufo": "broken", "gender": "1"})] == ["2", "1"]


def test_utm_falls_back_to_qr_and_link(normalize):
    utm = {"wsr_query_utm_s": "us", "wsr_query_utm_m": "um"}
    qr, kept, link, no_medium = normalize(
        {**utm, "scene": "1011"},
        {**utm, "scene": "1011", "qr": "q"},
        {**utm, "scene": "1014"},
        {"wsr_query_utm_s": "us", "scene": "1014"},
    )
    assert (qr["qr"], qr["qr_group"], qr["link_key"]) == ("us", "um", None)
    assert (kept["qr"], kept["qr_group"]) == ("q", None)
    assert (link["link_key"], link["media_id"], link["qr"]) == ("us", "um", None)
    assert no_medium["link_key"] is None


def test_authorisation_only_record_is_kept_but_shows_no_page(normalize):
    row = normalize({"img": "x", "ifo": "true", "dr": "", "ev": "", "pp": "null"})[0]
    assert (row["dr"], row["ev"], row["pp"]) == (0, S.NO_LEVEL, S.NO_PAGE)


def test_stay_units_and_fillers(normalize):
    rows = normalize(
        {"dr": "5999"}, {"dr": "60", "v": "6.9.9"}, {"dr": "x"}, {"dr": "x", "v": "6.9.9"}, {"dr": ""},
        {"dr": "7", "v": "M5.1"}, {"dr": "7000", "v": "10.0.1"},
    )
    stays = [r["dr"] for r in rows]
    assert stays[:3] == [5, 60, 0] and stays[5:] == [7, 7]
    assert all(10 <= s <= 59 for s in stays[3:5])
    assert all(10 <= r["dr"] <= 59 for r in normalize({"dr": "-5000"}, {"dr": "-5", "v": "6.9.9"}))
    again = normalize({}, {}, {}, {"dr": "x", "v": "6.9.9"}, {"dr": ""})
    assert [r["dr"] for r in again][3:5] == stays[3:5]


def test_event_time_units_and_fallback(normalize):
    seconds, broken = normalize({"et": str(ET // 1000)}, {"et": "soon"}, ingest_ms="arrived")
    assert (seconds["et"], seconds["day"], seconds["hour"]) == (ET, "20240110", "10")
    assert broken["day"] == "20240111"
    assert normalize({"et": "soon"})[0]["day"] is None


def test_share_chain(spark):
    df = spark.createDataFrame([("a",), ("a,b,c",), ("",), ("null",), (None,)], "share_src string")
    rows = enrich.add_share_chain(df).collect()
    assert [(r.src, r.layer) for r in rows] == [("a", "1"), ("c", "3"), (None, None), (None, None), (None, None)]


def test_foreign_day_policies(spark):
    df = spark.createDataFrame([(1, ET), (2, ET - 86_400_000)], "i int, et long")
    df = df.withColumns({"day": times.day_of(F.col("et")), "hour": times.hour_of(F.col("et"))})
    job_day = F.lit("20240110")
    stamped = {r.i: (r.day, r.hour) for r in enrich.align_day(df, job_day).collect()}
    assert stamped == {1: ("20240110", "10"), 2: ("20240110", "00")}
    assert [r.i for r in enrich.align_day(df, job_day, "drop").collect()] == [1]
    assert enrich.align_day(df, job_day, "keep").count() == 2
    with pytest.raises(ValueError):
        enrich.align_day(df, job_day, "guess")


def test_versions(spark):
    values = ["6.9.9", "7.0.0", "7.3.0", "10.0.0", "M5.1", "abc", "7.3", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    v = F.col("v")
    rows = df.select("i", versions.is_old_sdk(v), versions.at_least(v, "7.0.0"), versions.is_proper_sdk(v), versions.is_third_party(v)).orderBy("i").collect()
    assert [r[1] for r in rows] == [True, False, False, False, True, False, False, False]
    assert [r[2] for r in rows] == [False, True, True, True, False, False, True, False]
    assert [r[3] for r in rows] == [True, True, True, True, False, False, False, False]
    assert [r[4] for r in rows] == [1, 0, 0, 0, 0, 0, 0, 0]


def test_app_level_is_dropped_from_new_sdks_only(spark):
    df = spark.createDataFrame([("7.0.0", "app"), ("7.0.0", "page"), ("6.0.0", "app")], "v string, ev string")
    assert {tuple(r) for r in filters.without_app_level(df).collect()} == {("7.0.0", "page"), ("6.0.0", "app")}


def test_ratio_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame([(29, 200), (1, 8), (1, 3), (5, 0), (0, 5), (2 * 10**13, 3)], "a long, b long")
    got = [r[0] for r in df.select(text.safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.15, 0.13, 0.33, 0.0, 0.0, 6666666666666.67]


def test_text_functions(spark):
    df = spark.createDataFrame([("https://Ex.COM/a?b=1",), ("no url",), ("",)], "u string")
    rows = df.select(text.url_without_params(F.col("u")), text.lower_host(F.col("u")), text.or_unknown(F.col("u"))).collect()
    assert [tuple(r) for r in rows] == [
        ("https://Ex.COM/a", "ex.com", "https://Ex.COM/a?b=1"), ("no url", None, "no url"), ("", None, "unknown"),
    ]


def test_clock_difference(spark):
    df = spark.createDataFrame([(1_704_880_800, ET + 2999), (1_704_880_800, ET + 3000)], "s long, c long")
    assert [r[0] for r in df.select(times.clock_difference(F.col("s"), F.col("c"))).collect()] == [0, -3000]


def test_required_fields_of_every_family(spark):
    """A row without one of a family's fields goes, and only then."""
    numbers = {"et", "dr"}
    for family, names in filters.REQUIRED.items():
        schema = "missing string, " + ", ".join(f"{n} {'long' if n in numbers else 'string'}" for n in names)
        full = {n: 1 if n in numbers else "x" for n in names}
        rows = [("none", *full.values())]
        for name in names:
            for gap in (None,) if name in numbers else (None, "", "  ", "null"):
                rows.append((name, *{**full, name: gap}.values()))
        kept = filters.require(spark.createDataFrame(rows, schema), family).collect()
        assert [r.missing for r in kept] == ["none"], family


def test_pages_that_show_nothing_are_no_views(spark):
    from footfall.operators.traffic import traffic_totals

    row = {"ak": "a", "day": "d", "att": "s", "uu": "u", "ev": "page", "dr": 1, "ifo": "false"}
    pages = ["p", S.NO_PAGE, "p", "q"]
    log = spark.createDataFrame([(*row.values(), p) for p in pages], "ak string, day string, att string, uu string, ev string, dr long, ifo string, pp string")
    total = traffic_totals(log, ((),)).first()
    assert (total.total_page_count, total.open_count, total.visitor_count) == (3, 1, 1)


def test_scene_groups_of_blank_and_unknown_scenes(spark):
    scenes = spark.createDataFrame([("wx", "1", "g")], "te string, scene_id string, scene_group_id string")
    log = spark.createDataFrame([(i, "wx", s) for i, s in enumerate(["1", " 1 ", "2", "", "null", None])], "i int, te string, scene string")
    rows = {r.i: (r.scene, r.scene_group) for r in enrich.add_scene_group(log, scenes).collect()}
    assert rows[0] == rows[1] == ("1", "g") and rows[2] == (S.OTHER, S.OTHER)
    assert rows[3] == rows[4] == rows[5] == (S.UNKNOWN, S.UNKNOWN)


def test_a_user_and_a_session_id_in_two_apps_count_in_each(spark):
    from footfall.operators.traffic import traffic_totals

    schema = "ak string, day string, att string, uu string, ev string, dr long, ifo string, pp string"
    rows = [("a", "d", "s", "u", "page", 5, "true", "p"), ("b", "d", "s", "u", "page", 7, "false", "p"), ("b", "d", "s", "u", "page", 2, "false", "q")]
    got = {r.ak: r for r in traffic_totals(spark.createDataFrame(rows, schema), ((),)).collect()}
    assert [(got[a].open_count, got[a].visitor_count, got[a].total_stay_time, got[a].one_page_count, got[a].new_comer_count) for a in "ab"] == [(1, 1, 5, 1, 1), (1, 1, 7, 0, 0)]


def test_states_given_to_reports(spark):
    """A user whom the state knows from before the day is not new; one entered on that day still is."""
    from footfall.operators import first_seen
    from footfall.plans import reports
    from footfall.workload.log import lookup

    schema = "ak string, day string, hour string, att string, uu string, op string, ev string, dr long, ifo string, img string, et long, event_id long, v string, pp string, te string, scene string, link_key string, media_id string"
    row = lambda op, i: ("app1", "20240110", "10", f"s{i}", op, op, "page", 5, "true", "img", ET + i, i, "7.3.0", "p", "wx", "1014", "L1", "m")
    log = spark.createDataFrame([row("old", 1), row("today", 2), row("new", 3)], schema)
    state = lambda kind: spark.createDataFrame(
        [("app1", "old", kind, ET - 86_400_000), ("app1", "today", kind, ET)], "ak string, op string, kind string, first_ts long"
    )
    both = state(first_seen.NEW_USER).unionByName(state(first_seen.AUTH))
    home = reports.ad_home(log, lookup(spark, "links"), new_state=both, auth_state=both).first()
    assert (home.visitor_count, home.new_comer_count, home.new_auth_count) == (3, 2, 2)
    assert (home.total_visitor_count, home.total_newer_for_app, home.total_new_auth_user) == (3, 2, 2)
    link = reports.report("daily_link", log, reports.Lookups(links=lookup(spark, "links")), both).first()
    assert link.new_auth_count == 2
    detail = reports.activity_detail(log, lookup(spark, "links"), lookup(spark, "media"), state(first_seen.ACTIVITY)).collect()
    assert {r.openid: r.is_new_user for r in detail} == {"old": 1, "today": 0, "new": 0}
