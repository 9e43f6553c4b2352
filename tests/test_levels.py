"""Several rollup levels: what moves, and totals by blocks against a plain count."""

import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from footfall.operators import levels as lv
from footfall.operators.traffic import MEASURES, cube_levels, totals_of, traffic_partials

DIMS = ["x", "y"]
LEVELS = cube_levels(("x", "y"))
SCHEMA = pa.schema([(c, pa.string()) for c in ("ak", "day", *DIMS, "kind", "id", "pp")] + [("pv", pa.int64()), ("stay", pa.int64()), ("is_new", pa.int32()), ("auth_first", pa.int64())])


def entries(seed):
    """Rows in order of (day, id), one identity with most of them, some marked, with nulls."""
    pick, rows = random.Random(seed), []
    for _ in range(400):
        kind = pick.choice([lv.SESSION, lv.SESSION, lv.VISITOR, lv.AUTH])
        row = {"ak": pick.choice("ab"), "day": pick.choice(["d1", "d2", None]), "x": pick.choice(["1", "2", None]), "y": pick.choice("pqr"), "kind": kind, "id": pick.choice(["hot", "hot", "s1", "s2", "s3"])}
        real = kind == lv.SESSION
        row |= {"pp": pick.choice(["p1", "p2", None]) if real else None, "pv": pick.randint(0, 3) if real else None, "stay": pick.choice([None, 0, 5, 9]) if real else None}
        rows.append(row | {"is_new": pick.choice([0, 0, 1, None]) if real else None, "auth_first": pick.randint(0, 1) if real else None})
    rows += [dict.fromkeys(SCHEMA.names) | {"day": "d1", "id": i, "kind": lv.MARK} for i in ("s1", "none")]
    return sorted(rows, key=lambda r: (r["day"] or "", r["id"]))


def plain(rows):
    marks = {(r["day"], r["id"]) for r in rows if r["kind"] == lv.MARK}
    out = defaultdict(Counter)
    for n, level in enumerate(LEVELS):
        ids = defaultdict(list)
        for r in rows:
            if r["kind"] != lv.MARK:
                ids[r["ak"], r["day"], *[r[d] if d in level else None for d in DIMS], n, r["kind"], r["id"]].append(r)
        for (*group, kind, name), own in ids.items():
            real = kind == lv.SESSION
            most = lambda c: max((r[c] for r in own if r[c] is not None), default=0)  # noqa: B023, E731
            out[tuple(group)].update({
                "new_comer_count": max(most("is_new"), real and (group[1], name) in marks), "visitor_count": kind == lv.VISITOR, "open_count": real,
                "total_page_count": sum(r["pv"] or 0 for r in own), "total_stay_time": most("stay"), "old_auth": kind == lv.AUTH,
                "one_page_count": len({r["pp"] for r in own} - {None}) == 1, "first_auth": sum(r["auth_first"] or 0 for r in own),
            })
    return {k: [int(v[c]) for c in lv.COUNTS] for k, v in out.items()}


@pytest.mark.parametrize("block", [7, 50, 100_000])
def test_blocks_give_the_plain_totals(monkeypatch, block):
    """Identities longer than a block, and batches that end inside one, are counted once."""
    monkeypatch.setattr(lv, "BLOCK", block)
    rows = entries(block)
    batches = pa.Table.from_pylist(rows, SCHEMA).to_batches(max_chunksize=5)
    out = defaultdict(lambda: [0] * len(lv.COUNTS))
    for batch in lv.level_totals(["ak", "day"], DIMS, LEVELS, MEASURES)(iter(batches)):
        for r in batch.to_pylist():
            key = (r["ak"], r["day"], r["x"], r["y"], r["_level"])
            out[key] = [a + r[c] for a, c in zip(out[key], lv.COUNTS, strict=True)]
    assert dict(out) == plain(rows)


def test_large_codes_stay_apart():
    big = [pa.array([0, 1, 2, 3]).to_numpy() + (1 << 30)] * 3
    assert len(set(lv._joint(big).tolist())) == 4


def test_levels_repeat_nothing_that_moves(spark):
    """Partials of many levels have a row per record at most, and only totals per value move after that."""
    log = spark.range(2000).selectExpr(
        "id as event_id", "'app1' as ak", "'20240110' as day", "concat('s', id) as att", "concat('u', id) as uu", "'p' as pp", "id as et",
        "'page' as ev", "1L as dr", "'false' as ifo", *[f"cast(id % {n} as string) as d{n}" for n in (2, 3, 5, 7)],
    )
    levels = cube_levels(("d2", "d3", "d5", "d7"))
    partials = traffic_partials(log, levels)
    assert partials.count() == 2000
    rows = totals_of(partials, levels).collect()
    assert len(rows) == 3 * 4 * 6 * 8 and {r.level for r in rows} >= {"app", "d2+d3+d5+d7"}
    assert sum(r.open_count for r in rows) == sum(r.visitor_count for r in rows) == 16 * 2000


def test_stream_keeps_only_the_columns_of_its_report(spark, tmp_path):
    from footfall.streaming import ingest, reports

    spark.range(5).selectExpr("id as event_id", "'app1' as ak", "'x' as wide").write.parquet(str(tmp_path / "in"))
    source = ingest.file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    seen = []
    writer = reports.each_batch(source, None, reports.ReportTables(str(tmp_path), "r"), lambda b, _: seen.append((b.columns, b.count())), ["ak", "event_id", "other"])
    ingest.run_available(writer, str(tmp_path / "checkpoint"))
    assert {tuple(c) for c, _ in seen} == {("ak", "event_id")} and sum(n for _, n in seen) == 5
