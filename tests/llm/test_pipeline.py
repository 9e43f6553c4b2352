"""Each stage on all its predecessor kept, against brute force."""

import random

import corpus_pipeline
import fixtures as f
import pytest

from footfall.llm import language_id


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with copies, near copies, leaks, junk and further columns; a benchmark."""
    rng = random.Random(12)
    out = str(tmp_path_factory.mktemp("tables"))
    stems = {"en": "the and thing house with from street", "de": "der und nicht schön straße über haus"}
    prose = lambda lang, n: " ".join(rng.choice(stems[lang].split()) + rng.choice(["", "s", "en"]) + str(rng.randrange(50)) for _ in range(n))
    items = [(i, prose("en", 30)) for i in range(5)]
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "de"])
        rows.append((i, prose(lang, rng.randint(20, 90)), lang, rng.choice(["a", "b", None])))
    for i in range(40):
        _, text, lang, source = rng.choice(rows[:120])
        rows.append((200 + i, text if i % 2 else f.near(text, rng, 1), lang, source))
    rows += [(300 + i, prose("en", 20) + " " + t + " " + prose("en", 20), "en", "b") for i, t in items]
    rows += [(400, None, "en", "a"), (401, "", "en", "a"), (402, "1234 !!", "de", "b"), (7, rows[7][1], *rows[7][2:])]
    docs = [(i, t, x, s, None if t is None else len(t), 1, "c") for i, t, x, s in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, _gone string"
    spark.createDataFrame(docs, schema).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first, columns = docs, docs.columns
    plain = lambda df: sorted((r.doc_id, r.text) for r in df.collect())

    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    docs = corpus_pipeline.STAGES[0][1](spark, docs, folder)
    want = sorted((r.doc_id, r.text) for r in first.collect() if found[r.doc_id][0] != "und" and found[r.doc_id][1] >= 0.5)
    assert docs.columns == columns and plain(docs) == want
    assert {400, 401, 402}.isdisjoint(i for i, _ in want) and len(want) >= 160  # clean documents stay

    docs = corpus_pipeline.STAGES[1][1](spark, docs, folder)
    want = sorted({max(i for i, t in want if t == text): text for _, text in want}.items())
    assert docs.columns == columns and plain(docs) == want

    docs = corpus_pipeline.STAGES[2][1](spark, docs, folder)
    sets = {i: f.runs(t) for i, t in want}
    linked = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    low = f.components(list(sets), linked)
    want = [(i, t) for i, t in want if low[i] == i]
    assert linked and docs.columns == columns and plain(docs) == want

    docs = corpus_pipeline.STAGES[3][1](spark, docs, folder)
    items = [f.runs(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaked = {i for i, t in want if any(len(x & f.runs(t)) >= 0.75 * len(x) for x in items)}
    want = [(i, t) for i, t in want if i not in leaked]
    assert leaked and docs.columns == columns and plain(docs) == want

    mixed = corpus_pipeline.STAGES[4][1](spark, docs, folder).collect()
    assert {(r.doc_id, r.text) for r in mixed} <= set(want) and len(mixed) == len({r.doc_id for r in mixed})
    assert all(r.taken == r.copies * r.size > 0 and r.size == len(f.words(r.text)) for r in mixed)
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.copies) for r in whole) == sorted((r.doc_id, r.copies) for r in mixed)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], f.EMPTY).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
