"""Conversation repair, source divergence and HTML extraction; language ID written out."""

import hashlib
import itertools
import math
import random
import re
import unicodedata
from collections import Counter

import checks
import duckdb
import fixtures as f
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import block_crf, conversation_repair, html_extraction, language_id, page_layouts, queries, source_divergence
from footfall.llm.html_blocks import Block, Element, leaf_blocks
from footfall.llm.repair_grammar import Solver, encode, join, leaf, pair_counts, precedes

CHATS = "conv_id long, turn long, role string, text string"
CHAT_TYPES = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def view(name, rows, schema):
    con = duckdb.connect()
    con.register(name, pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema))
    return con


# -- conversations ---------------------------------------------------------------------------


def cheapest(symbols):
    """All edit scripts with at most two insertions in each gap."""
    best = None
    for kept in itertools.product("KRD", repeat=len(symbols)):
        if any(x == "x" and op != "D" for x, op in zip(symbols, kept)):
            continue
        for gaps in itertools.product(range(3), repeat=len(symbols) + 1):
            edits, shown, cost = "I" * gaps[0], ["?"] * gaps[0], 3 * sum(gaps)
            for x, op, gap in zip(symbols, kept, gaps[1:]):
                edits += op + "I" * gap
                cost += {"K": 0, "R": 3, "D": 4}[op] + (3 if x.isupper() and op != "D" else 0)
                shown += ([x.lower()] if op == "K" else ["?"] if op == "R" else []) + ["?"] * gap
            # What is inserted or given a new role is a user's or an assistant's, whichever fits.
            body = shown[1:] if shown[:1] == ["s"] else shown
            alone = shown[:1] == ["s"] and not body
            if len(body) % 2 == 0 and not alone and all(x in ("?", "ua"[i % 2]) for i, x in enumerate(body)):
                best = min(best or (cost, edits), (cost, edits))
    return best


def test_repairs_against_all_scripts():
    rng = random.Random(4)
    plain = Solver([])
    for _ in range(60):
        symbols = "".join(rng.choice("ssuuaaoSUAOxx") for _ in range(rng.randint(0, 4)))
        assert plain.solve(symbols) == cheapest(symbols), symbols


def test_a_grammar_changes_nothing():
    rng = random.Random(5)
    texts = ["".join(rng.choice("uauauaUAsxo") for _ in range(rng.randint(0, 300))) for _ in range(40)] + ["ua" * 5_000, "x" * 3_000, "uu" * 400]
    rules = []
    for _ in range(3):
        rules += [p for p, n in pair_counts(encode(t, rules) for t in texts).most_common(9) if n > 1]
    assert len(encode("ua" * 5_000, rules)) < 3_000
    first, second = Solver([]), Solver(rules)
    for text in texts:
        assert first.solve(text) == second.solve(text)


def test_ropes_compare_as_strings():
    rng = random.Random(6)
    made = [(leaf(c), c) for c in "DIKR"]
    for _ in range(300):
        (a, x), (b, y) = rng.choice(made), rng.choice(made)
        if len(x) + len(y) < 40:
            made.append((join(a, b), x + y))
    for _ in range(3_000):
        (a, x), (b, y) = rng.choice(made), rng.choice(made)
        assert str(a) == x and precedes(a, b) == (x < y)


ODD_CHATS = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Hi there"), (1, 1, "assistant", "Hi there"), (1, 5, "user", "Hello."), (1, 3, None, "?"),
    (2, None, "user", "a."), (2, None, "system", "b."), (2, 7, "assistant", None), (2, 8, "", "No role."), (2, 9, "Übel", "c!\x0b "),
    (None, 0, "user", "no key."), (None, 1, "assistant", "no key!"), (None, None, "user", ""), (3, 0, "system", "only."),
    (4, -5, "unknown", "x" * 100_000), (4, 2, "assistant", " "), (5, 0, "user", "\t\n"), (6, 1, "user", "one: two\nthree."),
]


@pytest.fixture(scope="module")
def chats():
    rng = random.Random(7)
    rows = list(ODD_CHATS)
    for conv in range(10, 90):
        for turn in range(rng.randint(1, 9)):
            text = rng.choice(["Yes.", "No", "", "Why? ", "Fine!\n", f"Text {rng.randrange(9)}."])
            rows.append((conv, turn + rng.choice([0, 0, 1, 4]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), text))
    rows += [(7, i % 60, ("user", "assistant")[i % 2], f"{i % 50}.") for i in range(120)]  # long, with repeats
    return list(dict.fromkeys(rows)) + rows[:4]


def test_repair_against_sql(spark, chats, monkeypatch):
    monkeypatch.setattr(conversation_repair, "BLOCK", 7)
    con = view("conversations", chats, CHAT_TYPES)
    rows = spark.createDataFrame([(*r, 1, "z", "x") for r in chats], CHATS + ", copies int, text_sha256 string, audit string").repartition(5)
    got = conversation_repair.audit_report(conversation_repair.damaged(rows), F.col("copies"))
    sql = queries.ORACLES["op11_conversation_structure_repair"]
    assert checks.differences(got, con, sql) is None


def test_repaired_messages(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 3, "user", "Hi?"), (1, 4, "assistant", "Yes"), (2, 0, "assistant", "")]
    audits, messages = conversation_repair.repair(spark.createDataFrame(rows, CHATS))
    found = {r.conv_id: r for r in audits.collect()}
    assert (found[1].audit, found[1].cost, found[1].gaps, found[1].truncated, found[1].illegal) == ("KKIKK", 6, 1, 1, 1)
    assert (found[2].audit, found[2].cost, found[2].blank) == ("D", 4, 1)
    said = [(r.place, r.edit, r.role, r.text) for r in messages.orderBy("place").collect()]
    assert said == [(1, "K", "system", "Be brief."), (2, "K", "user", "Hi."), (3, "I", "assistant", ""), (4, "K", "user", "Hi?"), (5, "K", "assistant", "Yes")]
    digest = {r.conv_id: r.repaired_sha256 for r in conversation_repair.digests(messages).collect()}
    assert digest == {1: hashlib.sha256(b"system:Be brief.\nuser:Hi.\nassistant:\nuser:Hi?\nassistant:Yes").hexdigest()}


def test_repair_of_nothing_and_of_lost_rows(spark):
    empty = spark.createDataFrame([], CHATS)
    assert conversation_repair.audit_report(empty).count() == 0
    lost = conversation_repair.audit_report(spark.createDataFrame([(1, 4, "user", "a.")], CHATS), F.lit(0)).collect()
    assert [tuple(r) for r in lost] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# -- divergence -------------------------------------------------------------------------------

DOC_TYPES = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string())])


@pytest.fixture(scope="module")
def audited():
    rng = random.Random(8)
    words = [w + x for w in ["The", "a", "été", "文字", "O'Neill", "x-y", "\x7f", "naïve2go"] for x in ["", "s", "En"]]
    rows = [(i, " ".join(rng.choices(words, range(len(words), 0, -1), k=rng.randint(0, 40))), rng.choice(["en", "de", None]), rng.choice(["a", "b", None, "ü"])) for i in range(150)]
    rows += [(900, None, "fr", "a"), (901, "", "fr", "b"), (902, "rare only", "fr", None), (903, "the " * 50_000, "en", "a"), (5, rows[5][1], "en", "b"), (None, "the", "en", "c"), (904, "THE", "", "")]
    return rows


def test_divergence_against_sql(spark, audited):
    con = view("documents", audited, DOC_TYPES)
    docs = spark.createDataFrame([(*r, 1, 2, "p") for r in audited], f.EMPTY.replace(", n_chars long", "") + ", count int, place int, term string")
    got = source_divergence.divergence(docs, min_docs=5)
    assert checks.differences(got, con, queries.ORACLES["op12_source_divergence_audit"].replace(">= 30", ">= 5")) is None
    assert got.where("part = 'term'").count() > 10


def test_divergence_of_few_cells_and_of_nothing(spark, audited, monkeypatch):
    docs = spark.createDataFrame(audited, f.EMPTY.replace(", n_chars long", ""))
    whole = sorted(map(tuple, source_divergence.divergence(docs, min_docs=5).collect()))
    monkeypatch.setattr(source_divergence, "CELLS", 8)
    assert sorted(map(tuple, source_divergence.divergence(docs, min_docs=5).collect())) == whole
    assert source_divergence.divergence(docs.limit(0)).count() == 0
    bare = source_divergence.divergence(docs.where("lang = 'fr'"), min_docs=5).collect()
    assert len(bare) == 6 and {(r.part, r.value) for r in bare} == {("pair", 0)}


# -- pages ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labeller():
    return block_crf.Labeller(html_extraction.default_model())


def test_labels_of_pages_not_learned_from(labeller):
    right = total = 0
    for html, truth in page_layouts.labelled_pages(400, 99):
        for rows, labels in block_crf._examples([(html, truth)]):
            got = labeller.labels(leaf_blocks(html))
            right += sum(a == b for a, b in zip(got, labels))
            total += len(rows)
    assert right / total >= 0.985


def test_decoding_against_all_labellings(labeller):
    rng = random.Random(9)
    model = labeller.model
    for _ in range(40):
        html, _ = page_layouts.labelled_page(rng)
        blocks = rng.sample(leaf_blocks(html), k=min(7, len(leaf_blocks(html))))
        if not blocks:
            continue
        scores = [labeller.score(b) for b in blocks]

        def value(labels):
            total = sum(s for s, x in zip(scores, labels) if x) + labels[0] * model.first + labels[-1] * model.last  # noqa: B023
            return total + sum(model.steps[a][b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product([0, 1], repeat=len(blocks)), key=value)
        assert value(labeller.labels(blocks)) == pytest.approx(value(best))


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{margin:0}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Home<li><a href="/y">News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. Read our policy to learn more about them.</p><form><button>OK</button></form></div>
<article><h1>Title &amp; more &am</h1><p><b>First   para&shy;graph.<br><p>Second\none &lt;b&gt; &#233;&eacute; a < b.</p>
<aside><h3>Related</h3><a href="/1">Other story</a></aside><ul><li>Point<li>Another</ul><p></p><script>var t = "</p>";</script><!-- <p>gone</p> -->
<p title="a > b">Third</p></article>
<section class="comments"><h3>Comments</h3><article class="comment"><p>I liked this article very much, thank you for it.</p></article></section>
<div class="sidebar"><p>Popular</p></div><footer>&copy; 2024 Someone &middot; All rights reserved.</footer></body></html>"""


def test_page(labeller):
    want = ["Title & more &am", "First para­graph.", "Second one <b> éé a < b.", "Point", "Another", "Third"]
    assert html_extraction.main_text(PAGE, labeller).split("\n") == want


def test_blocks_of_odd_markup():
    texts = lambda html: [b.text for b in leaf_blocks(html)]
    assert texts("") == texts("<p></p><br>") == texts("<script>x") == texts("<!-- x") == []
    assert texts("a<p>b<p>c<div>d</div>e") == ["a", "b", "c", "d", "e"]
    assert texts("x <i>y</i>z<br>w &nbsp; v") == ["x yz w v"]
    assert texts("1 < 2 <p>3 > 2 <3</p></nope></p>") == ["1 < 2", "3 > 2 <3"]
    assert texts("<p title='it>s'>q</p><p it's>r</p><P CLASS=a>S</P>") == ["q", "r", "S"]
    assert texts("<p>cut <b") == ["cut <b"] and texts("<SCRIPT>a</p></script >b") == ["b"]
    assert texts("&amp;lt; &ampx &#x1F600;") == ["&lt; &x 😀"]
    table = leaf_blocks("<table><tr><td>a<td><div>b</div><tr><td>c</table>d")
    assert [(b.text, [e.tag for e in b.path]) for b in table] == [("a", ["table", "tr", "td"]), ("b", ["table", "tr", "td", "div"]), ("c", ["table", "tr", "td"]), ("d", [])]
    nested = leaf_blocks("<div id='x'>" * 3_000 + "deep")
    assert nested == [Block("deep", (Element("div", ("x",)),) * 3_000, 0)]
    assert len(texts("<p>" + "word " * 200_000)[0]) == 999_999


def plain_article(html):
    """The article of the given tables' layout, by patterns."""
    import html as h

    inner = re.search(r"(?s)<article>(.*?)</article>", html or "")
    parts = re.split(r"</?(?:h1|p)>", inner[1]) if inner else []
    return "\n".join(x for x in (" ".join(h.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts) if x)


def test_pages_table(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op13_html_extraction(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert (row.url, row.text) == (pages[row.page_id].url, plain_article(pages[row.page_id].html)) and row.n_chars == len(row.text)


def test_extraction_of_odd_rows(spark):
    rows = [(1, None, "a", "t"), (2, "", "b", "t"), (3, PAGE, "c", "t"), (3, PAGE, "c", "t"), (4, "<nav><a href=x>Home</a></nav>", "d", "t")]
    got = html_extraction.extract(spark.createDataFrame(rows, "page_id long, html string, _found string, text string"))
    assert got.columns == ["page_id", "html", "_found", "text", "n_chars"]
    texts = {(r.page_id, r._found): r.text for r in got.collect()}
    assert texts[1, "a"] == texts[2, "b"] == texts[4, "d"] == "" and texts[3, "c"].startswith("Title")
    assert html_extraction.extract(spark.createDataFrame([], "html string")).count() == 0


# -- language ID, written out ------------------------------------------------------------------


def plain_buckets(text):
    mask, factors = (1 << 32) - 1, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
    for n in (1, 2, 3):
        for at in range(len(text) - n + 1):
            mixed = n
            for k in range(n):
                mixed = (mixed ^ ord(text[at + k])) * factors[k] & mask
            mixed ^= mixed >> 15
            yield (mixed * factors[0] & mask) >> 16


def test_language_id_against_plain_naive_bayes(spark):
    rng = random.Random(10)
    stems = {"en": "the thing with house", "de": "der nicht schön straße", "fr": "été garçon où là"}
    rows = [(i, " ".join(rng.choice(stems[x].split()) + str(rng.randrange(9)) for _ in range(rng.randint(1, 12))), x) for i in range(90) for x in [rng.choice(list(stems))]]
    rows += [(200, None, "en"), (201, "½ ① ² Ⅷ 12 !?", "de"), (202, "", None), (203, "Été", None), (None, "The", "en"), (204, "文" * 9_000, "fr"), (5, rows[5][1], None)]
    counts = {x: Counter() for x in stems}
    for i, text, lang in rows:
        if f.crc(i) % 4 != 2 and lang and text and any(unicodedata.category(c)[0] == "L" for c in text):
            counts[lang].update(plain_buckets(text.lower()))
    got = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = Counter()
    for row in language_id.identify(got).collect():
        text = row.text or ""
        assert row.held_out == (f.crc(row.doc_id) % 4 == 2)
        if not any(unicodedata.category(c)[0] == "L" for c in text):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        grams = list(plain_buckets(text.lower()))
        logs = {x: sum(math.log((c[b] + 0.5) / (c.total() + 0.5 * 65536)) for b in grams) for x, c in sorted(counts.items())}
        best = max(logs, key=logs.get)
        assert row.lang_pred == best and row.score == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs.values()), abs=1e-3)
        found[best] += 1
    assert len(found) == 3
