"""URL filters, chat formatting, mixing."""

import random
import re
from collections import Counter, defaultdict

import checks
import duckdb
import fixtures as f
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import chat_quotes, mixing, queries, url_rules

ODD_URLS = [
    None, "", "no scheme", "http://", "://net/", "HTTP://A.NET/x", "https://www.example.net/en/1?x=/de/", "https://example.net/en",
    "https://example.net/de/#a", "http://net", "http://net/", "http://xnet/", "http://x.net?net/", "https://EXAMPLE.com/de/x", "https://example.com/DE/x",
    "http://m.example.com/de", "ftp://a.b.org/fr/1", "ftp://a.b.org/en/1", "http://org/fr/", "x://y://net/", "http://a.net:80/", "http://spam-farm.example.org/",
    "http://spamfarm.org/", "http://a.adult.io", "http://casino.example.net/en/", "http://x.org/spam/", "http://bad\nhost.net/", "http://ex%61mple.net/", "https://ÄPFEL.net/ü",
]


def brute_verdict(url):
    at = (url or "").find("://")
    rest = re.split(r"[?#]", url[at + 3 :], maxsplit=1)[0] if at >= 0 else ""
    host, slash, path = rest.partition("/")
    host, path = f.lower(host), slash + path
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    fits = []
    for name, verdict in rules:
        h, p = name.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(name), name, verdict))
    if fits:
        return host, path, *max(fits)[1:]
    listed = re.search(r"(^|[.-])(ads|adult|bets|casino|pills|poker|porn|spam|xxx)([.-]|$)", host)
    return host, path, None, "block" if listed else "allow"


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", "y", 1) for i, u in enumerate(ODD_URLS * 2)], "page_id long, url string, host string, _place string, rule int")
    got = url_rules.judge_urls(pages).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [brute_verdict(u) for u in ODD_URLS * 2]
    assert all(r._place == "y" for r in got)
    assert url_rules.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_rules_stand_at_their_rarest_token():
    cells = url_rules.build_index(url_rules.RULES, {"net": 90, "example": 100, "en": 40, "com": 70, "de": 2, "org": 5, "fr": 9})
    at = {r["name"]: r["token"] for cell in cells for r in cell if r["name"]}
    assert at == {"net/": "net", "example.net/en/": "en", "example.com/de/": "de", "org/fr/": "org"}
    with pytest.raises(ValueError):
        url_rules.build_index([url_rules.RULES[0]] * (url_rules.MAX_RULES + 1), {})


def test_many_rules_and_rules_without_a_token(spark):
    rng = random.Random(2)
    names = [f"h{rng.randrange(40)}.io/{rng.choice(['', 'a/', 'a/b', 'c'])}" for _ in range(60)]
    rules = [url_rules.host_rule(rng.choice(["block", "allow"]), n) for n in dict.fromkeys(names)]
    rules += [url_rules.host_rule("block", "bare.io"), url_rules.Rule("block", r"[?]{2}"), url_rules.Rule("block", r"^[^/]*--")]
    urls = [f"http://{rng.choice(['', 'www.', 'x'])}{rng.choice(['bare.io', 'a--b.io', *[f'h{i}.io' for i in range(40)]])}/{rng.choice(['', 'a', 'a/', 'a/bc', 'c/d'])}" for _ in range(400)]
    got = url_rules.judge_urls(spark.createDataFrame([(u,) for u in urls], "url string"), rules).collect()
    for row in got:
        fits = [(len(r.name), r.name, r.action) for r in rules if r.name and re.search(r.regex.replace(r"\z", r"\Z"), row.host + row.path)]
        want = max(fits)[1:] if fits else (None, "block" if "--" in row.host else "allow")
        assert (row.rule, row.verdict) == want


def engine(rows):
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    con = duckdb.connect()
    con.register("conversations", pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema))
    return con


def test_quotes_against_sql(spark, monkeypatch):
    monkeypatch.setattr(chat_quotes, "TURNS", 4)
    rng = random.Random(3)
    lines = ["Hello there", "  hello   THERE ", "ok", "I think so", "What about x > y?", "- a", "Été à", "", "b" * 50]
    rows = []
    for conv in [1, 2, None, 5]:
        texts = []
        for turn in range(30):
            said = []
            for _ in range(rng.randint(0, 3)):
                if texts and rng.random() < 0.7:
                    old = rng.choice(texts[-6:]).split("\n")
                    i = rng.randrange(len(old))
                    said += [rng.choice(["> ", ">", " > "]) + x for x in old[i : i + rng.randint(1, 3)]]
                said.append(rng.choice(lines))
            text = rng.choice(["\n", "\r\n"]).join(said)
            texts.append(text.replace("\r", ""))
            rows += [(conv, turn if rng.random() < 0.97 else None, rng.choice(["user", None]), text if rng.random() < 0.95 else None)] * rng.choice([1, 1, 2])
            if rng.random() < 0.1:
                rows.append((conv, turn, "user", "> ok\nagain"))
    messages = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, _text int, thread string")
    got = chat_quotes.format_chat(messages)
    assert checks.differences(got, engine(rows), queries.ORACLES["op4_chat_formatting"]) is None
    assert got.agg(F.max("depth")).first()[0] > 2


def test_reply_order(spark):
    rows = [
        (1, 0, "user", "How are you?\nAnd the weather?"),
        (1, 1, "assistant", "Something else"),
        (1, 2, "assistant", "> How are  you?\nFine"),
        (1, 3, "user", "> > how are you?\n> Fine\nGood"),
        (1, 4, "user", "> never said\nHm"),
        (1, 5, "user", ">" * 3_000 + " deep\n" + "> a\n" * 20_000 + "end"),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in chat_quotes.format_chat(messages).collect()}
    assert [(got[t].reply_to, got[t].thread, got[t].depth) for t in range(5)] == [(None, 0, 0), (None, 1, 0), (0, 0, 1), (2, 0, 2), (None, 4, 0)]
    assert [got[t].body for t in (2, 3, 4, 5)] == ["Fine", "Good", "Hm", "end"]
    levels = chat_quotes.quote_links(messages).where("turn = 3").orderBy("passage").collect()
    assert [(r.level, r.source) for r in levels] == [(2, 0), (1, 2)]
    text = chat_quotes.conversations(messages).where("thread = 0").first()
    assert text.text == "<|user|>\nHow are you?\nAnd the weather?\n<|assistant|>\nFine\n<|user|>\nGood" and text.n_messages == 3


def test_no_messages(spark):
    assert chat_quotes.format_chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Share, stop those that are full, share the rest again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: unit * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("n", [1, 7, 400])
def test_mix(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice(["b", "a", "é", "Z", None, ""]), None if rng.random() < 0.05 else " w" * int(rng.paretovariate(0.9) % 500)) for i in range(n)]
    rows += [(n, "tiny", "one"), (n + 1, "empty", ""), (n + 2, "empty", None)]
    docs = spark.createDataFrame([(i, t, s, 5, 6, 7.0) for i, s, t in rows], "doc_id long, text string, source string, size int, bins int, target double")
    got = mixing.mix(docs).collect()
    again = Counter(mixing.mix(docs.repartition(5)).collect())
    assert Counter(got) == again
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len(f.words(t))
    want = brute_targets(sizes)
    source = {i: s for i, s, _ in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    assert sorted(r.doc_id for r in got) == sorted(source)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
        if r.size and sizes[s]:  # certain whole copies
            assert r.copies in (int(want[s] / sizes[s] + 1e-9), int(want[s] / sizes[s] + 1e-9) + 1)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_mix_takes_ranks_in_order(spark):
    """The sample is the smallest ranks: random odds over inclusion odds."""
    rng = random.Random(6)
    rows = [(i, "s" if i % 3 else "t", " w" * rng.randint(1, 300)) for i in range(600)]
    docs = spark.createDataFrame([(i, t, s) for i, s, t in rows], "doc_id long, text string, source string")
    size = {i: len(f.words(t)) for i, _, t in rows}
    for s, own in (("s", [i for i, x, _ in rows if x == "s"]), ("t", [i for i, x, _ in rows if x == "t"])):
        got = {r.doc_id: r for r in mixing.mix(docs).collect() if r.doc_id in set(own)}
        target, whole = got[own[0]].target, int(got[own[0]].target / got[own[0]].source_size + 1e-9)
        left = target - whole * got[own[0]].source_size
        weight = {i: size[i].bit_length() for i in own}
        low, high = 0.0, 10.0
        for _ in range(200):  # the scale at which the expected words are the words left
            scale = (low + high) / 2
            low, high = (scale, high) if sum(size[i] * min(1, scale * weight[i]) for i in own) < left else (low, scale)
        uniform = dict(docs.select("doc_id", mixing.uniform("doc_id", "mix")).collect())
        odds = {i: min(1.0, scale * weight[i]) for i in own}
        rank = {i: 0.0 if odds[i] >= 1 - 1e-9 else uniform[i] / (1 - uniform[i]) * (1 - odds[i]) / odds[i] if odds[i] > 0 else 1e300 for i in own}
        more = {i for i in own if got[i].copies > whole}
        if more and len(more) < len(own):
            assert max(rank[i] for i in more) <= min(rank[i] for i in own if i not in more)


def test_unequal_odds_come_true():
    """Over many seeds the share of inclusions is near the odds."""
    rng = random.Random(1)
    odds = [0.2, 0.5, 0.8] * 40
    taken = [0] * len(odds)
    for _ in range(400):
        u = [rng.random() for _ in odds]
        rank = sorted(range(len(odds)), key=lambda i: u[i] / (1 - u[i]) * (1 - odds[i]) / odds[i])
        for i in rank[: round(sum(odds))]:
            taken[i] += 1
    for o in (0.2, 0.5, 0.8):
        share = sum(t for t, x in zip(taken, odds) if x == o) / 400 / 40
        assert abs(share - o) < 0.02


def test_mix_of_repeated_and_keyless_rows(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", "s"), (None, "f", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter([(1, 3), (1, 3), (None, 2), (None, 1)])
    assert mixing.mix(spark.createDataFrame([], f.EMPTY)).collect() == []


@pytest.mark.parametrize("key", [1, 4, None])
def test_mix_of_a_hot_key_comes_near_its_target(spark, monkeypatch, key):
    """Rows of one key are not taken as one lump, and follow the check SQL."""
    monkeypatch.setattr(mixing, "FOLD", 16)
    text = "w w w w w w w w w w"
    rows = [(key, text if i % 3 else text + " w", "a") for i in range(150)] + [(i, text, "ab"[i % 2]) for i in range(100, 220)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    target = {r.source_size: r.target for r in got}
    taken = defaultdict(int)
    for r in got:
        taken[r.source_size] += r.taken
    assert all(abs(taken[s] - target[s]) <= 6 for s in target)
    assert 1 < len({r.copies for r in got if r.doc_id == key}) + len({r.copies for r in got if r.doc_id != key})
    con = duckdb.connect()
    con.register("documents", pa.table({n: [r[i] for r in rows] for i, n in enumerate(docs.columns)}))
    assert checks.differences(mixing.mix(docs), con, queries.ORACLES["op10_mixing"]) is None


def test_rows_that_the_mix_takes(spark):
    """Each row is taken once, with the copies of the mix, whatever keys repeat and columns clash."""
    rng = random.Random(3)
    ids = [rng.choice([None, 7, 7, 8, k]) for k in range(300)]
    texts = [" w" * rng.randint(0, 4) + f" t{k % 50}" * (k % 9 > 0) for k in range(300)]
    docs = f.documents(spark, texts, ids)
    took = mixing.take(docs)
    plan = mixing.mix(docs).where("copies > 0").collect()
    got = took.collect()
    assert took.columns == [*[c for c in docs.columns if c != "size"], *mixing.OUTPUT]
    count = lambda rows: Counter((r.doc_id, r["size"], r.source_size, r.target, r.taken, r.copies) for r in rows)
    assert count(got) == count(plan)
    assert not Counter((r.doc_id, r.text) for r in got) - Counter(zip(ids, texts))
    assert mixing.take(spark.createDataFrame([], f.EMPTY)).collect() == []

