"""Exact, near and suffix dedup against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import fixtures as f
import numpy as np
import pytest

from footfall.llm import exact_dedup, near_dedup, suffix_dedup


@pytest.fixture(scope="module")
def texts():
    return f.odd_texts()


def test_exact_copies(spark, texts):
    ids = [*range(len(texts) - 2), 3, None]  # a repeated key with another text, a null key
    got = exact_dedup.exact_copies(f.documents(spark, texts, ids), salts=3).collect()
    groups = defaultdict(list)
    for i, t in zip(ids, texts):
        groups[t or ""].append(i)
    want = Counter()
    for t, members in groups.items():
        best = max((m for m in members if m is not None), default=None)
        for m in members:
            want[m, best, len(members), m == best, hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got) == want


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "b"), (None, "c"), (None, "c"), (5, None), (6, ""), (7, "a"), (7, "d")]
    docs = f.documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = exact_dedup.deduplicate(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(2, "b"), (None, "c"), (6, ""), (7, "a"), (7, "d")])


def brute_components(ids, texts):
    sets = {i: f.runs(t) for i, t in zip(ids, texts)}
    full = [i for i in ids if sets[i]]
    linked = [
        (a, b) for a in full for b in full if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return sets, f.components(ids, linked)


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 300])
def test_near_copies(spark, texts, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    got = near_dedup.near_copies(f.documents(spark, texts)).collect()
    sets, component = brute_components(range(len(texts)), texts)
    assert sorted(tuple(r) for r in got) == [(i, len(sets[i]), component[i], component[i] == i) for i in range(len(texts))]


def test_chains_and_left_over_links(spark):
    """Members that are linked with each other but not with the star of their buckets."""
    rng = random.Random(5)
    base = " ".join(f"w{i}" for i in range(120))
    texts = [base]
    for _ in range(40):  # a walk: neighbours are close, ends are not
        texts.append(f.near(texts[-1], rng, 3))
    texts += [f.near(base, rng, 7) for _ in range(30)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_copies(f.documents(spark, texts)).collect()}
    assert got == brute_components(range(len(texts)), texts)[1]


def test_near_dedup_of_odd_keys(spark):
    docs = f.documents(spark, ["a b c d e f", "a b c d e f", "a b c d e f", "", None, "z"], [4, None, 4, None, 9, None])
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_copies(docs).collect())
    assert got == Counter({(4, 4, True): 2, (None, 4, False): 1, (None, None, True): 2, (9, 9, True): 1})


def test_near_dedup_of_keys_with_several_texts(spark):
    """Every text of a key keeps its links, and links of any of them are links of the document."""
    rng = random.Random(8)
    bases = [" ".join(f"{c}{i}" for i in range(90)) for c in "abcd"]
    rows = [(1, bases[0]), (1, bases[1]), (2, f.near(bases[1], rng, 1)), (3, f.near(bases[0], rng, 1)), (4, bases[2]), (5, bases[3])]
    rows += [(6, bases[2]), (6, bases[3]), (6, ""), (7, f.near(bases[3], rng, 1)), (8, "alone here")]
    docs = f.documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_copies(docs).collect())
    low = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 4, 8: 8}
    want = Counter((i, len(f.runs(t)), low[i] if t else i, (low[i] if t else i) == i) for i, t in rows)
    assert got == want


def test_near_dedup_of_a_hot_key(spark):
    """A key that many rows with different texts share joins what each of them is linked with."""
    rng = random.Random(9)
    bases = [" ".join(f"{k}w{i}" for i in range(40)) for k in range(30)]
    rows = [(50, t) for t in bases] + [(k, f.near(t, rng, 1)) for k, t in enumerate(bases)]
    got = {r.component_id for r in near_dedup.near_copies(f.documents(spark, [t for _, t in rows], [i for i, _ in rows])).collect()}
    assert got == {0}


def test_long_words_are_told_apart(spark):
    """The Thue-Morse word and its complement agree in every polynomial modulo 2^64."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << 12))
    other = word.translate(str.maketrans("ab", "ba"))
    texts = [word, other, f" {word.upper()}\n", "a" * 64, "A" * 64, "a" * 65, "A" * 65 + " ", "a" * 66]
    got = {r.doc_id: r.component_id for r in near_dedup.near_copies(f.documents(spark, texts)).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 3, 4: 3, 5: 5, 6: 5, 7: 7}


def test_half_keys_are_tensored():
    sets = [np.arange(i, i + 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in (0, 5, 10_000)]
    keys = near_dedup._half_keys(near_dedup._signed(sets))
    assert keys.shape == (3, 2 * near_dedup.SIDE)
    assert (keys[0] == keys[1]).mean() > 0.5 and not (keys[0] == keys[2]).any()
    sketches = np.array([np.frombuffer(near_dedup._sketch(np.sort(s)), np.uint8) for s in sets])
    assert near_dedup._alike(sketches[0], sketches[1]) and not near_dedup._alike(sketches[0], sketches[2])


def brute_spans(texts, span):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + span] for b in data for i in range(len(b) - span + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = True
        edges = np.flatnonzero(np.diff(np.append(False, gone).astype(int))).tolist()
        spans = list(zip(edges[::2], edges[1::2]))
        out.append((len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("bucket, heavy", [(100_000, 5_000), (40, 2)])
def test_suffix_dedup(spark, monkeypatch, bucket, heavy):
    import random

    rng = random.Random(bucket)
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    monkeypatch.setattr(suffix_dedup, "HEAVY", heavy)
    parts = ["".join(rng.choice("abé") for _ in range(rng.randint(10, 60))) for _ in range(6)]
    texts = ["".join(rng.choice([*parts, str(rng.random())]) for _ in range(rng.randint(0, 6))) for _ in range(60)]
    texts += [None, "", "a" * 300, "ab" * 200, texts[5], texts[5], "x" * 19, "x" * 20]
    ids = [*range(len(texts) - 1), None]
    got = suffix_dedup.suffix_dedup(f.documents(spark, texts, ids), span=20, gram=8).collect()
    want = {i: x for i, x in zip(ids, brute_spans(texts, 20))}
    assert {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got} == want


def test_suffixes_of_cut_texts_cover_every_window(monkeypatch):
    """Blocks smaller than a text: each window has one anchor, as far into it as elsewhere."""
    import pyarrow as pa

    rng = np.random.RandomState(2)
    text = bytes(rng.randint(97, 100, 3000).astype(np.uint8))
    whole, cut = {}, {}
    for size, out in ((1 << 19, whole), (250, cut)):
        monkeypatch.setattr(suffix_dedup, "_BLOCK", size)
        for data, rows, ends, shifts in suffix_dedup._blocks(pa.array([b"", text, None], pa.binary()), 50):
            _, _, piece, anchor, first, last = suffix_dedup.suffixes(data, ends, 50, 20)
            back = (shifts - np.append(0, ends[:-1]))[piece]
            for a, x, y in zip(anchor + back, first + back, last + back):
                for window in range(x, y + 1):
                    assert window not in out
                    out[window] = a
    assert whole == cut and sorted(whole) == list(range(2951))


def test_suffixes_do_not_depend_on_the_texts_before():
    pa = pytest.importorskip("pyarrow")
    rng = np.random.RandomState(6)
    texts = [rng.randint(97, 123, n, np.uint8).tobytes() for n in (1 << 19, (1 << 19) + 700)]
    blocks = list(suffix_dedup._blocks(pa.array(texts, pa.binary()), 200))
    assert max(len(data) for data, *_ in blocks) < 1 << 20

    def found(blocks, refs):
        out = set()
        for data, rows, ends, shifts in blocks:
            token, body, piece, *places = suffix_dedup.suffixes(data, ends, 200, 100)
            back = (shifts - np.append(0, ends[:-1]))[piece]
            out |= set(zip(*(x.tolist() for x in (token, body, np.array(refs)[np.array(rows)[piece]], *(p + back for p in places)))))
        return out

    alone = [found(suffix_dedup._blocks(pa.array([t], pa.binary()), 200), [k]) for k, t in enumerate(texts)]
    assert found(blocks, [0, 1]) == alone[0] | alone[1]


def test_multikey_order_and_buckets():
    rng = np.random.RandomState(4)
    keys = [rng.randint(0, 4, 500).astype(np.uint64) for _ in range(3)]
    order = suffix_dedup.multikey_order(*keys)
    rows = list(zip(*(k.tolist() for k in keys)))
    assert [rows[i] for i in order] == sorted(rows)
    splitters = sorted(rows)[::60]
    parts = [np.array([s[i] for s in splitters], np.uint64) for i in range(3)]
    assert suffix_dedup.bucket_of(keys, parts).tolist() == [sum(s <= r for s in splitters) for r in rows]


@pytest.mark.parametrize("run", [exact_dedup.exact_copies, near_dedup.near_copies, suffix_dedup.suffix_dedup, exact_dedup.deduplicate, near_dedup.deduplicate])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], f.EMPTY)).collect() == []
