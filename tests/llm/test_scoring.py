"""Language ID, token counts, language-model scores, decontamination."""

import math
import random
from collections import Counter

import fixtures as f
import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import decontamination, language_id, lm_scoring, token_counts
from footfall.llm.elias_fano import EliasFano
from footfall.llm.words import word_blocks
import footfall.llm.words as words_module

tokenizers = pytest.importorskip("public_tokenizers")
MODEL = tokenizers.path(token_counts.MODEL)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_words_are_those_of_the_pattern(monkeypatch):
    monkeypatch.setattr(words_module, "BLOCK", 64)
    rng, seen = random.Random(3), {}
    for _ in range(300):
        texts = [
            None if rng.random() < 0.1 else "".join(rng.choice(["a", "B", "é", " ", "\n", "\x0b", "cd", "x" * 30, "\xa0"]) for _ in range(rng.choice([0, 1, 9, 90])))
            for _ in range(rng.randint(0, 8))
        ]
        for row, hashes, bounds in word_blocks(pa.array(texts, pa.string())):
            for k in range(len(bounds) - 1):
                own = hashes[bounds[k] : bounds[k + 1]].tolist()
                plain = f.words(texts[row + k])
                assert len(own) == len(plain)
                assert all(seen.setdefault(w, h) == h for w, h in zip(plain, own))
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("chunk", [1 << 16, 7])
def test_transducer_counts_as_the_library(library, monkeypatch, chunk):
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    transducer = token_counts.transducer_of(MODEL)
    rng = random.Random(chunk)
    parts = ["a", "the", "ing", "er", " ", "  ", "▁", "\n", "\t", "é", "日", "😀", "-", "----", "=", "1", "\x00", "<s>", "<0x0A>", "ß", "A"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert transducer.count(text) == len(library.encode(text)), text


def test_maps_compose_in_any_grouping():
    transducer = token_counts.transducer_of(MODEL)
    text = " the quick\nbrown" + "abc" * 20 + " fox  jumps"
    maps = [transducer.chunk_map(text[i : i + 5]) for i in range(0, len(text), 5)]
    left = maps[0]
    for m in maps[1:]:
        left = transducer.compose(left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = transducer.compose(m, right)
    assert left == right


def test_token_counts(spark, library):
    texts = f.odd_texts()
    got = {r.doc_id: r for r in token_counts.count_tokens(f.documents(spark, texts), MODEL).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 4096)


def test_elias_fano():
    rng = np.random.RandomState(1)
    for n, top in [(0, 10), (1, 5), (5, 6), (100, 150), (1000, 1 << 20), (1000, 1 << 62), (5000, 1 << 40)]:
        values = np.sort(rng.randint(0, top, n).astype(np.uint64))
        for universe in (None, top):
            code = EliasFano(EliasFano.encode(values, universe))
            assert (code.decode() == values).all()
            asked = np.concatenate([values, rng.randint(0, top, 200).astype(np.uint64), np.array([0, 2**63], np.uint64)])
            found = code.find(asked)
            place = np.searchsorted(values, asked)
            there = (place < n) & (values[np.minimum(place, n - 1)] == asked) if n else np.zeros(len(asked), bool)
            assert (found == np.where(there, place, -1)).all()
            if n:
                places = rng.randint(0, n, 50)
                assert (code.access(places) == values[places]).all()
                assert (code.find(values[places], places + 1, np.full(50, n)) != places).all()


@pytest.mark.parametrize("size", [1 << 24, 20_000])
def test_language_model(spark, monkeypatch, size):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", size)
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", size)
    texts = f.odd_texts()
    ids = [*range(len(texts) - 1), None]
    got = {r.doc_id: r for r in lm_scoring.score_texts(f.documents(spark, texts, ids)).collect()}
    tokens = {i: [*f.words(t), "\n"] for i, t in zip(ids, texts)}
    single, pairs = Counter(), Counter()
    for i, found in tokens.items():
        if f.crc(i) % 7 != 2:
            single.update(found)
            pairs.update(zip(["\n", *found], found))
    n, v, follow = sum(single.values()), len(single), Counter(a for a, _ in pairs)
    for i, found in tokens.items():
        base = score = 0.0
        for a, b in zip(["\n", *found], found):
            one = (single[b] + 1) / (n + v + 1)
            base += math.log10(one)
            direct = max(pairs[a, b] - lm_scoring.DISCOUNT, 0) / single[a] if single[a] else 0
            score += math.log10(direct + (min(1, lm_scoring.DISCOUNT * follow[a] / single[a]) if single[a] else 1) * one)
        row = got[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (f.crc(i) % 7 == 2, len(found), sum(single[w] > 0 for w in found), n)
        assert math.isclose(row.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
        # quantised down, by one step at most per token
        assert score - lm_scoring.STEP * len(found) - 1e-6 <= row.score <= score + 1e-6


def test_trie_rounds_down_and_finds_successors():
    words = np.array([3, 9, 1 << 50], np.uint64)
    pairs = np.array([5, (1 << 28) | 5, (1 << 28) | 7], np.uint64)
    trie = lm_scoring.Trie.build(words, np.array([10, 8, 0]), pairs, np.array([10, 3, 5]))
    codes = trie.successor(np.array([0, 1, 1, 2, 0]), np.array([5, 7, 6, 5, 7], np.uint64))
    chances = np.where(codes > 0, 10.0 ** (-(codes.astype(float) - 1) * lm_scoring.STEP), 0)
    for got, exact in zip(chances, [9.25 / 10, 4.25 / 8, 0, 0, 0]):
        assert exact * 10**-lm_scoring.STEP * 0.999 <= got <= exact


def test_probabilities_of_very_frequent_contexts_are_not_raised():
    times, n = 10**9, 300
    words, pairs = np.array([3, 9], np.uint64), np.arange(n, dtype=np.uint64)
    counts = np.append(np.ones(n - 1, np.int64), times - n + 1)
    trie = lm_scoring.Trie.build(words, np.array([times, 1 << 62]), np.append(pairs, np.uint64((1 << 28) | 1)), np.append(counts, 1))
    codes = trie.successor(np.append(np.zeros(n, int), 1), np.append(pairs, np.uint64(1)))
    chances = 10.0 ** (-(codes.astype(float) - 1) * lm_scoring.STEP)
    exact = np.append((counts - lm_scoring.DISCOUNT) / times, (1 - lm_scoring.DISCOUNT) / (1 << 62))
    assert (codes > 0).all() and (chances <= exact * (1 + 1e-9)).all() and (chances >= exact * 10**-lm_scoring.STEP * 0.999).all()
    assert chances[:-1].sum() <= 1

    # through messages and replies, with every training count so much larger
    texts = pa.array(["a b a c", "a d"])
    block = lm_scoring.Block(texts, np.array([True, True]), np.zeros(0, np.uint64), 1)
    block.counts, once = block.counts * times, lm_scoring.DISCOUNT
    reply = lm_scoring._answer(pa.Table.from_batches(block.messages(0)))
    found = block.scores(reply, 8 * times, 5)[3]
    # counts of a pair stay 1, those of its context are times its own: a 3, the end 2, b, c and d 1
    one = lambda c: (c * times + 1) / (8 * times + 6)
    chance = lambda c, follow, of: math.log10((1 - once) / (c * times) + once * follow / (c * times) * one(of))
    begin = math.log10((2 - once) / (2 * times) + once / (2 * times) * one(3))
    want = [begin + chance(3, 3, 1) + chance(1, 1, 3) + chance(3, 3, 1) + chance(1, 1, 2), begin + chance(3, 3, 1) + chance(1, 1, 2)]
    assert all(w - 5 * lm_scoring.STEP <= g <= w + 1e-6 for g, w in zip(found, want))


def test_successors_with_equal_first_bits_are_told_apart(monkeypatch):
    assert [int(lm_scoring._successor_bits(s)) for s in (0, 1 << 10, 1 << 29, 1 << 45)] == [28, 28, 38, 40]
    context, seen = np.uint64(77 << 40), np.uint64(5 << 40)
    unseen = seen + np.uint64(1 << 30)  # differs in bit 34 of 64 from above
    tokens = np.array([context, seen, lm_scoring._END, context, unseen, lm_scoring._END], np.uint64)
    monkeypatch.setattr(lm_scoring, "_tokens", lambda texts: (tokens, np.array([3, 6])))

    def seen_pairs(bits):
        block = lm_scoring.Block(pa.array(["", ""]), np.array([True, False]), np.zeros(0, np.uint64), 1, bits)
        reply = lm_scoring._answer(pa.Table.from_batches(block.messages(0)), bits)
        return int((lm_scoring._unpacked(reply.column("codes")[0].as_py()) > 0).sum())

    # three pairs of the first text; 28 bits take the unseen one for a fourth
    assert seen_pairs(np.uint64(28)) == 4
    assert [seen_pairs(lm_scoring._successor_bits(s)) for s in (1 << 29, 1 << 45)] == [3, 3]


def sentences(lang, rng, n):
    stems = {"en": "the and thing house with from street", "de": "der und nicht schön straße über haus", "fr": "le et été où français avec maison"}[lang]
    return " ".join(rng.choice(stems.split()) + rng.choice(["", "s", "en", ","]) for _ in range(n))


def test_language_id_on_held_out_rows(spark, monkeypatch):
    rng = random.Random(7)
    langs = [rng.choice(["en", "de", "fr"]) for _ in range(300)]
    rows = [(i, sentences(x, rng, rng.randint(4, 40)), x if i % 10 else None) for i, x in enumerate(langs)]
    rows += [(900, None, "en"), (901, "", "de"), (902, "123 ... !", "fr"), (None, sentences("de", rng, 30), None), (5, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, _found string")
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i in (900, 901, 902):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[None].lang_pred == "de"
    assert all(r.held_out == (f.crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 and r._found == "clash" for r in got)
    out = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(r.lang_pred == langs[r.doc_id] for r in out) >= 0.97 * len(out)
    kept = language_id.accepted(docs)
    assert kept.columns == docs.columns and {900, 901, 902}.isdisjoint(r.doc_id for r in kept.collect())


def test_language_id_reads_long_texts_whole(monkeypatch):
    rng = random.Random(8)
    texts = [sentences("fr", rng, 3000), "", "x", sentences("en", rng, 5)]
    matrix = np.random.RandomState(0).rand(language_id._NOTHING + 1, 2).astype(np.float32)
    matrix[-1] = 0
    whole = language_id.score_texts(texts, ["a", "b"], matrix)

    def sums(size):
        out = np.zeros(len(texts))
        for owners, starts, chars, room in language_id._pieces(texts, size):
            for buckets in language_id._buckets(chars, room):
                np.add.at(out, owners, np.add.reduceat(matrix[buckets, 0], starts, dtype=np.float64))
        return out

    assert np.allclose(sums(1 << 18), sums(100)) and whole[0][1] == "und"


def test_language_id_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[-2:] for r in language_id.identify(docs).collect()] == [("und", 0.0)]


def leaks(docs, items):
    out = set()
    for i, t in items:
        want = f.runs(t)
        size = min(5, len(f.words(t)))
        for d, text in docs:
            if want and len(want & f.runs(text, size)) >= 0.75 * len(want):
                out.add((d, i))
    return out


def test_leaks(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, prose(rng.randint(12, 40)) + ". " + prose(8) + ".") for i in range(60)] + [(60, None), (61, ""), (62, "tiny item"), (3, "w1 w2 w3 w4 w5 w6")]
    docs = [(i, prose(rng.choice([0, 3, 50, 600]))) for i in range(60)]
    for k in range(40):
        item = rng.choice(items[:60])[1]
        if k % 3 == 0:
            item = f.near(item, rng, 1)
        docs.append((100 + k, prose(rng.randint(0, 300)) + " " + item.upper() + "\n" + prose(rng.randint(0, 300))))
    docs += [(300, None), (301, "a TINY  item here"), (302, items[0][1]), (302, items[0][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_leaks(f.documents(spark, [t for _, t in docs], [i for i, _ in docs]), table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks(docs, items)
    assert all(r.overlap >= 0.75 and r.score > 0 for r in got) and sum(r.doc_id == 302 for r in got) == 2
    kept = decontamination.decontaminate(f.documents(spark, [t for _, t in docs], [i for i, _ in docs]), table)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in docs if i not in {r.doc_id for r in got})


def test_question_or_answer_alone_is_a_leak(spark):
    rng = random.Random(13)
    prose = lambda n: " ".join(f"v{rng.randrange(400)}" for _ in range(n))
    sizes = [(30, 30), (60, 20), (20, 60), (30, 6), (16, 40), (40, 16), (6, 30), (10, 10)]
    parts = [(prose(q) + ".", prose(a) + ".") for q, a in sizes]
    docs, want = [], set()
    for i, (question, answer) in enumerate(parts):
        for k, text in enumerate([question, answer, question + " " + answer, question + " " + prose(30), prose(30) + " " + answer]):
            docs.append((10 * i + k, prose(150) + "\n" + text + " " + prose(150)))
            least = decontamination.LEAST_PART
            if k == 2 or sizes[i][k % 2 if k < 2 else k - 3] >= least:
                want.add((10 * i + k, i))
    table = spark.createDataFrame([(i, " ".join(p)) for i, p in enumerate(parts)], "item_id long, text string")
    got = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    for r in got:
        question, answer = r.question_overlap == 1, r.answer_overlap == 1
        assert (question, answer) == {0: (True, False), 1: (False, True), 2: (True, True), 3: (True, False), 4: (False, True)}[r.doc_id % 10]


def test_no_part_with_three_quarters_is_below_its_threshold():
    rng = random.Random(14)
    prose = lambda n: " ".join(f"t{min(rng.randrange(60), rng.randrange(60))}" for _ in range(n))
    items = [(i, prose(rng.randint(1, 40)) + ". " + prose(rng.randint(1, 40)) + ".") for i in range(50)]
    index, tried = decontamination.build_index(items), 0
    for k, (_, text) in enumerate(items):
        for part in decontamination.question_and_answer(text):
            found, want = f.words(part), f.runs(part)
            for _ in range(20):
                kept = " ".join(w if rng.random() < 0.95 else f"gone{rng.random()}" for w in found)
                if len(found) < decontamination.LEAST_PART or len(want & f.runs(kept)) < 0.75 * len(want):
                    continue
                _, words, bounds = next(word_blocks(pa.array([kept])))
                assert k in decontamination.retrieve(index, words, bounds)[2]
                tried += 1
    assert tried > 100


def test_leaks_from_several_indexes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MAX_ITEMS", 4)
    rng = random.Random(10)
    items = [(i, " ".join(f"q{rng.randrange(50)}" for _ in range(20))) for i in range(9)]
    docs = spark.createDataFrame([(i, "before " + t + " after") for i, t in items], "doc_id long, text string")
    got = decontamination.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(i, i) for i in range(9)}


def test_question_and_answer():
    assert decontamination.question_and_answer("What is it? It is this.") == ("What is it? ", "It is this.")
    assert decontamination.question_and_answer("Only one") == ("Only one", "Only one")


def test_no_item_with_three_quarters_is_below_its_threshold():
    rng = random.Random(11)
    items = [(i, " ".join(f"t{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randint(1, 30)))) for i in range(50)]
    index = decontamination.build_index(items)
    for k, (i, text) in enumerate(sorted(items)):
        found = f.words(text)
        for _ in range(20):
            kept = [w if rng.random() < 0.93 else f"gone{rng.random()}" for w in found]
            want = f.runs(text)
            if len(want & f.runs(" ".join(kept), min(5, len(found)))) < 0.75 * len(want):
                continue
            _, words, bounds = next(word_blocks(pa.array([" ".join(kept)])))
            assert k in decontamination.retrieve(index, words, bounds)[2]


@pytest.mark.parametrize("run", [language_id.identify, language_id.accepted, lm_scoring.score_texts, lambda d: token_counts.count_tokens(d, MODEL)])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], f.EMPTY)).collect() == []


def test_empty_benchmark(spark):
    docs = f.documents(spark, ["a b c d e", None])
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_leaks(docs, none).collect() == [] and decontamination.decontaminate(docs, none).count() == 2
    assert decontamination.find_leaks(spark.createDataFrame([], f.EMPTY), none).collect() == []
