"""Benchmark decontamination: a BM25 inverted index of the test items, queried by every passage.

Test items are indexed; passages (windows of words, each half overlapping the next) are the
queries. A leak is a passage with three quarters of the five-word shingles of the item, of its
question or of its answer (a part of less than ``LEAST_PART`` words counts with the item only).
An item's threshold is the least score of any passage that the rule allows, so retrieving all
above it loses none. Weights are divided by it, so
1 is everybody's threshold. Block-max WAND in numpy, for all passages of a block of texts at
once: a passage goes on if the maxima of its terms reach 1, then to those blocks of items
whose maxima reach 1, and only there are items scored. What is retrieved is verified on the
shingles of item, question and answer.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import without
from footfall.llm.words import shingles, word_blocks

OVERLAP = 0.75
#: Items and bytes of text of one index. More items are taken in several indexes, each asked by all passages.
MAX_ITEMS = 20_000
MAX_BYTES = 32 << 20
K1, B = 1.2, 0.75
#: Items in a block of the index; least words of a passage.
BLOCK = 16
LEAST_PASSAGE = 64
#: Words from which on a question or an answer is a leak without the other.
LEAST_PART = 16

_SCHEMA = "item_id long, score double, overlap double, question_overlap double, answer_overlap double"
_SENTENCE = re.compile(r"(?<=[.?!\n])\s+(?=\S)")


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's answer is its last sentence or line, its question what stands before; one sentence is both."""
    cuts = [m.end() for m in _SENTENCE.finditer(text.rstrip())]
    return (text[: cuts[-1]], text[cuts[-1] :]) if cuts else (text, text)


@dataclass
class Index:
    """Postings by term, items in order; ``blocks`` holds each term's greatest weight per block of items."""

    items: list[int]
    terms: np.ndarray
    posting_start: np.ndarray
    posting_item: np.ndarray
    posting_weight: np.ndarray
    block_start: np.ndarray
    block_number: np.ndarray
    block_weight: np.ndarray
    most: np.ndarray
    thresholds: np.ndarray
    whole: list[tuple[int, np.ndarray]]
    question: list[tuple[int, np.ndarray]]
    answer: list[tuple[int, np.ndarray]]
    alone: list[tuple[bool, bool, bool]]
    half: int


def _runs(words: np.ndarray) -> tuple[int, np.ndarray]:
    """Length and distinct hashes of the runs by which a text is recognised: five words, or all of fewer."""
    return min(5, len(words)), np.unique(shingles(words))


def _words(texts: list[str]) -> list[np.ndarray]:
    out = []
    for _, words, bounds in word_blocks(pa.array(texts, pa.string())):
        out += [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def _least_score(words: np.ndarray, weights: dict[int, float], overlap: float) -> float:
    """What a passage with the share ``overlap`` of the shingles of an item or its part scores at least.

    A word is lost only with all shingles that hold it, and a lost shingle holds five words at most;
    the greatest loss is bounded by filling that room with the words that weigh most.
    """
    size = min(5, len(words))
    runs = np.lib.stride_tricks.sliding_window_view(words, size)
    runs = np.unique(runs, axis=0)
    lost = len(runs) - int(np.ceil(overlap * len(runs) - 1e-9))
    room, rest = float(size * lost), sum(weights.values())
    held = {t: int((runs == np.uint64(t)).any(axis=1).sum()) for t in weights}
    for t in sorted(weights, key=lambda t: -weights[t] / held[t]):
        if room <= 0:
            break
        rest -= weights[t] * min(1.0, room / held[t])
        room -= held[t]
    return max(rest, 0.0)


def build_index(items: list[tuple[int, str]], overlap: float = OVERLAP) -> Index | None:
    """The index of items with words; None if there are none. Equal items are indexed each."""
    items = sorted((i, t) for i, t in items if t)
    words = _words([t for _, t in items])
    keep = [k for k, w in enumerate(words) if len(w)]
    items, words = [items[k] for k in keep], [words[k] for k in keep]
    if not items:
        return None
    parts = [question_and_answer(t) for _, t in items]
    terms = np.unique(np.concatenate(words))
    lengths = np.array([len(w) for w in words], float)
    term, item, count = [], [], []
    for k, w in enumerate(words):
        t, c = np.unique(w, return_counts=True)
        term.append(np.searchsorted(terms, t))
        item.append(np.full(len(t), k))
        count.append(c)
    term, item, count = map(np.concatenate, (term, item, count))
    df = np.bincount(term, minlength=len(terms))
    idf = np.log(1 + (len(items) - df + 0.5) / (df + 0.5))
    weight = idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * lengths[item] / lengths.mean()))
    questions, answers = (_words([p[k] for p in parts]) for k in range(2))

    def least(k: int) -> float:
        own = dict(zip(terms[term[item == k]].tolist(), weight[item == k].tolist()))
        found = [words[k], *(p[k] for p in (questions, answers) if len(p[k]) >= LEAST_PART)]
        return min(_least_score(w, {t: own.get(t, 0.0) for t in w.tolist()}, overlap) for w in found)

    thresholds = np.array([least(k) for k in range(len(items))])
    thresholds = np.maximum(thresholds * (1 - 1e-6), 1e-9)
    weight = weight / thresholds[item]
    order = np.lexsort((item, term))
    term, item, weight = term[order], item[order], weight[order]
    fresh = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (item[1:] // BLOCK != item[:-1] // BLOCK)))
    starts = lambda x: np.searchsorted(x, np.arange(len(terms) + 1))
    maxima = np.maximum.reduceat(weight, fresh)
    return Index(
        items=[i for i, _ in items],
        terms=terms,
        posting_start=starts(term),
        posting_item=item,
        posting_weight=weight,
        block_start=starts(term[fresh]),
        block_number=item[fresh] // BLOCK,
        block_weight=maxima,
        most=np.maximum.reduceat(weight, starts(term)[:-1]),
        thresholds=thresholds,
        whole=[_runs(w) for w in words],
        question=[_runs(w) for w in questions],
        answer=[_runs(w) for w in answers],
        alone=[(True, len(q) >= LEAST_PART, len(a) >= LEAST_PART) for q, a in zip(questions, answers)],
        half=int(max(LEAST_PASSAGE // 2, lengths.max())),
    )


def _expand(start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row number of a list of lists: which of ``rows`` it came from, and the places of its entries."""
    sizes = start[rows + 1] - start[rows]
    origin = np.repeat(np.arange(len(rows)), sizes)
    ahead = np.arange(len(origin)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return origin, start[rows][origin] + ahead


def retrieve(index: Index, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Passages and items that reach the threshold: rows of the block, first words, items, scores (1: the threshold)."""
    place = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    at = np.flatnonzero(index.terms[place] == words)
    term = place[at]
    row = np.searchsorted(bounds, at, "right") - 1
    halves = -(-np.diff(bounds) // index.half)
    passages = np.maximum(halves - 1, 1)
    first = np.cumsum(passages) - passages
    step = (at - bounds[row]) // index.half
    upper = np.minimum(step, passages[row] - 1)
    lower = np.maximum(step - 1, 0)
    both = np.concatenate([first[row] + upper, (first[row] + lower)[lower != upper]])
    width = len(index.terms)
    asked = np.unique(both * width + np.concatenate([term, term[lower != upper]]))
    passage, term = asked // width, asked % width

    total = int(passages.sum())
    good = np.bincount(passage, index.most[term], total) >= 1
    passage, term = passage[good[passage]], term[good[passage]]
    blocks = len(index.items) // BLOCK + 1
    origin, entry = _expand(index.block_start, term)
    key, back = np.unique(passage[origin] * blocks + index.block_number[entry], return_inverse=True)
    key = key[np.bincount(back, index.block_weight[entry], len(key)) >= 1]
    if len(key):
        live = np.isin(passage, key // blocks)
        passage, term = passage[live], term[live]
        origin, entry = _expand(index.posting_start, term)
        item = index.posting_item[entry]
        inside = np.isin(passage[origin] * blocks + item // BLOCK, key)
        origin, entry, item = origin[inside], entry[inside], item[inside]
        key, back = np.unique(passage[origin] * len(index.items) + item, return_inverse=True)
        score = np.bincount(back, index.posting_weight[entry], len(key))
        key, score = key[score >= 1], score[score >= 1]
        passage, item = key // len(index.items), key % len(index.items)
    else:
        passage = item = np.zeros(0, np.int64)
        score = np.zeros(0)
    row = np.searchsorted(first, passage, "right") - 1
    return row, bounds[row] + (passage - first[row]) * index.half, item, score


def _share(part: tuple[int, np.ndarray], held: Callable[[int], np.ndarray]) -> float:
    """The share of a part's runs that stand among those held of its size; all of a part without words."""
    size, runs = part
    return float(np.isin(runs, held(size)).mean()) if size else 1.0


def _leaks_of(index: Index, overlap: float, texts: pa.Array) -> Iterator[tuple[int, int, float, float, float, float]]:
    """Row, item, BM25 score and overlaps of verified leaks: the best passage of each pair."""
    for row, words, bounds in word_blocks(texts):
        best: dict[tuple[int, int], tuple] = {}
        runs = lru_cache(16)(lambda begin, end, size, words=words: shingles(words[begin:end], size))
        for r, begin, item, score in zip(*(x.tolist() for x in retrieve(index, words, bounds))):
            end = min(begin + 2 * index.half, int(bounds[r + 1]))
            held = lambda size: runs(begin, end, size)  # noqa: B023, E731
            shares = [_share(part[item], held) for part in (index.whole, index.question, index.answer)]
            if any(alone and share >= overlap for alone, share in zip(index.alone[item], shares)):
                result = (shares[0], score * index.thresholds[item], *shares[1:])
                best[r, item] = max(best.get((r, item), result), result)
        for (r, item), (share, score, question, answer) in sorted(best.items()):
            yield row + r, index.items[item], score, share, question, answer


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", overlap: float = OVERLAP) -> DataFrame:
    """One row per document and test item that leaked into it: key, ``item_id``, ``score``, overlaps.

    ``overlap`` is the greatest share of the item's five-word shingles in one leaking passage,
    beside the shares of its question and its answer there; the first, or that of a part of
    ``LEAST_PART`` words or more, is 0.75 at least. ``score`` is that passage's BM25 score. Documents and items without words (or null) leak nothing. An item of fewer
    than five words leaks where its whole sequence stands. Repeated documents are reported each,
    as are repeated items; null keys are carried. Empty tables give no rows; further columns are ignored.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item")).where("item is not null")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("item")), F.lit(0)).alias("bytes")).first()
    parts = max(1, -(-size["n"] // (MAX_ITEMS // 2)), -(-size["bytes"] // (MAX_BYTES // 2)))
    kind = docs.schema[key].dataType
    found = None
    for part in range(parts):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(parts)) == part)
        index = build_index([(r["item_id"], r["item"]) for r in chosen.collect()], overlap)
        model = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = list(_leaks_of(model.value, overlap, batch.column(1))) if model.value else []
                if rows:
                    row, *columns = zip(*rows)
                    names = ["item_id", "score", "overlap", "question_overlap", "answer_overlap"]
                    yield pa.record_batch([batch.column(0).take(pa.array(row)), *map(pa.array, columns)], names=[key, *names])

        leaks = docs.select(key, text).mapInArrow(run, f"{key} {kind.simpleString()}, {_SCHEMA}")
        found = leaks if found is None else found.unionByName(leaks)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, with their columns; rows of one key are kept or dropped as one."""
    return without(docs, find_leaks(docs, benchmark).select("doc_id"), "doc_id")
