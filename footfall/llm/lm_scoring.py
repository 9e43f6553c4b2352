"""Language-model scoring with an Elias-Fano n-gram trie.

The model: bigrams with absolute discounting, interpolated with add-one unigrams,

    p(w | v) = max(c(vw) - D, 0) / c(v)  +  D * n(v) / c(v) * p(w),   p(w) = (c(w) + 1) / (N + V + 1)

where c counts training tokens and n(v) the different successors of v. A text is followed by
one end token, and the end token stands before its first word.

The corpus is worked through in blocks of documents, and the trie is cut into shards, both of
bounded size. A block sends each shard the words and bigrams it has there, once, with its
training counts. A shard adds the counts of all blocks, builds its part of the trie, and
answers each block's words and bigrams in the order in which they came. So counts travel
once, and what is gathered grows with the corpus while no task or driver holds it. Words that
a sample shows to be frequent have their successors split over several shards.

A shard of the trie is one memory-mapped buffer of levels: words and successors in
Elias-Fano code, monotone pointers from words to their successors, and one quantised
smoothed probability per successor. A successor is coded relative to its context (the
context's place and the successor's hash), and searched between the context's two pointers.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.elias_fano import EliasFano
from footfall.llm.shared import held_out, staged, whole_text
from footfall.llm.words import mixed, word_blocks

#: Bytes of text of a block and of a shard's share; shards over which a frequent word's successors go.
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 12 << 20
#: Words that a task counts at a time.
TALLY = 1_500_000
SPLIT = 16
#: Documents sampled (about) to tell frequent words.
SAMPLE = 2_000
DISCOUNT = 0.75
#: Probabilities are kept as 1 and more steps of a logarithm from 0 down; 0: no successor. A count of
#: 2^63 gives 627 steps, so 16 bits hold every probability; they travel in 8 where these are enough.
STEP = 1 / 32

_END = np.uint64(0x656E646F66746578)
#: Bits of a successor's hash, at least and at most; the others of 64 hold the place of its context in a shard.
_SUCCESSOR_BITS, _MOST_BITS = np.uint64(28), np.uint64(40)
_MESSAGE = "shard long, block long, words binary, word_counts binary, pairs binary, pair_counts binary"
_REPLY = "block long, shard long, counts binary, followers binary, codes binary"
_SCORED = "n_tokens long, n_known long, known_log double, score double"


def _successor_bits(size: int) -> np.uint64:
    """More bits for a corpus of more bytes, as a context has more successors there."""
    return np.uint64(min(int(_MOST_BITS), max(int(_SUCCESSOR_BITS), size.bit_length() + 8)))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each followed by the end token, and the end of each text."""
    parts, sizes = [], []
    for _, words, bounds in word_blocks(texts):
        for a, b in zip(bounds[:-1], bounds[1:]):
            parts += [words[a:b], np.array([_END])]
            sizes.append(b - a + 1)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(np.array(sizes, np.int64))


def _entry(words: np.ndarray, sub: np.ndarray | int) -> np.ndarray:
    """Key of a word's entry; the lowest bit marks the entries of a split word beyond its first."""
    sub = np.asarray(sub, np.uint64)
    return (mixed(words + sub * np.uint64(0x9E3779B97F4A7C15)) << np.uint64(1)) | (sub > 0).astype(np.uint64)


class Block:
    """The words and bigrams of some documents, in the order in which shards are asked."""

    def __init__(self, texts: pa.Array, training: np.ndarray, frequent: np.ndarray, shards: int, bits: np.uint64 = _SUCCESSOR_BITS):
        tokens, self.ends = _tokens(texts)
        sizes = np.diff(np.append(0, self.ends))
        counted = np.repeat(training, sizes)
        words, self.word = np.unique(tokens, return_inverse=True)
        n = len(words)
        before = np.append(np.searchsorted(words, _END), self.word[:-1]) if n else self.word
        pairs, self.pair = np.unique(before * n + self.word, return_inverse=True)
        word_count = np.bincount(self.word, counted, n).astype(np.int64)
        # A context is counted once per successor, so its count is that of the word but for the text's begin and end.
        pair_count = np.bincount(self.pair, counted, len(pairs)).astype(np.int64)
        context, successor = pairs // max(n, 1), pairs % max(n, 1)

        split = np.isin(words, frequent)
        parts = np.where(split, SPLIT, 1)
        owner = np.repeat(np.arange(n), parts)
        sub = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        keys = _entry(words[owner], sub)
        shard = (mixed(keys, 3) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((keys, shard))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.keys, self.shard, self.owner, self.counts = keys[order], shard[order], owner[order], word_count[owner[order]]
        first_entry = np.cumsum(parts) - parts
        choice = np.where(split[context], (words[successor] >> np.uint64(8)) % np.uint64(SPLIT), 0).astype(np.int64) if n else context
        entry = rank[first_entry[context] + choice] if n else context
        place = np.flatnonzero(np.append(True, self.shard[1:] != self.shard[:-1])) if len(keys) else np.zeros(0, np.int64)
        self.places = np.append(place, len(keys))
        start = self.places[np.searchsorted(place, entry, "right") - 1] if n else entry
        relative = (entry - start).astype(np.uint64) << bits | words[successor] >> (np.uint64(64) - bits)
        by = np.lexsort((relative, self.shard[entry])) if n else entry
        self.pair_place = np.empty(len(by), np.int64)
        self.pair_place[by] = np.arange(len(by))
        self.pair_keys, self.pair_counts = relative[by], pair_count[by]
        self.pair_places = np.searchsorted(self.shard[entry][by], self.shard[place]) if n else place
        self.pair_places = np.append(self.pair_places, len(by))
        self.n, self.first_owner, self.bits = n, first_entry, bits
        self.context = context

    def messages(self, block: int) -> Iterator[pa.RecordBatch]:
        rows = []
        for k in range(len(self.places) - 1):
            a, b, c, d = *self.places[k : k + 2], *self.pair_places[k : k + 2]
            rows.append(
                (
                    int(self.shard[a]),
                    block,
                    EliasFano.encode(self.keys[a:b]),
                    _packed(self.counts[a:b]),
                    EliasFano.encode(self.pair_keys[c:d], int(b - a) << int(self.bits)),
                    _packed(self.pair_counts[c:d]),
                )
            )
        if rows:
            names = [x.split()[0] for x in _MESSAGE.split(", ")]
            yield pa.record_batch([pa.array(x) for x in zip(*rows)], names=names)

    def scores(self, replies: pa.Table, total: int, different: int) -> tuple[np.ndarray, ...]:
        """Per document: tokens, known tokens, sum of log10(c + 1), log10 probability."""
        answers = {r["shard"]: r for r in replies.to_pylist()}
        rows = [answers[int(self.shard[a])] for a in self.places[:-1]]
        read = lambda name, kind: np.frombuffer(b"".join(r[name] for r in rows), kind)
        entry_count, followers = read("counts", np.int64), read("followers", np.int64)
        codes = np.concatenate([np.zeros(0, np.int64), *(_unpacked(r["codes"]) for r in rows)])
        count = np.zeros(self.n, np.int64)
        count[self.owner] = entry_count  # the same for all entries of a word
        varied = np.bincount(self.owner, followers, self.n)
        single = (count + 1) / (total + different + 1)
        seen = np.maximum(count, 1)
        back = np.where(count > 0, DISCOUNT * np.maximum(varied, 1) / seen, 1.0)
        direct = np.where(codes > 0, 10.0 ** (-(codes.astype(float) - 1) * STEP), 0.0)[self.pair_place]
        successor = np.empty(len(self.context), np.int64)
        successor[self.pair] = self.word
        chance = np.log10(direct + np.minimum(back[self.context], 1.0) * single[successor])
        starts = np.append(0, self.ends[:-1])
        add = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
        sizes = np.diff(np.append(0, self.ends))
        known = add((count > 0)[self.word].astype(np.int64))
        return sizes, known, add(np.log10(count + 1.0)[self.word]), add(chance[self.pair])


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs."""
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << 8 * w)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


class Trie:
    """One shard of the trie, read from a memory map."""

    @staticmethod
    def build(words: np.ndarray, counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, bits: np.uint64 = _SUCCESSOR_BITS) -> Trie:
        """``words``: sorted keys; ``pairs``: sorted, the place of the context before the ``bits`` of the successor's hash."""
        context = (pairs >> bits).astype(np.int64)
        share = np.maximum(pair_counts - DISCOUNT, 0) / np.maximum(counts[context], 1)
        held = share > 0
        steps = np.ceil(-np.log10(np.where(held, share, 1)) / STEP)  # rounded down in probability
        levels = [
            EliasFano.encode(words, 1 << 64),
            EliasFano.encode(np.searchsorted(context, np.arange(len(words) + 1)).astype(np.uint64)),
            EliasFano.encode(pairs, len(words) << int(bits)),
            counts.astype(np.int64).tobytes(),
            np.where(held, steps + 1, 0).astype(np.uint16).tobytes(),
        ]
        data = mmap.mmap(-1, max(1, sum(map(len, levels))))
        for level in levels:
            data.write(level)
        return Trie(data, bits)

    def __init__(self, data, bits: np.uint64 = _SUCCESSOR_BITS):
        self.bits = bits
        self.words = EliasFano(data)
        self.pointers = EliasFano(data, self.words.end)
        self.successors = EliasFano(data, self.pointers.end)
        self.counts = np.frombuffer(data, np.int64, self.words.size, self.successors.end)
        self.codes = np.frombuffer(data, np.uint16, self.successors.size, self.successors.end + self.counts.nbytes)

    def successor(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The quantised probability of each successor after the word at each place; 0 if it was never seen there."""
        pointers = self.pointers.decode().astype(np.int64)
        keys = context.astype(np.uint64) << self.bits | successor
        at = self.successors.find(keys, pointers[context], pointers[context + 1])
        return np.where(at >= 0, self.codes[np.maximum(at, 0)] if len(self.codes) else 0, 0).astype(np.uint16)


def _answer(group: pa.Table, bits: np.uint64 = _SUCCESSOR_BITS) -> pa.Table:
    """Add the counts of all blocks, build the shard's trie, answer each block."""
    rows = group.to_pylist()
    keys = [EliasFano(r["words"]).decode() for r in rows]
    sizes = [len(k) for k in keys]
    words, place = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(place, np.concatenate([_unpacked(r["word_counts"]) for r in rows]), len(words)).astype(np.int64)
    places = np.split(place, np.cumsum(sizes)[:-1])
    if len(words) > 1 << 64 - int(bits):
        raise ValueError(f"{len(words)} words in a shard, whose places have {64 - int(bits)} bits")
    mask = (np.uint64(1) << bits) - np.uint64(1)
    asked = []
    for row, own in zip(rows, places):
        pairs = EliasFano(row["pairs"]).decode()
        context = own[(pairs >> bits).astype(np.int64)]
        asked.append((context, pairs & mask, _unpacked(row["pair_counts"])))
    trained = [((c.astype(np.uint64) << bits | s)[n > 0], n[n > 0]) for c, s, n in asked]
    pairs, back = np.unique(np.concatenate([p for p, _ in trained]), return_inverse=True)
    pair_counts = np.bincount(back, np.concatenate([n for _, n in trained]), len(pairs)).astype(np.int64)
    trie = Trie.build(words, counts, pairs, pair_counts, bits)
    followers = np.bincount((pairs >> bits).astype(np.int64), minlength=len(words))
    return pa.table(
        {
            "block": pa.array([r["block"] for r in rows], pa.int64()),
            "shard": pa.array([r["shard"] for r in rows], pa.int64()),
            "counts": [trie.counts[own].tobytes() for own in places],
            "followers": [followers[own].astype(np.int64).tobytes() for own in places],
            "codes": [_packed(trie.successor(context, successor)) for context, successor, _ in asked],
        }
    )


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Different words with their counts, for every ``TALLY`` words or so."""
    held, size, ends = [], 0, 0
    for batch in batches:
        for _, words, bounds in word_blocks(batch.column("text")):
            held.append(words)
            size += len(words)
            ends += len(bounds) - 1
            if size > TALLY:
                yield np.unique(np.concatenate([*held, np.full(ends, _END)]), return_counts=True)
                held, size, ends = [], 0, 0
    if ends:
        yield np.unique(np.concatenate([*held, np.full(ends, _END)]), return_counts=True)


def _word_counts(rows: DataFrame, shards: int) -> tuple[int, int]:
    """Training tokens and different training words, exactly."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, counts in _tallies(batches):
            shard = (mixed(words, 5) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.append(True, shard[order][1:] != shard[order][:-1])) if len(order) else []
            for part in np.split(order, cuts[1:]) if len(order) else []:
                yield pa.record_batch(
                    [[int(shard[part[0]])], [EliasFano.encode(words[part])], [int(counts[part].sum())]], names=["shard", "words", "n"]
                )

    def add(group: pa.Table) -> pa.Table:
        words = np.unique(np.concatenate([EliasFano(w).decode() for w in group.column("words").to_pylist()]))
        return pa.table({"n": [sum(group.column("n").to_pylist())], "different": [len(words)]})

    found = rows.where("training").mapInArrow(count, "shard long, words binary, n long").groupBy("shard")
    total = found.applyInArrow(add, "n long, different long").agg(F.sum("n").alias("n"), F.sum("different").alias("v")).first()
    return total["n"] or 0, total["v"] or 0


def _frequent(rows: DataFrame, shards: int) -> np.ndarray:
    """Words that, by a sample of documents, make up more than a quarter of a shard's share: 4 * shards at most."""
    count = rows.count()
    share = min(1.0, SAMPLE / max(1, count))
    chance = F.pmod(F.xxhash64(F.lit("frequent"), "doc_id", "text"), F.lit(1 << 30))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = np.unique(_tokens(batch.column("text"))[0], return_counts=True)
            yield pa.record_batch([words.view(np.int64), counts.astype(np.int64)], names=["word", "n"])

    sums = rows.where(chance <= int(share * (1 << 30))).select("text").mapInArrow(tally, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    sums = staged(sums.where("n > 1"), "frequent")
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    often = sums.where(F.col("n") * 4 * shards > total).select("word")
    return np.sort(np.array([r["word"] for r in often.collect()], np.int64).view(np.uint64))


def score_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learned from the rows that are not held out; see the module for the model. ``base_score`` is
    the unigram model alone, ``score`` the log10 probability of the text and its end. A null text
    is empty: one end token. A null key is held out or not as the empty text is. Repeated rows are
    learned from and scored each. An empty table gives no rows; further columns are ignored.
    """
    rows = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text")).withColumn("training", ~held_out(7))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    blocks, shards = 1 + size // BLOCK_BYTES, 1 + size // SHARD_BYTES
    bits = _successor_bits(size)
    total, different = _word_counts(rows, shards)
    frequent = _frequent(rows, shards)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def block_of(group: pa.Table) -> Block:
        training = group.column("training").to_numpy()
        return Block(group.column("text").combine_chunks(), training, frequent, shards, bits)

    def ask(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in _MESSAGE.split(", ")]
        batches = list(block_of(group).messages(key[0].as_py()))
        return pa.Table.from_batches(batches).select(names)

    def answer(group: pa.Table) -> pa.Table:
        return _answer(group, bits)

    def score(group: pa.Table, replies: pa.Table) -> pa.Table:
        n, known, logs, chance = block_of(group).scores(replies, total, different) if group.num_rows else ([],) * 4
        columns = [group.column("doc_id"), group.column("training"), n, known, logs, chance]
        return pa.table(columns, names=["doc_id", "training", "n_tokens", "n_known", "known_log", "score"])

    messages = rows.groupBy("block").applyInArrow(ask, _MESSAGE)
    replies = messages.groupBy("shard").applyInArrow(answer, _REPLY)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score, f"doc_id {kind}, training boolean, {_SCORED}")
    base = F.col("known_log") - F.col("n_tokens") * float(np.log10(total + different + 1))
    return scored.select(
        F.col("doc_id").alias(key),
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
