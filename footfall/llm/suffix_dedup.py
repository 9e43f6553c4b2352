"""Suffix-array dedup: bytes covered by a long string that occurs at two places are removed.

A suffix array over every byte would be many times the corpus, so the array is sparse. Of
each window of ``span`` bytes one place is its anchor: where the hash of the next ``gram``
bytes is least (the leftmost of equals). Equal windows have their anchors at equal
distances, so only suffixes that start at anchors are sorted, about 2 of ``span - gram``.
A suffix is a row of tokens: its leading token (hash of the gram at the anchor), the token of
all bytes that its windows cover, and its place.

1. Splitters sampled from some documents part the suffixes by leading tokens, then by the
   following ones, so a token that a third of all suffixes share goes to many buckets.
2. Each bucket sorts by multikey quicksort and compares neighbours. Equal leading and body
   tokens: all windows of both anchors repeat. Equal leading tokens alone: undecided.
3. Undecided suffixes, and the first and last group of each bucket, which may go on beyond
   the boundary, are compared again by the windows they own. Leading tokens with very many
   undecided suffixes are compared window by window with pre-aggregation instead.

Strings are compared by 64-bit hashes whose base and byte values are random.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import staged, whole_text
from footfall.llm.words import mixed

SPAN = 200
GRAM = 100
#: Suffixes of a bucket (about), documents sampled for splitters (about), undecided suffixes
#: of one leading token that are compared in one group.
BUCKET = 100_000
SAMPLE = 2_000
HEAVY = 5_000

_BLOCK = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_RANDOM = np.random.RandomState(37)
_VALUES = _RANDOM.randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(4) + _RANDOM.randint(0, 4, 256).astype(np.uint64)
_BASE = 0xD6E8FEB86659FD93
_SUFFIX = "token long, body long, ref long, anchor int, first int, last int"
_FOUND = "undecided boolean, token long, ref long, anchor int, first int, last int"


class _Prefixes:
    """Hashes of any part of some bytes."""

    powers = inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if n >= len(_Prefixes.powers):
            size = max(2 * n, _BLOCK + 2 * SPAN)
            for name, base in (("powers", _BASE), ("inverses", pow(_BASE, -1, 1 << 64))):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(_Prefixes, name, np.cumprod(factors))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[data] * _Prefixes.powers[:n], out=self.sums[1:])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:-size]) * _Prefixes.inverses[:n])

    def part(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[first]) * _Prefixes.inverses[first]


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each run of ``width`` keys."""
    n = len(keys)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _blocks(texts: pa.Array, span: int) -> Iterator[tuple[np.ndarray, list[int], np.ndarray, np.ndarray]]:
    """Bytes, row numbers, ends in the bytes and shifts into the texts.

    Texts beyond a block are cut so that each window is in one piece. Texts without a window are left out.
    No more bytes are given out at a time than a place can count.
    """
    rows, parts, shifts, total = [], [], [], 0

    def out():
        return np.concatenate(parts), rows, np.cumsum([len(p) for p in parts]), np.array(shifts)

    for row, text in enumerate(texts):
        text = text.as_buffer()
        if text is None or text.size < span:
            continue
        data = np.frombuffer(text, np.uint8)
        for at in range(0, len(data) - span + 1, _BLOCK):
            piece = data[at : at + _BLOCK + span - 1]
            if parts and total + len(piece) > int(_PLACE):
                yield out()
                rows, parts, shifts, total = [], [], [], 0
            rows.append(row)
            parts.append(piece)
            shifts.append(at)
            total += len(piece)
            if total > _BLOCK:
                yield out()
                rows, parts, shifts, total = [], [], [], 0
    if parts:
        yield out()


def suffixes(data: np.ndarray, ends: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Tokens, body tokens, piece numbers, anchors, first and last windows (places in ``data``)."""
    prefixes = _Prefixes(data)
    grams = prefixes.all(gram)
    places = np.arange(len(grams), dtype=np.uint64)
    anchors = (_least((grams & ~_PLACE) | places, span - gram + 1) & _PLACE).astype(np.int64)
    piece = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))
    windows = np.flatnonzero(np.arange(len(anchors)) + span <= ends[piece[: len(anchors)]])
    anchors = anchors[windows]
    fresh = np.flatnonzero(np.append(True, (anchors[1:] != anchors[:-1]) | (windows[1:] != windows[:-1] + 1)))
    first, last = windows[fresh], windows[np.append(fresh[1:], len(windows)) - 1]
    anchors = anchors[fresh]
    body = mixed(prefixes.part(first, last + span) + (anchors - first).astype(np.uint64) * np.uint64(_BASE), 7)
    return grams[anchors], body + (last - first).astype(np.uint64), piece[first], anchors, first, last


def _find_suffixes(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            refs = batch.column("ref").to_numpy()
            for data, rows, ends, shifts in _blocks(batch.column("text"), span):
                token, body, piece, anchor, first, last = suffixes(data, ends, span, gram)
                back = (shifts - np.append(0, ends[:-1]))[piece]
                yield token, body, refs[np.array(rows)[piece]], anchor + back, first + back, last + back

    return run


def multikey_order(*tokens: np.ndarray) -> np.ndarray:
    """Order by the first token; runs of equal ones are sorted by the next, and so on."""
    order = np.argsort(tokens[0], kind="quicksort")
    if len(tokens) == 1 or len(order) < 2:
        return order
    key = tokens[0][order]
    tied = np.zeros(len(order), bool)
    tied[1:] = key[1:] == key[:-1]
    tied[:-1] |= key[:-1] == key[1:]
    at = np.flatnonzero(tied)
    if len(at):
        rows = order[at]
        runs = np.cumsum(np.append(0, key[at][1:] != key[at][:-1]))
        inner = multikey_order(*[t[rows] for t in tokens[1:]])
        order[at] = rows[inner[np.argsort(runs[inner], kind="stable")]]
    return order


def bucket_of(keys: list[np.ndarray], splitters: list[np.ndarray]) -> np.ndarray:
    """How many splitters (sorted rows of tokens) are not above each key, first tokens first."""
    low = np.searchsorted(splitters[0], keys[0], "left")
    high = np.searchsorted(splitters[0], keys[0], "right")
    out = low.copy()
    if len(keys) == 1:
        return high
    for at in np.unique(low[low < high]):  # tokens that are splitters themselves
        rows = np.flatnonzero((low == at) & (low < high))
        inside = slice(at, high[rows[0]])
        out[rows] += bucket_of([k[rows] for k in keys[1:]], [s[inside] for s in splitters[1:]])
    return out


def _tie(refs: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    return mixed(refs.view(np.uint64) + anchors.astype(np.uint64))


def _splitters(rows: DataFrame, span: int, gram: int) -> list[np.ndarray]:
    """Tokens that part the suffixes into buckets of about equal size, from a sample of documents."""
    find = _find_suffixes(span, gram)
    count = rows.count()
    share = min(1.0, SAMPLE / max(1, count))

    def tokens(batches):
        for t, b, r, a, _, _ in find(batches):
            keep = np.flatnonzero(_tie(r, a) % np.uint64(8) == 0)
            yield pa.record_batch([t[keep].view(np.int64), b[keep].view(np.int64), _tie(r, a)[keep].view(np.int64)], names=["t", "b", "x"])

    chosen = rows.where(F.pmod(F.xxhash64(F.lit("splitters"), "ref"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))
    found = chosen.mapInArrow(tokens, "t long, b long, x long").toArrow()
    keys = [found.column(c).to_numpy().view(np.uint64) for c in ("t", "b", "x")]
    buckets = max(1, min(len(keys[0]), int(8 * len(keys[0]) / share / BUCKET)))
    order = multikey_order(*keys)[np.linspace(0, len(keys[0]) - 1, buckets + 1).astype(int)[1:-1]] if buckets > 1 else []
    return [k[order] if buckets > 1 else k[:0] for k in keys]


def _compare(group: pa.Table) -> pa.Table:
    """Sort a bucket and compare neighbours."""
    token, body, ref = (group.column(c).to_numpy().view(np.uint64) for c in ("token", "body", "ref"))
    anchor = group.column("anchor").to_numpy()
    order = multikey_order(token, body, _tie(ref.view(np.int64), anchor))
    token, body = token[order], body[order]
    new_token = np.append(True, token[1:] != token[:-1])
    new_body = new_token | np.append(True, body[1:] != body[:-1])
    run, together = np.cumsum(new_body) - 1, np.cumsum(new_token) - 1
    repeated = np.bincount(run)[run] > 1
    bodies = np.bincount(together[new_body])[together]
    boundary = (together == 0) | (together == together[-1])
    ask = new_body & ((bodies > 1) | boundary)
    rows = np.concatenate([np.flatnonzero(repeated), np.flatnonzero(ask)])
    picked = group.select(["token", "ref", "anchor", "first", "last"]).take(order[rows])
    undecided = pa.array(np.arange(len(rows)) >= repeated.sum())
    return picked.add_column(0, "undecided", undecided)


def _runs(starts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last rows of runs of consecutive starts of one owner; sorted input."""
    fresh = np.append(True, (starts[1:] != starts[:-1] + 1) | (owners[1:] != owners[:-1]))
    at = np.flatnonzero(fresh)
    return at, np.append(at[1:], len(starts)) - 1


def _bodies(span: int):
    """The bytes of undecided suffixes, or single windows where the leading token is heavy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column("text")[row].as_buffer()
                asked = batch.column("asked")[row].as_py()
                ref = batch.column("ref")[row].as_py()
                keys, heavy, first, body = [], [], [], []
                for x in asked:
                    part = bytes(text[x["first"] : x["last"] + span])
                    if x["heavy"]:
                        hashes = _Prefixes(np.frombuffer(part, np.uint8)).all(span)
                        keys += hashes.view(np.int64).tolist()
                        heavy += [True] * len(hashes)
                        first += range(x["first"], x["last"] + 1)
                        body += [None] * len(hashes)
                    else:
                        keys.append(x["token"])
                        heavy.append(False)
                        first.append(x["first"])
                        body.append(part)
                yield pa.record_batch(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(heavy, pa.bool_()),
                        pa.array([ref] * len(keys), pa.int64()),
                        pa.array(first, pa.int32()),
                        pa.array(body, pa.binary()),
                    ],
                    names=["key", "heavy", "ref", "first", "body"],
                )

    return run


def _equal_windows(span: int):
    """Spans of windows that occur at another place of the group."""

    def run(group: pa.Table) -> pa.Table:
        bodies = group.column("body").to_pylist()
        first, ref = group.column("first").to_numpy().astype(np.int64), group.column("ref").to_numpy()
        ends = np.cumsum([len(b) for b in bodies])
        starts = np.append(0, ends[:-1])
        hashes, owner, place = [], [], []
        for low in range(0, len(bodies), 2_000):  # some hundred kilobytes at a time
            high = min(len(bodies), low + 2_000)
            data = np.frombuffer(b"".join(bodies[low:high]), np.uint8)
            own = np.repeat(np.arange(low, high), (ends - starts)[low:high])
            at = np.arange(len(data)) + starts[low]
            keep = np.flatnonzero(at + span <= ends[own])
            hashes.append(_Prefixes(data).all(span)[keep])
            owner.append(own[keep])
            place.append((at - starts[own] + first[own])[keep])
        hashes, owner, place = map(np.concatenate, (hashes, owner, place))
        order = np.argsort(hashes)
        same = hashes[order][1:] == hashes[order][:-1]
        repeated = np.zeros(len(order), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        owner, place = owner[repeated], place[repeated]
        if not len(place):
            return pa.table({"ref": pa.array([], pa.int64()), "first": pa.array([], pa.int32()), "last": pa.array([], pa.int32())})
        begin, end = _runs(place, owner)
        return pa.table({"ref": ref[owner[begin]], "first": pa.array(place[begin], pa.int32()), "last": pa.array(place[end], pa.int32())})

    return run


def _removed(span: int):
    """Spans and remaining bytes of each row, from the first and last windows to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, counts = [], [], []
            for text, windows in zip(batch.column("text"), batch.column("windows")):
                text = text.as_buffer()
                text = memoryview(text) if text is not None else memoryview(b"")
                merged: list[list[int]] = []
                for x in sorted((w["first"], w["last"] + span) for w in windows.as_py() or ()):
                    if merged and x[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x[1])
                    else:
                        merged.append(list(x))
                edges = [0, *(e for m in merged for e in m), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append([{"start": a, "end": b} for a, b in merged])
                counts.append(len(text))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"],
            )

    return run


def repeated_windows(rows: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """For ``rows`` (ref, text as bytes): decided windows ``ref, first, last``, and undecided suffixes."""
    find = _find_suffixes(span, gram)
    splitters = _splitters(rows, span, gram)

    def dealt(batches):
        for token, body, ref, anchor, first, last in find(batches):
            bucket = bucket_of([token, body, _tie(ref, anchor)], splitters)
            columns = [bucket.astype(np.int64), token.view(np.int64), body.view(np.int64), ref]
            yield pa.record_batch(columns + [x.astype(np.int32) for x in (anchor, first, last)], names=["bucket", *(x.split()[0] for x in _SUFFIX.split(", "))])

    found = staged(rows.mapInArrow(dealt, f"bucket long, {_SUFFIX}").groupBy("bucket").applyInArrow(_compare, _FOUND), "suffixes")
    return found.where("not undecided").select("ref", "first", "last"), found.where("undecided")


def suffix_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per input row: key, ``n_bytes``, ``spans`` (maximal removed runs), ``kept`` (remaining bytes).

    A byte goes if it lies in a string of ``span`` bytes that starts at another place too, in
    any document; strings do not cross documents and are judged on the input. A null text is
    empty. Repeated rows are copies of each other, so their long strings all go, as do those
    of rows that repeat a key. An empty table gives no rows; further columns are ignored.
    """
    rows = docs.select(F.col(key).alias("id"), whole_text(text).cast("binary").alias("text")).withColumn(
        "ref", F.xxhash64("id", "text")  # the row: keys may be null or repeat
    )
    decided, undecided = repeated_windows(rows.select("ref", "text"), span, gram)
    heavy = staged(undecided.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > HEAVY).select("token", F.lit(True).alias("heavy")), "heavy")
    asked = (
        undecided.join(heavy, "token", "left")
        .withColumn("heavy", F.coalesce("heavy", F.lit(False)))
        .groupBy("ref")
        .agg(F.collect_list(F.struct("token", "heavy", "first", "last")).alias("asked"))
    )
    bodies = rows.join(asked, "ref").select("id", "ref", "text", "asked").mapInArrow(
        _bodies(span), "key long, heavy boolean, ref long, first int, body binary"
    )
    groups = max(1, undecided.count() // 5_000)
    windows = decided.unionByName(
        bodies.where("not heavy")
        .withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)))
        .groupBy("group")
        .applyInArrow(_equal_windows(span), "ref long, first int, last int")
    )
    if not heavy.isEmpty():
        single = bodies.where("heavy")
        again = single.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
        windows = windows.unionByName(single.join(again, "key").select("ref", "first", F.col("first").alias("last")))
    per_row = windows.groupBy("ref").agg(F.collect_set(F.struct("first", "last")).alias("windows"))
    kept = rows.join(per_row, "ref", "left").select("id", "ref", "text", "windows")
    return kept.mapInArrow(
        _removed(span), f"id {docs.schema[key].dataType.simpleString()}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    ).withColumnRenamed("id", key)
