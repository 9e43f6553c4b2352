"""Language ID: multinomial naive Bayes over hashed character n-grams.

Counts per language are made by Spark from a bounded, documented sample of the labelled
rows; the log-probability matrix (buckets x languages) is broadcast, and batches of texts
are scored in numpy by summing the matrix rows of all their n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import held_out, unused, whole_text

#: N-gram lengths, bits of the hash, rows learned from per language (about), and what is accepted.
LENGTHS = (1, 2, 3)
BITS = 16
PER_LANGUAGE = 5_000
MAX_LANGUAGES = 1_000
SURE = 0.5
UNKNOWN = "und"

_NOTHING = 1 << BITS  # the bucket of places where no n-gram begins
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)  # odd numbers for hashing
_LETTER = regex.compile(r"\p{L}")  # digits, fractions and numeric signs are none
_BLOCK = 1 << 18


def _pieces(texts: list[str], size: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of about ``size`` characters: text numbers, starts, and per place the characters and room ahead.

    Long texts go over several blocks; a piece carries the next characters too, so no n-gram is lost.
    """
    more = max(LENGTHS) - 1
    owners, parts, fresh, total = [], [], [], 0
    for number, text in enumerate(texts):
        for at in range(0, len(text), size):
            part = text[at : at + size + more]
            owners.append(number)
            parts.append(part)
            fresh.append(min(size, len(text) - at))
            total += len(part)
            if total >= size:
                yield _block(owners, parts, fresh)
                owners, parts, fresh, total = [], [], [], 0
    if parts:
        yield _block(owners, parts, fresh)


def _block(owners, parts, fresh):
    chars = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    place = np.arange(len(chars)) - np.repeat(starts, sizes)
    room = np.repeat(sizes, sizes) - place  # characters from here to the end of the piece
    room[place >= np.repeat(np.array(fresh), sizes)] = 0  # those belong to the next piece
    return owners, starts, chars, room


def _buckets(chars: np.ndarray, room: np.ndarray) -> Iterator[np.ndarray]:
    """The buckets of all n-grams, one array per length; ``_NOTHING`` where none begins."""
    for n in LENGTHS:
        mixed = np.full(len(chars), n, np.uint32)
        for k in range(n):
            mixed[: len(chars) - k] = (mixed[: len(chars) - k] ^ chars[k:]) * np.uint32(_FACTORS[k])
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(_FACTORS[0])
        buckets = (mixed >> np.uint32(32 - BITS)).astype(np.int32)
        buckets[room < n] = _NOTHING
        yield buckets


def _usable(text: str | None) -> str:
    return text.lower() if text and _LETTER.search(text) else ""


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix of log probabilities, from labelled rows that are not held out.

    Of each language all rows up to about ``per_language`` are used, beyond that a sample by
    a hash of the id; whole texts in any case.
    """
    rows = docs.where(~held_out(4) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((_NOTHING + 1, 0), np.float32)
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / sizes[lang]))])
    chance = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    sample = rows.where(chance < shares[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            texts = [_usable(t) for t in batch.column("text").to_pylist()]
            for lang in set(langs):
                own = sums.setdefault(lang, np.zeros(_NOTHING + 1, np.int64))
                for _, _, chars, room in _pieces([t for t, x in zip(texts, langs) if x == lang], _BLOCK):
                    for buckets in _buckets(chars, room):
                        own += np.bincount(buckets, minlength=_NOTHING + 1)
        if sums:
            yield pa.record_batch([list(sums), [v.tobytes() for v in sums.values()]], names=["lang", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, np.int64) for v in group.column("counts").to_pylist())
        return pa.table({"lang": [group.column("lang")[0].as_py()], "counts": [total.tobytes()]})

    counted = sample.mapInArrow(count, "lang string, counts binary").groupBy("lang")
    found = {r["lang"]: np.frombuffer(r["counts"], np.int64) for r in counted.applyInArrow(add, "lang string, counts binary").collect()}
    matrix = np.zeros((_NOTHING + 1, len(languages)), np.float32)
    for column, lang in enumerate(languages):
        counts = found[lang][:_NOTHING] if lang in found else np.zeros(_NOTHING)
        matrix[:_NOTHING, column] = np.log((counts + 0.5) / (counts.sum() + 0.5 * _NOTHING))
    return languages, matrix


def score_texts(texts: list[str], languages: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and its posterior probability (equal priors) for each text."""
    usable = [_usable(t) for t in texts]
    sums = np.zeros((len(texts), len(languages)))
    for owners, starts, chars, room in _pieces(usable, max(1 << 12, 4 * _BLOCK // max(4, len(languages)))):
        for buckets in _buckets(chars, room):
            np.add.at(sums, owners, np.add.reduceat(matrix[buckets], starts, axis=0, dtype=np.float64))
    best = sums.argmax(axis=1) if languages else np.zeros(len(texts), int)
    shares = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1) if languages else np.zeros(len(texts))
    known = [bool(t) and bool(languages) for t in usable]
    return [languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, shares, 0.0)


def predict(docs: DataFrame, text: Column, languages: list[str], matrix: np.ndarray) -> Column:
    """A struct column ``lang_pred``, ``score`` of a text column. The model is broadcast: its size is fixed by parameters."""
    model = docs.sparkSession.sparkContext.broadcast((languages, matrix))

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores = score_texts(texts.tolist(), *model.value)
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return predicted(text)


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``, learned from the same table.

    ``lang_pred`` is ``und`` with score 0 if the text is null or has no letter, or if there is
    nothing to learn from. Rows with null labels or ids are predicted like others. Of two equally
    likely languages the first by code point is taken. Repeated rows get the same answer; an
    empty table stays empty.
    """
    model, found = learn(docs), unused(docs, "_found")
    return (
        docs.withColumn("held_out", held_out(4))
        .withColumn(found, predict(docs, whole_text(), *model))
        .withColumns({"lang_pred": F.col(f"{found}.lang_pred"), "score": F.col(f"{found}.score")})
        .drop(found)
    )


def accepted(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """The rows whose language is recognised with at least ``sure``, with their columns as they came."""
    model, found = learn(docs), unused(docs, "_found")
    rows = docs.withColumn(found, predict(docs, whole_text(), *model))
    return rows.where((F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= sure)).drop(found)
