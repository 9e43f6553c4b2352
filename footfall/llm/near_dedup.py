"""Near-dedup by MinHash with tensored banding.

A table of locality-sensitive hashing wants several minhashes as its key. Here the keys of
``SIDE * SIDE`` tables are all pairs of one half key of a first collection and one of a
second, each half made of ``HALF`` minhashes: 2 * SIDE * HALF minhashes do the work of
SIDE * SIDE * 2 * HALF. Two documents of similarity s meet in no table with probability
below 2 * (1 - s**HALF)**SIDE, which is 1e-4 at 0.75 and 1e-6 at 0.85.

All that meets is decided on full shingle sets:

1. Documents with the same set are one class; only its first goes on. Classes are the nodes
   of links; those that share a key are linked with each other.
2. Half keys that occur once can't meet, so tables are built from the others alone.
3. The star of a bucket is its member that meets most others over all tables: of edited
   copies the one they were made from. All members are compared with their stars, and links
   that hold are joined into components.
4. Members that met share a star. Stars whose members are still in several components are
   gone through pair by pair, in blocks, inside numpy and on full sets; only links come out.
   So no pairs of a group are written out, and no pair that met stays undecided.

A sketch is a one-permutation minhash of the set: one pass puts the least shingle of each of
``BINS`` bins into a byte. It only spares comparisons that can't succeed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import components
from footfall.llm.shared import staged, without
from footfall.llm.words import mixed, shingles, word_blocks

WORDS = 5
PERCENT = 75
SIDE = 12
HALF = 2
#: Bins of a sketch, and by how many standard deviations a similarity of 0.75 may be underestimated.
BINS = 256
DEVIATIONS = 4.0
#: Shingles of a block of one star's members (about); two blocks are compared in one task.
BLOCK = 1 << 20

_HASHES = 2 * SIDE * HALF
_SEEDS = np.random.RandomState(23).randint(1, 1 << 62, (2, _HASHES)).astype(np.uint64)
_SIGNED = "id long, n_shingles long, print1 long, print2 long, sketch binary, halves array<long>"
_PRINTS = ["n_shingles", "print1", "print2"]


def _sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingles of each text."""
    for row, words, bounds in word_blocks(texts):
        for k in range(len(bounds) - 1):
            yield row + k, np.unique(shingles(words[bounds[k] : bounds[k + 1]], WORDS))


def _half_keys(signatures: np.ndarray) -> np.ndarray:
    """(rows, 2 * SIDE) half keys; the first SIDE belong to the first collection."""
    keys = np.zeros((len(signatures), 2 * SIDE), np.uint64)
    for k in range(HALF):
        keys = mixed(keys + signatures[:, k::HALF].astype(np.uint64), 0x51ED + k)
    return mixed(keys + np.arange(2 * SIDE, dtype=np.uint64))


def _signed(sets: list[np.ndarray]) -> np.ndarray:
    """(rows, hashes) minhashes of sets that are not empty."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    values, out = np.concatenate(sets), np.empty((len(sets), _HASHES), np.uint32)
    for k in range(_HASHES):
        hashed = (values ^ _SEEDS[0, k]) * (_SEEDS[1, k] | np.uint64(1))
        out[:, k] = np.minimum.reduceat(hashed, starts) >> np.uint64(32)
    return out


def _sketch(values: np.ndarray) -> bytes:
    """The least shingle of each bin in one byte, 0 for an empty bin; ``values`` are sorted."""
    spread = values[::-1]  # the least comes last and stays
    bins = np.zeros(BINS, np.uint8)
    bins[(spread & np.uint64(BINS - 1)).astype(np.intp)] = (spread >> np.uint64(8)) % np.uint64(255) + np.uint64(1)
    return bins.tobytes()


def _alike(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether sketches (rows of bins) allow a similarity of 0.75."""
    filled = ((first > 0) | (second > 0)).sum(axis=-1)
    equal = ((first == second) & (first > 0)).sum(axis=-1)
    limit = PERCENT / 100
    return equal >= limit * filled - DEVIATIONS * np.sqrt(limit * (1 - limit) * filled)


def _print(values: np.ndarray, seed: int) -> int:
    """One of the two hashes that, with its size, tell a set from all others."""
    return int(mixed(values, seed).sum(dtype=np.uint64).view(np.int64))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _SIGNED.split(", ")]

    def out(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        full = [i for i, s in enumerate(sets) if len(s)]
        signatures = _signed([sets[i] for i in full]) if full else np.zeros((0, _HASHES), np.uint32)
        halves = _half_keys(signatures).view(np.int64)
        place = {i: k for k, i in enumerate(full)}
        total = lambda seed: pa.array([_print(s, seed) for s in sets], pa.int64())
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([len(s) for s in sets], pa.int64()),
            total(1),
            total(2),
            pa.array([_sketch(s) for s in sets], pa.binary()),
            pa.array([halves[place[i]] if i in place else None for i in range(len(sets))], pa.list_(pa.int64())),
        ]
        return pa.record_batch(columns, names=names)

    for batch in batches:
        ids, held, sets, size = batch.column(0).to_pylist(), [], [], 0
        for row, shingled in _sets(batch.column(1)):
            held.append(ids[row])
            sets.append(shingled)
            size += len(shingled)
            if size > 1 << 19:
                yield out(held, sets)
                held, sets, size = [], [], 0
        if sets:
            yield out(held, sets)


def _list_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of rows (text, node, prints) of a class that is wanted.

    A row without a node has a key of several wanted classes; its prints say which it is of.
    """
    for batch in batches:
        nodes, wanted = batch.column(1).to_pylist(), list(zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))))
        held, prints, sets, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            offsets = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            values = pa.array(np.concatenate(sets).view(np.int64), pa.int64())
            columns = [pa.array(held, pa.int64()), *(pa.array([p[i] for p in prints], pa.int64()) for i in range(3))]
            return pa.record_batch([*columns, pa.ListArray.from_arrays(offsets, values)], names=["node", *_PRINTS, "shingles"])

        for row, shingled in _sets(batch.column(0)):
            own = (len(shingled), _print(shingled, 1), _print(shingled, 2))
            if not len(shingled) or (nodes[row] is not None and own != wanted[row]):
                continue  # another text under the key of a wanted class
            held.append(nodes[row])
            prints.append(own)
            sets.append(shingled)
            size += len(shingled)
            if size > 1 << 19:
                yield out()
                held, prints, sets, size = [], [], [], 0
        if sets:
            yield out()


def _wanted_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id`` (the node), ``shingles``: the set of each node in ``wanted`` (``id``, ``first``, prints)."""
    one = [F.when(F.min("id") == F.max("id"), F.min(c)).alias(c) for c in ("id", *_PRINTS)]
    keys = wanted.groupBy("first").agg(*one).withColumnRenamed("id", "node")
    # What is wanted grows with the corpus: never broadcast, and the same plan at every size.
    met = rows.join(keys.hint("merge"), F.col("id") == F.col("first")).select("text", "node", *_PRINTS)
    sets = met.mapInArrow(_list_sets, "node long, n_shingles long, print1 long, print2 long, shingles array<long>")
    sets = staged(sets, "listed")
    sure = sets.where("node is not null").select(F.col("node").alias("id"), "shingles")
    told = sets.where("node is null").join(wanted, _PRINTS).select("id", "shingles")
    return staged(sure.unionByName(told).dropDuplicates(["id"]), "sets")


def _stars(signed: DataFrame) -> DataFrame:
    """``id``, ``star``: the members of all buckets that have more than one, with the bucket's star, each pair once."""
    halves = signed.select("id", F.posexplode("halves").alias("half", "value"))
    again = halves.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value")
    # One key per collection must occur again; what is left of a document's halves is folded into two lists.
    lists = (
        halves.join(again, "value")
        .groupBy("id")
        .agg(
            F.collect_list(F.when(F.col("half") < SIDE, F.col("value"))).alias("first"),
            F.collect_list(F.when(F.col("half") >= SIDE, F.col("value"))).alias("second"),
        )
    )
    rows = lists.select("id", F.explode("first").alias("one"), "second").select("id", "one", F.explode("second").alias("two"))
    rows = staged(rows.select("id", F.xxhash64("one", "two").alias("bucket")), "tables")  # half keys differ by place
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    rows = staged(rows.join(sizes, "bucket"), "members")
    met = rows.groupBy("id").agg(F.sum("members").alias("met"))
    best = rows.join(met, "id").groupBy("bucket").agg(F.max(F.struct(F.col("met"), (-F.col("id")).alias("id"))).alias("best"))
    stars = rows.join(best.select("bucket", (-F.col("best.id")).alias("star")), "bucket")
    return staged(stars.select("id", "star").distinct(), "stars")


def _allowed(first: Column, second: Column) -> Column:
    @F.pandas_udf("boolean")
    def allowed(a: pd.Series, b: pd.Series) -> pd.Series:
        read = lambda s: np.frombuffer(b"".join(s), np.uint8).reshape(len(s), BINS)
        return pd.Series(_alike(read(a), read(b)), dtype=bool)

    return allowed(first, second)


def _star_links(stars: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a > b`` of a member and its star whose full sets are similar enough."""
    pairs = stars.where("id <> star").select(F.greatest("id", "star").alias("a"), F.least("id", "star").alias("b")).distinct()
    side = lambda x: signed.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    close = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
        .where(_allowed(F.col("sketch_a"), F.col("sketch_b")))
        .select("a", "b")
    )
    named = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"set_{x}"))
    both = staged(close, "close").join(named("a"), "a").join(named("b"), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return both.where(100 * shared >= PERCENT * union).select("a", "b")


def _across(group: pa.Table) -> pa.Table:
    """Links between different components in two blocks of a star's members (or one with itself)."""
    read = lambda name: group.column(name).to_numpy()
    ids, parts, sides = read("id"), read("part"), read("side")
    lists = group.column("shingles").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    starts = np.cumsum(sizes) - sizes
    _, values = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    alone = bool((sides == 2).any())
    rows, others = (np.arange(len(ids)),) * 2 if alone else (np.flatnonzero(sides == 0), np.flatnonzero(sides == 1))
    found: list[tuple[int, int]] = []
    if len(rows) and len(others):
        # Of one block, the rows of its largest component need no search of their own.
        names, counts = np.unique(parts, return_counts=True)
        searched = rows[parts[rows] != names[counts.argmax()]] if alone else rows
        has = np.zeros(values.max() + 1, bool)
        for r in searched:
            own = values[starts[r] : starts[r] + sizes[r]]
            low, high = np.minimum(sizes[others], sizes[r]), np.maximum(sizes[others], sizes[r])
            able = others[(parts[others] != parts[r]) & (100 * low >= PERCENT * high)]
            if not len(able):
                continue
            has[own] = True
            shared = np.add.reduceat(has[values], starts, dtype=np.int64)[able]
            has[own] = False
            linked = able[100 * shared >= PERCENT * (sizes[able] + sizes[r] - shared)]
            found += [(max(ids[r], x), min(ids[r], x)) for x in ids[linked].tolist()]
    found = sorted(set(found))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _left_over(stars: DataFrame, parts: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a > b`` between members of one star that are in different components."""
    members = stars.unionByName(stars.select(F.col("star").alias("id"), "star")).distinct()
    rows = members.join(parts.select(F.col("a").alias("id"), F.col("b").alias("low")), "id", "left")
    rows = rows.select("star", "id", F.coalesce("low", "id").alias("part")).join(signed.select("id", "n_shingles"), "id")
    several = (
        rows.groupBy("star")
        .agg(F.min("part").alias("p0"), F.max("part").alias("p1"), F.sum("n_shingles").alias("shingled"))
        .where("p0 < p1")
        .select("star", F.ceil(F.col("shingled") / BLOCK).alias("blocks"))
    )
    rows = rows.join(several, "star").withColumn("own", F.pmod(F.xxhash64("id"), "blocks"))
    # Block x meets every block y >= x: as side 0 where it is x, as side 1 where it is y, as 2 with itself.
    meets = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(F.col("own"), other).alias("x"),
            F.greatest(F.col("own"), other).alias("y"),
            F.when(other == F.col("own"), 2).when(F.col("own") < other, 0).otherwise(1).alias("side"),
        ),
    )
    dealt = rows.join(sets, "id").select("star", "id", "part", "shingles", F.inline(meets))
    return dealt.groupBy("star", "x", "y").applyInArrow(_across, "a long, b long").distinct()


def _key_links(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``a > b`` between the classes of each key that has several."""
    least = [F.min(c).alias(f"{c}_0") for c in _PRINTS]
    most = [F.max(c).alias(f"{c}_1") for c in _PRINTS]
    unlike = " or ".join(f"{c}_0 < {c}_1" for c in _PRINTS)
    several = full.where("id is not null").groupBy("id").agg(*least, *most).where(unlike).select("id")
    held = staged(full.join(several, "id").join(classes, _PRINTS).select("id", "node").distinct(), "held")
    lowest = held.groupBy("id").agg(F.min("node").alias("b"))
    return held.join(lowest, "id").where("node > b").select(F.col("node").alias("a"), "b").distinct()


def near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: key, ``n_shingles``, ``component_id``, ``kept``.

    A document's set holds its distinct runs of five words, or its whole sequence if it has
    fewer; documents are linked when 100 * shared >= 75 * union, and ``component_id`` is the
    smallest key that links lead to. A text without words (or null) is linked with nothing.
    Rows that repeat a key are one document: all of its texts are in one component, and a
    link of one of them is one of the document. A null key is no node: its rows join the
    component of a keyed document with the same set, or stand alone with a null component,
    and are kept only then. Ties do not arise, as a component is named by its smallest key.
    Texts of any length are read whole. An empty table gives no rows; further columns are
    ignored.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    signed = staged(rows.mapInArrow(_sign, _SIGNED), "signed")
    full = signed.where("n_shingles > 0")
    classes = full.groupBy(*_PRINTS).agg(F.min("id").alias("first"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    first = signed.join(classes, _PRINTS).where("id = first").dropDuplicates(["node"])
    firsts = staged(first.select(F.col("node").alias("id"), "first", *_PRINTS, "sketch", "halves"), "firsts")
    stars = _stars(firsts)
    firsts = firsts.drop("halves")
    met = stars.select("id").union(stars.select(F.col("star").alias("id"))).distinct()
    sets = _wanted_sets(rows, firsts.drop("sketch").join(met, "id", "left_semi"))
    found = _star_links(stars, firsts, sets).unionByName(_key_links(full, classes))
    links = components(found)
    more = _left_over(stars, links, firsts, sets)
    links = components(links.unionByName(more)).withColumnsRenamed({"a": "of", "b": "low"})
    # A component is named by the least key of its classes.
    linked = classes.join(links, F.col("node") == F.col("of"), "left").withColumn("low", F.coalesce("low", "node"))
    linked = staged(linked.select(*_PRINTS, "first", "low"), "linked")
    named = linked.groupBy("low").agg(F.min("first").alias("name"))
    # It is written, so the last join is one of two plain tables, in which Spark splits a large class.
    known = staged(linked.join(named, "low").select(*_PRINTS, "name"), "known")
    alone = F.col("n_shingles") == 0
    component = F.when(alone, F.col("id")).otherwise(F.col("name"))
    return signed.select("id", *_PRINTS).join(known, _PRINTS, "left").select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay (the smallest key of each component), with all their columns; keys are unique."""
    return without(docs, near_copies(docs, text, key).where("not kept").select(key), key)
