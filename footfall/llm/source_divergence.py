"""Source divergence audit: how far the sources of a language differ in the terms they use.

Documents are exact sparse count vectors over a vocabulary per language: the terms in a least number
of its documents, however many these are. Vectors are summed per language and source as a
summarizer does, into each term's ``sum`` and its number of non-zero documents. The latter also
says which terms are kept, so one scan does for vocabulary and vectors, and no vocabulary stands
on the driver or in a broadcast. Sums are rows (group, term, count), never dense arrays. Pairs of
sources are compared in blocks of terms, each a small matrix of terms by sources. All arithmetic
is on whole numbers.

``pyspark.ml``'s ``CountVectorizer`` (least document frequency 30, largest vocabulary) gives the same
vectors, but holds the vocabulary on the driver, reads texts twice and takes twice the CPU time
that is allowed; see the README.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.shared import ascii_lower, staged, whole_text

#: What stands between terms: ASCII other than letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of its language that a kept term is in, at least.
MIN_DOCS = 30
#: Ranks of the ``term`` part.
TOP = 50
SCALE, PRIOR = 1_000_000_000, 5
#: Cells of one block of terms by sources that are compared at a time.
CELLS = 1 << 16


def _tokens(docs: DataFrame) -> DataFrame:
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    found = F.array_remove(F.split(ascii_lower(whole_text()), BETWEEN), "")
    return docs.select(known("lang").alias("lang"), known("source").alias("source"), found.alias("tokens"))


def vector_sums(docs: DataFrame) -> DataFrame:
    """Sums of the documents' count vectors per group: ``lang``, ``source``, ``term``, ``count``, ``nonzeros``.

    A document's terms are sorted, so that the first of equal ones is its entry of the vector, and
    the entry's count is what comes with it. Both are added up inside the task before any shuffle.
    """
    rows = _tokens(docs).withColumn("tokens", F.sort_array("tokens"))
    each = rows.select("lang", "source", "tokens", F.posexplode("tokens").alias("at", "term"))
    first = (F.col("at") == 0) | (F.col("term") != F.get("tokens", F.col("at") - 1))
    each = each.select("lang", "source", "term", first.cast("long").alias("first"))
    return each.groupBy("lang", "source", "term").agg(F.count("*").alias("count"), F.sum("first").alias("nonzeros"))


def _probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), in decimals that hold any count."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(20,0)")
    return F.call_function("div", above, (total + PRIOR * terms).cast("decimal(20,0)")).cast("long") + 1


def _pair_sums(sums: DataFrame, groups: DataFrame) -> DataFrame:
    """Sum of |p - q| over the kept terms for each two sources of a language that keeps terms.

    A block has the rows of some terms; where a source does not use a term, its probability is that
    of a count of 0. Blocks have about ``CELLS`` cells, however many sources or terms there are.
    """
    per_lang = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    numbered = groups.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    numbered = staged(numbered.join(per_lang, "lang").select("lang", "source", "at", "nothing", "n_sources"), "groups")
    blocks = F.ceil(F.col("terms") * F.col("n_sources") / F.lit(CELLS))
    block = F.pmod(F.xxhash64("term"), F.greatest(blocks, F.lit(1)))
    rows = sums.join(numbered.select("lang", "source", "at", "n_sources"), ["lang", "source"])
    rows = rows.select("lang", block.alias("block"), "term", "at", "n_sources", F.lit(None).cast("long").alias("nothing"), "p")
    # Each block gets the probabilities of an unused term, one row per source.
    used = rows.select("lang", "block").distinct()
    empty = used.join(numbered, "lang").select(
        "lang", "block", F.lit(None).cast("string").alias("term"), "at", "n_sources", "nothing", F.lit(None).cast("long").alias("p")
    )

    def compare(group: pa.Table) -> pa.Table:
        at = group.column("at").to_numpy()
        p = group.column("p").to_pandas().to_numpy(dtype="float64", na_value=-1).astype(np.int64)
        none = group.column("nothing").to_pandas().to_numpy(dtype="float64", na_value=-1).astype(np.int64)
        n = int(group.column("n_sources")[0].as_py())
        base = np.zeros(n, np.int64)
        base[at[none >= 0]] = none[none >= 0]
        real = p >= 0
        codes = group.column("term").filter(pa.array(real)).combine_chunks().dictionary_encode()
        place = codes.indices.to_numpy()
        matrix = np.repeat(base[:, None], len(codes.dictionary), axis=1)
        matrix[at[real], place] = p[real]
        a, b, values = [], [], []
        for one in range(n):
            for begin in range(one + 1, n, 64):
                others = np.arange(begin, min(n, begin + 64))
                a.append(np.full(len(others), one, np.int64))
                b.append(others)
                values.append(np.abs(matrix[others] - matrix[one]).sum(axis=1))
        joined = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        lang = pa.array([group.column("lang")[0].as_py()] * len(joined(a)), pa.string())
        return pa.table([lang, joined(a).astype(np.int32), joined(b).astype(np.int32), joined(values)], names=["lang", "a", "b", "value"])

    cells = rows.unionByName(empty).groupBy("lang", "block").applyInArrow(compare, "lang string, a int, b int, value long")
    totals = cells.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    name = lambda side: numbered.select("lang", F.col("at").alias(side), F.col("source").alias(f"{side}_source"))
    return totals.join(name("a"), ["lang", "a"]).join(name("b"), ["lang", "b"]).select("lang", "a_source", "b_source", "value")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair``: every other source of the language, by how far apart the two are over all kept
    terms. Part ``term``: the ``top`` terms that the source uses more than its language does.

    Null text, lang and source are empty strings, which are a language and a source of their own.
    A group without a kept term has all counts 0. A language that keeps no term gives pairs of
    value 0. Of equal values the item that is less in UTF-8 comes first. A row is a document, also
    if it repeats another's id or text. An empty table gives no rows; further columns are ignored.
    """
    docs = docs.select("text", "lang", "source")
    whole = staged(vector_sums(docs), "sums")
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    occurring = docs.select(known("lang").alias("lang"), known("source").alias("source")).distinct()
    in_lang = whole.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("nonzeros").alias("in_docs"))
    in_lang = staged(in_lang.where(F.col("in_docs") >= min_docs).drop("in_docs"), "vocabulary")
    counts = staged(whole.drop("nonzeros").join(in_lang.drop("lang_count"), ["lang", "term"]), "counts")
    langs = in_lang.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_count").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    none = F.lit(0).cast("long")
    groups = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "terms", "lang_total")]
    )
    groups = staged(groups.withColumn("nothing", F.when(F.col("terms") > 0, _probability(none, F.col("total"), F.col("terms")))), "groups")

    sums = counts.join(groups.drop("nothing"), ["lang", "source"]).withColumn("p", _probability(F.col("count"), F.col("total"), F.col("terms")))
    apart = _pair_sums(sums.select("lang", "source", "term", "terms", "p"), groups.where("terms > 0").select("lang", "source", "nothing"))
    bare = groups.where("terms = 0").select("lang", "source")
    alone = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = (
        apart.select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), "value")
        .unionByName(apart.select("lang", F.col("b_source").alias("source"), F.col("a_source").alias("item"), "value"))
        .unionByName(alone.withColumn("value", none))
    )
    shares = in_lang.join(langs, "lang").select("lang", "term", _probability(F.col("lang_count"), F.col("lang_total"), F.col("terms")).alias("q"))
    more = sums.join(shares, ["lang", "term"]).where("p > q")
    terms = more.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))
