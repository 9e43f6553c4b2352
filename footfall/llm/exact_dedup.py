"""Exact dedup by skew-safe combining.

Copies are combined three times, each time by digest *and* whole text: inside a task,
then in groups salted by the task's number, then over all salts. A text that makes up
a third of all rows therefore reaches a shuffle once per task and the last step once
per salt. Only then do the single documents meet the winners again, by digests alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import staged, unused, whole_text, without

SALTS = 32


def copy_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per different text: ``digest``, ``text``, ``keep_id``, ``group_size``.

    The salt is a number of the task, so the combining inside a task is not thinned out by it.
    """
    local = docs.select(
        F.col(key).alias("id"),
        whole_text(text).alias("text"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    salted = local.groupBy("digest", "text", "salt").agg(F.max("id").alias("id"), F.count("*").alias("n"))
    return salted.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per input row: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the row with the largest key stays. A null text counts as empty. A null
    key never wins against a key; where a group has null keys only, all of its rows stay,
    as nothing tells them apart. Rows that repeat both key and text all carry the same answer.
    An empty table gives no rows; further columns are ignored.
    """
    whole = whole_text(text)
    # Which rows are copies was settled on whole texts above. Here a second digest and the
    # length stand beside the first, so no text is shuffled to hand the answer out.
    prints = ["digest", "second", "length"]
    marks = lambda t: [F.xxhash64(t).alias("second"), F.length(t).alias("length")]
    several = (
        copy_groups(docs, text, key, salts)
        .where("group_size > 1")
        .select("digest", *marks(F.col("text")), "keep_id", "group_size")
    )
    rows = docs.select(F.col(key), F.unhex(F.sha2(whole, 256)).alias("digest"), *marks(whole))
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col(key)).otherwise(F.col("keep_id"))
    return rows.join(several, prints, "left").select(
        key,
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col(key).eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns.

    Of rows that repeat key and text one stays, whichever it is. Rows with a null key stay
    where no keyed row has their text, one of each text.
    """
    name, id_, digest = (unused(docs, n) for n in ("_digest", "_key", "_sha"))
    report = staged(exact_copies(docs, text, key), "copies")
    # Keys say which rows go, so a keyless copy and a key with several texts are settled by digests.
    odd = report.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1).select(key)
    odd = staged(odd.unionByName(report.where(F.col(key).isNull()).select(key).limit(1)).distinct(), "odd")
    plain = without(docs, report.where("not kept").select(key).unionByName(odd), key)
    if odd.isEmpty():
        return plain
    keys = odd.withColumnRenamed(key, id_)
    rows = docs.join(keys, F.col(key).eqNullSafe(F.col(id_)), "left_semi").withColumn(name, F.sha2(whole_text(text), 256))
    kept = report.where("kept").select(F.col(key).alias(id_), F.col("text_sha256").alias(digest)).distinct()
    same = F.col(key).eqNullSafe(F.col(id_)) & (F.col(name) == F.col(digest))
    settled = rows.join(kept, same, "left_semi").dropDuplicates([key, name]).drop(name)
    return plain.unionByName(settled)
