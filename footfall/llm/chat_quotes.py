"""Chat formatting by quotation linking.

Quoted lines start with ``>``, nested ones with several. Runs of lines of one level are a
passage. Each line of a passage is normalised and hashed, and joined to the latest earlier
message of the conversation that says this line itself; the message that most lines of a
passage lead to is its source. A message answers the source of its outermost passage, and
follows it in its thread. Quotes are taken out of the texts.

Only messages that quote, and the lines that are quoted, take part in joins. The latest
earlier line is found without pairing repeated lines: in blocks of turns, then over the
blocks' last turns. Threads come from pointer doubling, so rounds grow with the logarithm
of the longest chain of replies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.shared import staged, whole_text

_QUOTE = r"(?md)^[ \t]*>"
_MARK = r"^([ \t>]*>)"
_QUOTED_LINE = r"(?md)^[ \t]*>[^\n]*\n?"
#: Turns of a block within which lines are ordered; messages of one part of a conversation.
TURNS = 256
PART = 256


def _normal(line: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(line, r"\s+", " ")))


def _lines(rows: DataFrame) -> DataFrame:
    """One row per line: place, ``level`` of quotation, hash of the normalised line (null if it is blank)."""
    lines = rows.select("conv_id", "turn", "print", F.posexplode(F.split("_text", "\n")).alias("at", "line"))
    mark = F.regexp_extract("line", _MARK, 1)
    said = _normal(F.substring(F.col("line"), F.length(mark) + 1, F.length("line")))
    return lines.select(
        "conv_id",
        "turn",
        "print",
        "at",
        F.length(F.regexp_replace(mark, "[^>]", "")).alias("level"),
        F.when(said != "", F.md5(said.cast("binary"))).alias("hash"),
    )


def _passages(lines: DataFrame) -> DataFrame:
    """Quoted lines with the number of their passage: lines of one level beside each other."""
    message = Window.partitionBy("conv_id", "turn", "print").orderBy("at")
    fresh = F.coalesce((F.lag("level").over(message) != F.col("level")).cast("int"), F.lit(1))
    return lines.withColumn("passage", F.sum(fresh).over(message)).where("level > 0 and hash is not null")


def _sayers(quoted: DataFrame, messages: DataFrame) -> DataFrame:
    """``conv_id, hash, turn, source``: for each quoted line the latest earlier turn that says it itself."""
    keys = quoted.select("conv_id", "hash", "turn").distinct()
    talks = keys.select("conv_id").distinct()
    own = _lines(messages.join(talks, "conv_id", "left_semi")).where("level = 0 and hash is not null")
    own = own.join(keys.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    own = own.select("conv_id", "hash", "turn").distinct()
    both = keys.withColumn("said", F.lit(False)).unionByName(own.withColumn("said", F.lit(True)))
    both = staged(both.withColumn("block", F.floor(F.col("turn") / TURNS)), "lines")

    place = Window.partitionBy("conv_id", "hash", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max(F.when(F.col("said"), F.col("turn"))).over(place)).where("not said")
    order = Window.partitionBy("conv_id", "hash").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    far = (
        both.groupBy("conv_id", "hash", "block")
        .agg(F.max(F.when(F.col("said"), F.col("turn"))).alias("last"))
        .withColumn("far", F.max("last").over(order))
        .select("conv_id", "hash", "block", "far")
    )
    found = near.join(far, ["conv_id", "hash", "block"]).withColumn("source", F.coalesce("near", "far"))
    return found.where("source is not null").select("conv_id", "hash", "turn", "source")


def quote_links(messages: DataFrame) -> DataFrame:
    """One row per quoted passage: ``conv_id, turn, print, passage, level, lines, source, votes``.

    ``print`` tells messages of one turn apart. ``source`` is the turn that most lines lead to (the
    latest of equals), null unless at least half of the lines that are not blank lead there.
    """
    rows = _prepared(messages)
    quoted = staged(_passages(_lines(rows.where(F.col("_text").rlike(_QUOTE)).dropDuplicates(["conv_id", "turn", "print"]))), "quoted")
    passage = ["conv_id", "turn", "print", "passage"]
    sizes = quoted.groupBy(*passage).agg(F.first("level").alias("level"), F.count("*").alias("lines"))
    votes = quoted.join(_sayers(quoted, rows), ["conv_id", "hash", "turn"]).groupBy(*passage, "source").agg(F.count("*").alias("votes"))
    best = votes.groupBy(*passage).agg(F.max(F.struct("votes", "source")).alias("best"))
    enough = 2 * F.col("best.votes") >= F.col("lines")
    # Only passages with a conversation and a turn can have a source, so nulls need not meet here.
    return sizes.join(best, passage, "left").select(
        *passage, "level", "lines", F.when(enough, F.col("best.source")).alias("source"), F.when(enough, F.col("best.votes")).alias("votes")
    )


def _prepared(messages: DataFrame) -> DataFrame:
    text = F.regexp_replace(whole_text("text"), "\r\n?", "\n")
    return messages.withColumn("_text", text).withColumn("print", F.xxhash64("_text"))


def _threads(replies: DataFrame) -> DataFrame:
    """``conv_id, turn, thread, depth`` for turns that answer another, from ``conv_id, turn, reply_to``."""
    nodes = replies.groupBy("conv_id", "turn").agg(F.max("reply_to").alias("thread")).withColumn("depth", F.lit(1).cast("long"))
    while True:
        nodes = staged(nodes, "threads")
        above = nodes.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("root"), F.col("depth").alias("more"))
        longer = nodes.join(above, ["conv_id", "thread"], "left")
        if longer.where("root is not null").isEmpty():
            return nodes
        nodes = longer.select(
            "conv_id", "turn", F.coalesce("root", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
        )


def format_chat(messages: DataFrame) -> DataFrame:
    """One row per message: ``conv_id, turn, role, passages, linked, reply_to, thread, depth, body, formatted``.

    ``reply_to`` is the turn that the outermost quoted passage with a source comes from (of
    equals the first), ``thread`` the turn at the root of its chain of replies and ``depth`` its length; a
    message that answers none is its own root. In the order ``thread, turn`` each conversation
    stands thread by thread and each reply after what it answers. ``body`` is the text without quoted
    lines, trimmed; ``formatted`` puts the role before it.

    A null text is empty, a null role is written as ``unknown``. Messages without conversation or turn
    are not linked. Repeated rows are answered alike, each; several texts of one turn are judged
    each, and the turn then counts as answering the latest of what they answer. Empty tables give no rows;
    further columns are ignored.
    """
    rows = _prepared(messages.select("conv_id", "turn", "role", "text"))
    quoting = F.col("_text").rlike(_QUOTE)
    links = staged(quote_links(messages.select("conv_id", "turn", "role", "text")), "links")
    found = F.when(F.col("source").isNotNull(), F.struct("level", "passage", "source"))
    message = ["conv_id", "turn", "print"]
    answers = links.groupBy(*message).agg(
        F.count("*").alias("passages"), F.count("source").alias("linked"), F.min(found)["source"].alias("reply_to")
    )
    threads = _threads(answers.where("reply_to is not null").select("conv_id", "turn", "reply_to"))
    named = answers.withColumnsRenamed({c: f"_{c}" for c in message})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in message]  # conversation or turn may be null
    with_quotes = rows.where(quoting).join(named, same, "left").join(threads, ["conv_id", "turn"], "left")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast(messages.schema["turn"].dataType)
    answering = F.col("reply_to").isNotNull()
    with_quotes = with_quotes.withColumns(
        {
            "passages": F.coalesce("passages", zero),
            "linked": F.coalesce("linked", zero),
            "thread": F.when(answering, F.col("thread")).otherwise(F.col("turn")),
            "depth": F.when(answering, F.col("depth")).otherwise(zero),
            "body": F.regexp_replace("_text", _QUOTED_LINE, ""),
        }
    )
    without = rows.where(~quoting).withColumns(
        {"passages": zero, "linked": zero, "reply_to": none, "thread": F.col("turn"), "depth": zero, "body": F.col("_text")}
    )
    body = F.regexp_replace("body", r"^\s+|\s+$", "")
    names = ["conv_id", "turn", "role", "passages", "linked", "reply_to", "thread", "depth"]
    said = with_quotes.select(*names, "body").unionByName(without.select(*names, "body")).withColumn("body", body)
    return said.withColumn("formatted", F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("body")))


def conversations(messages: DataFrame) -> DataFrame:
    """Threads as texts: ``conv_id, thread, part, n_messages, text``, in parts of ``PART`` turns, so no row grows without bound."""
    said = format_chat(messages).withColumn("part", F.floor(F.col("turn") / PART))
    entries = F.array_sort(F.collect_list(F.struct("turn", "formatted")))
    return said.groupBy("conv_id", "thread", "part").agg(
        F.count("*").alias("n_messages"), F.array_join(F.transform(entries, lambda x: x["formatted"]), "\n").alias("text")
    )
