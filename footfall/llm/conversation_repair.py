"""Conversation structure repair: the cheapest edits after which roles read ``(s?(ua)+)?``.

Rows are put in order and read as symbols, one character a row, in blocks, so a conversation of
any length is spread over tasks. Different symbol strings are compressed by Re-Pair in rounds:
each round counts pairs over all strings and makes rules of the most frequent ones. A rule has
one min-plus matrix (``repair_grammar``), and each different string is solved once, for all
conversations that share it. The edits are then applied to the texts as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.repair_grammar import DELETE, DOOMED, INSERT, KEEP, Solver, encode, pair_counts, roles_of
from footfall.llm.shared import staged

#: Rows a block of symbols holds at most; a conversation has as many blocks as it needs.
BLOCK = 4_096
#: Rounds of Re-Pair and rules made in each. They bound the grammar that tasks get; symbols that no
#: rule covers are multiplied one by one, so results do not depend on them.
ROUNDS, PER_ROUND = 4, 64
#: Characters or rows after which a task gives out a batch of messages.
BATCH_CHARS, BATCH_ROWS = 1 << 22, 4_096

SPACES = " \t\n\x0b\f\r"
STATS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, by the crc32 of conversation and turn; ``copies`` is 0 for a lost row, 2 for a repeated one."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    return rows.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(known("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text")).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"),
    )


def _folded(rows: DataFrame, copies: Column) -> DataFrame:
    """Equal rows once with their number; a row of no copies stands for its conversation only."""
    there = copies > 0
    known = lambda c: F.when(there, F.coalesce(F.col(c).cast("string"), F.lit(" ")))
    named = rows.select(
        "conv_id", F.when(there, F.col("turn")).alias("turn"), known("role").alias("role"), known("text").alias("text"),
        copies.cast("long").alias("n"),
    )
    folded = named.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    return staged(folded.withColumn("digest", F.sha2("text", 256)), "messages")


def _symbols(folded: DataFrame) -> DataFrame:
    """One row per different message, without its text: initial, symbol and faults."""
    said = F.rtrim("text", F.lit(SPACES))
    last = F.substring(said, -1, 1)
    initial = F.substring("role", 1, 1)
    slim = folded.select(
        "conv_id", "turn", "role", "digest", "n", (said == "").alias("blank"), last.isin(".", "!", "?").alias("ended"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
    )
    # The earliest turn with this role and text; unknown turns come first.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = slim.where("not blank").groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first"))
    firsts = firsts.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    marked = slim.join(firsts, same, "left")
    again = F.coalesce(F.col("first") != turn, F.lit(False))
    return marked.select("conv_id", "turn", "role", "digest", "n", "initial", "blank", "ended", again.alias("again"))


_BLOCK_STATS = "at long, symbols string, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, head string, tail string"
_LEGAL = ("su", "ua", "au")


class _Block:
    """Symbols and counts of consecutive rows of one conversation."""

    def __init__(self, conv):
        self.conv, self.rows, self.parts = conv, 0, []
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.head = self.tail = ""

    def add(self, turn, n, initial, blank, ended, again) -> None:
        if not n:
            return
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        self.illegal += n - 1 + bool(self.tail and self.tail + initial not in _LEGAL)
        self.head, self.tail = self.head or initial, initial
        self.rows += n
        if blank:
            self.blank += n
            self.parts.append(DOOMED * n)
            return
        # Further copies of a row repeat it.
        self.duplicate += n - 1 + again
        self.truncated += not again and not ended
        self.parts.append((DOOMED if again else initial if ended else initial.upper()) + DOOMED * (n - 1))

    def values(self, at: int) -> tuple:
        return (self.conv, at, "".join(self.parts), self.low, self.high, self.turns, self.blank, self.duplicate,
                self.truncated, self.illegal, self.head, self.tail)


def _blocks(symbols: DataFrame) -> DataFrame:
    schema = T.StructType([symbols.schema["conv_id"], *T._parse_datatype_string(_BLOCK_STATS).fields])
    names = schema.fieldNames()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32  # ranges follow each other in the order of tasks
        block, kind = None, None

        def given(full: list[_Block]) -> pa.RecordBatch:
            nonlocal at
            rows = []
            for one in full:
                rows.append(one.values(at))
                at += 1
            columns = list(zip(*rows))
            types = [kind, pa.int64(), pa.string(), *[pa.int64()] * 7, pa.string(), pa.string()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            full, kind = [], batch.schema.field("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "n", "initial", "blank", "ended", "again")]
            for conv, *row in zip(*columns):
                if block is None or conv != block.conv or block.rows >= BLOCK:
                    full += [block] if block else []
                    block = _Block(conv)
                block.add(*row)
            if full:
                yield given(full)
        if block:
            yield given([block])

    order = ["conv_id", "turn", "role", "digest"]
    ranged = staged(symbols, "symbols").repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(read, schema)


def _conversations(blocks: DataFrame) -> DataFrame:
    """One row per conversation: its symbols, one byte a row, and its counts."""
    names = [n for n in blocks.columns if n != "conv_id"]
    parts = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("all"))
    parts = parts.withColumn("all", F.filter("all", lambda x: x["symbols"] != ""))
    seams = F.when(F.size("all") > 1, F.sequence(F.lit(1), F.size("all") - 1)).otherwise(F.array().cast("array<int>"))
    count = lambda test: F.size(F.filter(seams, lambda i: test(F.get("all", i - 1), F.get("all", i)))).cast("long")
    total = lambda c: F.aggregate("all", F.lit(0).cast("long"), lambda acc, x: acc + x[c])
    twice = count(lambda a, b: a["high"] == b["low"])
    wrong = count(lambda a, b: ~F.concat(a["tail"], b["head"]).isin(*_LEGAL))
    low, high = F.array_min(F.transform("all", lambda x: x["low"])), F.array_max(F.transform("all", lambda x: x["high"]))
    return parts.select(
        "conv_id",
        F.array_join(F.transform("all", lambda x: x["symbols"]), "").alias("symbols"),
        F.coalesce(high - low + 1 - (total("turns") - twice), F.lit(0).cast("long")).alias("gaps"),
        total("blank").alias("blank"), total("duplicate").alias("duplicate"), total("truncated").alias("truncated"),
        (total("illegal") + wrong).alias("illegal"),
    )


def learn_grammar(patterns: DataFrame, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> list[str]:
    """Re-Pair in rounds: pairs are counted over all strings, the most frequent become rules."""
    rules: list[str] = []
    for _ in range(rounds):
        known = list(rules)

        def count(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = pair_counts(encode(s, known) for s in batch.column("symbols").to_pylist())
                yield pa.record_batch([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["pair", "n"])

        pairs = patterns.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        new = [r["pair"] for r in pairs.orderBy(F.desc("n"), "pair").limit(per_round).collect()]
        if not new:
            break
        rules += new
    return rules


def _solved(patterns: DataFrame, rules: list[str]) -> DataFrame:
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver(rules)
        for batch in batches:
            found = [solver.solve(s) for s in batch.column("symbols").to_pylist()]
            costs, audits = pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())
            yield pa.record_batch([batch.column("symbols"), costs, audits], names=["symbols", "cost", "audit"])

    return patterns.mapInArrow(solve, "symbols string, cost long, audit string")


def _messages(folded: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired messages in order; ``place`` counts from 1 in each conversation."""
    nothing = F.lit(None).cast("string")
    rows = folded.where("n > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "n", nothing.alias("audit"))
    heads = audits.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast(folded.schema["turn"].dataType).alias("turn"), nothing.alias("role"),
        nothing.alias("digest"), nothing.alias("text"), F.lit(0).cast("long").alias("n"), "audit",
    )
    schema = T.StructType([folded.schema["conv_id"], *T._parse_datatype_string("place long, edit string, role string, text string").fields])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, edits, roles, at, place = None, "", [], 0, 0
        out, chars, kind = [], 0, None

        def put(role: str, text: str, op: str) -> None:
            nonlocal place, chars
            place += 1
            chars += len(text)
            out.append((conv, place, op, role, text))

        def insert() -> None:
            nonlocal at
            while at < len(edits) and edits[at] == INSERT:
                put(roles[at], "", INSERT)
                at += 1

        def given() -> pa.RecordBatch:
            nonlocal chars
            columns = list(zip(*out)) or [()] * 5
            out.clear()
            chars = 0
            types = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=schema.fieldNames())

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text", "n", "audit")]
            for name, head, role, text, n, audit in zip(*columns):
                if head == 0:
                    insert()
                    conv, edits, roles, at, place = name, audit, roles_of(audit), 0, 0
                    continue
                for _ in range(n):
                    insert()
                    op = edits[at]
                    if op != DELETE:
                        put(role if op == KEEP else roles[at], text, op)
                    at += 1
                if chars >= BATCH_CHARS or len(out) >= BATCH_ROWS:
                    yield given()
        insert()
        if out:
            yield given()

    order = ["conv_id", "kind", "turn", "role", "digest"]
    return heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(edit, schema)


def repair(rows: DataFrame, copies: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Audits and repaired messages of ``conv_id, turn, role, text`` rows.

    Audits, one row per conversation: ``gaps`` in the turns, rows by their first fault (``blank``,
    ``duplicate``, ``truncated``), ``illegal`` neighbours, ``cost`` and ``audit``, the edits' letters.
    Messages: ``conv_id``, ``place``, ``edit``, ``role``, ``text``.

    A null role or text is one space; null turns come first; rows without ``conv_id`` are one
    conversation. Ties of a turn stand by role, then by the SHA-256 of the text, copies of one row
    side by side. A role without a first letter s, u or a cannot be kept. ``copies`` says how often a
    row stands; conversations whose rows all have none get zeros, an empty audit and no message. An
    empty table gives no rows. Further columns are ignored. Texts of any length are handled whole:
    they pass through a task row by row, in the order that a conversation's digest needs. What
    stands together for a conversation is one byte a row, as in its audit.
    """
    folded = _folded(rows, F.lit(1) if copies is None else copies)
    found = staged(_conversations(_blocks(_symbols(folded))), "conversations")
    patterns = staged(found.select("symbols").distinct(), "patterns")
    solved = staged(_solved(patterns, learn_grammar(patterns)), "solved")
    audits = staged(found.join(solved, "symbols").select("conv_id", *STATS, "cost", "audit"), "audits")
    return audits, _messages(folded, audits)


def digests(messages: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines. Messages come in order, as ``repair`` gives them."""
    schema = T.StructType([messages.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, kind = None, None, None
        batch_of = lambda done: pa.record_batch(
            [pa.array([c for c, _ in done], kind), pa.array([d.hexdigest() for _, d in done], pa.string())], names=schema.fieldNames()
        )
        for batch in batches:
            done, kind = [], batch.schema.field("conv_id").type
            for name, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]):
                if place == 1:
                    if digest:
                        done.append((conv, digest))
                    conv, digest = name, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(role.encode())
                digest.update(b":")
                digest.update(text.encode())
            if done:
                yield batch_of(done)
        if digest:
            yield batch_of([(conv, digest)])

    return messages.mapInArrow(add, schema)


def audit_report(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """The audits with the digest of the repaired conversation."""
    audits, messages = repair(rows, copies)
    found = digests(messages).withColumnRenamed("conv_id", "_conv")
    joined = audits.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))
