"""Token counts by a compiled finite-state tokenizer.

The merges of a byte-fallback BPE vocabulary are compiled, transition by transition as
texts need them, into a deterministic transducer: it reads characters and each transition
says by how many tokens the tokenisation of the prefix has grown (it may shrink). What it
rests on: the last token of a prefix is the only token of the vocabulary that ends there
and stays apart from the last token before it; so a state needs, for each place from which
a token may still reach forward, the last token there and how far its count lies behind.

A text is cut into chunks, each chunk becomes a map from the state before to the state and
count after, and the maps are composed by a prefix scan. A space after another character
brings every state to one and the same, so beyond its first such place (its head) a
chunk's map is a constant. A text without spaces keeps linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import whole_text

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
CHUNK = 1 << 16
#: Compiled states and counted words kept by a worker from batch to batch; beyond these it starts anew.
MAX_STATES = 400_000
MAX_WORDS = 1_000_000

_META = "▁"  # the vocabulary's sign for a space
_SYNC = re.compile("[^ ] ")
_SEGMENT = re.compile(" +[^ ]*")


class StateMap(NamedTuple):
    """What a chunk does to the state before it.

    ``head`` is read from the entry state. If ``sync``, the state then is forgotten, and the
    rest of the chunk adds ``count`` tokens and leaves ``exit``; else the chunk is its head.
    """

    head: str
    sync: bool
    count: int
    exit: tuple


#: Nothing is open, and nothing before can merge with what comes.
START = (("", "", 0),)


class Transducer:
    """Deterministic transducer of a BPE vocabulary ``{piece: score}``, spaces written as spaces."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.prefixes = {p[:i] for p in scores for i in range(1, len(p))}
        if any(c not in scores for p in scores for c in p):
            raise ValueError("a piece has a character that is no piece")
        if any(_SYNC.search(p) for p in scores):
            raise ValueError("a piece goes on over a space, so words can't be counted apart")
        self.apart: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.ids = {START: 0}
        self.keys = [START]
        self.edges: list[dict[str, tuple[int, int]]] = [{}]
        self.words = _Words(self)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by its definition: merge the best pair, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stays_apart(self, left: str, right: str) -> bool:
        """Whether ``right`` is a token after the token ``left`` (or after nothing)."""
        key = (left, right)
        if key not in self.apart:
            if len(self.apart) > 20 * MAX_STATES:
                self.apart.clear()
            self.apart[key] = self.merged(left + right) == ([left, right] if left else [right])
        return self.apart[key]

    def compile(self, state: int, char: str) -> tuple[int, int]:
        """Add the transition of ``state`` on ``char``."""
        if char not in self.scores:  # its bytes, which merge with nothing
            edge = (0, len(char.encode("utf-8", "replace")))
        else:
            live, grown, token = self.keys[state], None, ""
            for open_, last, ahead in live:
                piece = open_ + char
                if piece in self.scores and self.stays_apart(last, piece):
                    grown, token = 1 - ahead, piece
            after = [(open_ + char, last, ahead + grown) for open_, last, ahead in live if open_ + char in self.prefixes]
            key = (*after, ("", token, 0))
            if key not in self.ids:
                self.ids[key] = len(self.keys)
                self.keys.append(key)
                self.edges.append({})
            edge = (self.ids[key], grown)
        self.edges[state][char] = edge
        return edge

    def run(self, state: tuple, text: str) -> tuple[tuple, int]:
        """The state after reading ``text`` from ``state``, and the tokens it added."""
        edges, count, at = self.edges, 0, self.ids.get(state)
        if at is None:
            at = self.ids[state] = len(self.keys)
            self.keys.append(state)
            edges.append({})
        for char in text:
            edge = edges[at].get(char) or self.compile(at, char)
            at, more = edge
            count += more
        return self.keys[at], count

    def chunk_map(self, text: str) -> StateMap:
        first = _SYNC.search(text)
        if first is None:
            return StateMap(text, False, 0, START)
        head, body = text[: first.start() + 1], text[first.start() + 1 :]
        words = body.split(" ")[1:] if "  " not in body else [s[1:] for s in _SEGMENT.findall(body)]
        exit_, last = self.run(START, " " + words.pop())
        return StateMap(head, True, sum(map(self.words.__getitem__, words)) + last, exit_)

    def compose(self, left: StateMap, right: StateMap) -> StateMap:
        """First ``left``, then ``right``; associative."""
        if not left.sync:
            return right._replace(head=left.head + right.head)
        state, count = self.run(left.exit, right.head)
        if right.sync:
            return StateMap(left.head, True, left.count + count + right.count, right.exit)
        return StateMap(left.head, True, left.count + count, state)

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = " " + text.replace(_META, " ")
        maps = [self.chunk_map(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)]
        while len(maps) > 1:  # one level of the scan
            pairs = [self.compose(*maps[i : i + 2]) for i in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[2 * len(pairs) :]
        _, count = self.run(START, maps[0].head)
        return count + maps[0].count


class _Words(dict):
    """Tokens of a word with the space before it, which do not depend on what came before."""

    def __init__(self, transducer: Transducer):
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        count = self.transducer.run(START, " " + word)[1]
        if len(word) < 40 and "\n" not in word:
            self[word] = count
        return count


@lru_cache(maxsize=2)
def transducer_of(path: str) -> Transducer:
    """The transducer of a sentencepiece BPE model without normalisation."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    )
    return Transducer({model.id_to_piece(i).replace(_META, " "): model.get_score(i) for i in plain})


def tokens(text: Column, path: str) -> Column:
    """Number of tokens of a text column (null: 0)."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        transducer = transducer_of(path)
        for texts in batches:
            if len(transducer.keys) > MAX_STATES or len(transducer.words) > MAX_WORDS:
                transducer.reset()
            yield pd.Series([transducer.count(t) if t else 0 for t in texts], dtype="int64")

    return counted(text)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, ``n_bytes``, ``n_tokens``, ``over_limit`` for each row, in one pass without a shuffle.

    A null or empty text has 0 bytes and tokens; the length of a text is not bounded.
    Repeated rows are counted each; an empty table gives no rows; further columns are ignored.
    """
    whole = whole_text(text)
    counted = docs.select(F.col(key), F.octet_length(whole).cast("long").alias("n_bytes"), tokens(whole, path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
