"""Cheapest repairs of role sequences: min-plus transfer matrices over a Re-Pair grammar.

A conversation is a string of symbols, one a row: ``s u a`` for a sound row of that role, ``o``
for any other role, capitals for truncated ones, ``x`` for a row that has to go. Four states say
what stands so far: nothing, a system message, a user's, an assistant's. Each symbol is a matrix
whose entry (i, j) is the cheapest way over it from state i to state j, with the edits made.
Matrices multiply in min-plus, so a rule of the grammar has the product of its two sides, and
whatever holds the rule shares it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
DOOMED = "x"

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTED = (EMPTY, ASSISTANT)
#: States from which a user's message may follow; an assistant's follows a user's only.
BEFORE_USER = (EMPTY, SYSTEM, ASSISTANT)

#: Rules of the grammar get characters from here on.
FIRST_RULE = 0x100
#: So many factors are multiplied with a vector one by one; more are paired first, to keep ropes shallow.
SHALLOW = 32

_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)


class Rope:
    """A string made of shared parts, with a fingerprint by which equal parts are recognised."""

    __slots__ = ("left", "right", "text", "size", "mark", "power")

    def __init__(self, left: Rope | None, right: Rope | None, text: str, size: int, mark: int, power: int):
        self.left, self.right, self.text, self.size, self.mark, self.power = left, right, text, size, mark, power

    def __str__(self) -> str:
        parts, open_ = [], [self]
        while open_:
            rope = open_.pop()
            if rope.left is None:
                parts.append(rope.text)
            else:
                open_ += (rope.right, rope.left)
        return "".join(parts)


def leaf(letter: str) -> Rope:
    return Rope(None, None, letter, len(letter), ord(letter) if letter else 0, _BASE if letter else 1)


def join(a: Rope, b: Rope) -> Rope:
    if not a.size:
        return b
    if not b.size:
        return a
    return Rope(a, b, "", a.size + b.size, (a.mark * b.power + b.mark) % _PRIME, a.power * b.power % _PRIME)


def precedes(a: Rope, b: Rope) -> bool:
    """True if ``a`` is less by code point. Goes down to the first difference, past equal parts."""
    if a.mark == b.mark and a.size == b.size:
        return False
    x, y = [a], [b]
    while x and y:
        p, q = x.pop(), y.pop()
        if p.size == q.size and p.mark == q.mark:
            continue
        if p.size >= q.size and p.left is not None:
            x += (p.right, p.left)
            y.append(q)
        elif q.left is not None:
            y += (q.right, q.left)
            x.append(p)
        else:
            return p.text < q.text
    return not x and bool(y)


Entry = tuple[int, Rope]
Matrix = list[list[Entry | None]]


def _least(a: Entry | None, b: Entry | None) -> Entry | None:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if precedes(b[1], a[1]) else a


def _row_times(row: list[Entry | None], matrix: Matrix) -> list[Entry | None]:
    out: list[Entry | None] = [None] * len(STATES)
    for entry, steps in zip(row, matrix):
        if entry is not None:
            for j, step in enumerate(steps):
                # Dearer ways are left before their edits are joined.
                if step is not None and (out[j] is None or entry[0] + step[0] <= out[j][0]):
                    out[j] = _least(out[j], (entry[0] + step[0], join(entry[1], step[1])))
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product; of equally cheap ways the one whose edits are least by code point.

    The least edits of a whole are made of the least edits of its parts: of two ways over one part
    between the same states at one cost, neither's edits begin with the other's, as what is left
    would be insertions that cost something.
    """
    return [_row_times(row, b) for row in a]


def _none() -> Matrix:
    return [[None] * len(STATES) for _ in STATES]


def insertions() -> Matrix:
    """Nothing, or what can be inserted in front of a row or at the end."""
    out, letter = _none(), leaf(INSERT)
    for i in STATES:
        out[i][i] = (0, leaf(""))
    for i in BEFORE_USER:
        out[i][USER] = (COSTS[INSERT], letter)
    out[USER][ASSISTANT] = (COSTS[INSERT], letter)
    for i in (EMPTY, SYSTEM):
        out[i][ASSISTANT] = (2 * COSTS[INSERT], join(letter, letter))
    return out


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions in front of the row, then what becomes of it."""
    row, ops = _none(), {x: leaf(x) for x in (KEEP, REROLE, DELETE)}
    for i in STATES:
        row[i][i] = (COSTS[DELETE], ops[DELETE])
    if symbol != DOOMED:
        more = TRUNCATED_COST if symbol.isupper() else 0
        role = symbol.lower()
        for to, sources in ((SYSTEM, (EMPTY,)), (USER, BEFORE_USER), (ASSISTANT, (USER,))):
            kept = role == " sua"[to]
            if kept or to != SYSTEM:
                op = KEEP if kept else REROLE
                for i in sources:
                    row[i][to] = (COSTS[op] + more, ops[op])
    return times(insertions(), row)


def pair_counts(texts: Iterable[str]) -> Counter:
    """Neighbouring symbols; in a run of one symbol every second pair counts, as pairs must not overlap."""
    counts: Counter = Counter()
    for text in texts:
        at, last = 0, len(text) - 1
        while at < last:
            pair = text[at : at + 2]
            counts[pair] += 1
            at += 2 if pair[0] == pair[1] and at + 2 <= last and text[at + 2] == pair[0] else 1
    return counts


def encode(text: str, rules: list[str]) -> str:
    """The text with each rule's pair replaced, in the order of the rules."""
    for number, pair in enumerate(rules):
        text = text.replace(pair, chr(FIRST_RULE + number))
    return text


class Solver:
    """The matrices of all symbols and rules, made bottom-up once."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.matrices = {x: symbol_matrix(x) for x in "suaoSUAO" + DOOMED}
        for number, pair in enumerate(rules):
            self.matrices[chr(FIRST_RULE + number)] = times(self.matrices[pair[0]], self.matrices[pair[1]])
        self.end = insertions()

    def solve(self, symbols: str) -> tuple[int, str]:
        """Cost and edits of the cheapest repair."""
        factors = [self.matrices[x] for x in encode(symbols, self.rules)]
        while len(factors) > SHALLOW:
            factors = [times(*factors[i : i + 2]) if i + 1 < len(factors) else factors[i] for i in range(0, len(factors), 2)]
        row: list[Entry | None] = [(0, leaf("")), None, None, None]
        for factor in [*factors, self.end]:
            row = _row_times(row, factor)
        best = None
        for state in ACCEPTED:
            best = _least(best, row[state])
        return best[0], str(best[1])


def roles_of(edits: str) -> list[str | None]:
    """Per edit the role it gives a message, ``system`` for one that is kept in front, None where a row goes.

    A sequence that ends well has an even number of user's and assistant's messages, so the number
    of messages tells whether a system message stands in front.
    """
    kept = sum(e != DELETE for e in edits)
    out, place = [], 0
    for edit in edits:
        if edit == DELETE:
            out.append(None)
            continue
        out.append("system" if kept % 2 and place == 0 else ("user", "assistant")[(place - kept % 2) % 2])
        place += 1
    return out
