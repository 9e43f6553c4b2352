"""Small tables with every odd case, and plain versions of what several operators compute."""

from __future__ import annotations

import random
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMPTY = "doc_id long, text string, lang string, source string, n_chars long"
SCHEMA = EMPTY + ", size long, keep_id string, _gone int, id string, bin int, _found string, host string"


def lower(text):
    return re.sub("[A-Z]+", lambda m: "".join(chr(ord(c) + 32) for c in m[0]), text or "")


def words(text):
    return WORD.findall(lower(text))


def runs(text, n=5):
    found = words(text)
    size = min(n, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if size else set()


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def near(text, rng, edits):
    found = text.split(" ")
    for _ in range(edits):
        found[rng.randrange(len(found))] = f"edit{rng.randrange(10**6)}"
    return " ".join(found)


def odd_texts(seed=1):
    """Texts with nulls, empty and very long ones, exact and near copies, shared passages."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = prose(150), prose(60)
    texts = [None, "", "   \n\t", "One", "one", "one two three", "ONE two three", "\x0b", "12 !? 34", "日本語 の 文"]
    texts += [prose(rng.randint(5, 120)) for _ in range(25)]
    texts += [base] * 4 + [near(base, rng, rng.randint(0, 12)) for _ in range(25)]
    texts += [prose(20) + " " + passage + "\n" + prose(20) for _ in range(10)]
    texts += [prose(6_000), "x" * 120_000, "ab " * 30_000]
    return texts


def documents(spark, texts, ids=None):
    """A table of texts with further columns whose names operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [
        (i, t, ["en", "de", None][k % 3], ["b", "a", None, "c"][k % 4], None, 7, "x", 1, "y", 2, "z", "h")
        for k, (i, t) in enumerate(zip(ids, texts))
    ]
    return spark.createDataFrame(rows, SCHEMA)


def components(nodes, linked):
    """Smallest node reachable from each node."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
