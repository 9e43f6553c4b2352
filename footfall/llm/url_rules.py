"""URL filters: rules are indexed by their rarest literal token, and a URL runs only the rules its tokens fetch.

The index is an array of cells addressed by the token's crc32, folded into the plan as a
literal: fetching is one array access per token, so pages are judged in one pass over the
URLs, without a join or shuffle, however common a host is. Its size is that of the rule
list, which is checked.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import ascii_lower, unused

MAX_RULES = 100_000
_NO_TOKEN = ""
_SPLIT = "[^A-Za-z0-9]+"
_CELL = "array<array<struct<token:string,regex:string,name:string,action:string,size:int>>>"


@dataclass(frozen=True)
class Rule:
    """A regular expression over host and path; ``literals`` are tokens that every match contains whole.

    ``name`` is set for host and path rules, which win over patterns, the longest first.
    """

    action: str
    regex: str
    literals: tuple[str, ...] = ()
    name: str | None = None


def host_rule(action: str, text: str) -> Rule:
    """``host/path``: the host and its subdomains, where the path starts with the rule's.

    The path's last token is left out unless the rule closes it, as a URL's may go on.
    """
    host, slash, path = text.partition("/")
    closed = re.split(_SPLIT, host + slash + path + "\n") if re.search(r"[^A-Za-z0-9]$", text) else re.split(_SPLIT, text)[:-1]
    if not slash:  # a bare host: closed by the end or by a path
        return Rule(action, rf"^(?:[^/]*\.)?{_quoted(host)}(?:/|\z)", tuple(filter(None, re.split(_SPLIT, host))), text)
    return Rule(action, rf"^(?:[^/]*\.)?{_quoted(host + slash + path)}", tuple(dict.fromkeys(filter(None, closed))), text)


def host_word(action: str, word: str) -> Rule:
    """A word that stands alone between dots or hyphens of the host."""
    return Rule(action, rf"^(?:[^/]*[.-])?{_quoted(word)}(?:[.-][^/]*)?(?:/|\z)", (word,))


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/\-])", r"\\\1", text)


RULES = (
    host_rule("block", "net/"),
    host_rule("allow", "example.net/en/"),
    host_rule("block", "example.com/de/"),
    host_rule("allow", "org/fr/"),
    *(host_word("block", w) for w in "ads adult bets casino pills poker porn spam xxx".split()),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    before = F.regexp_extract(rest, r"^([^?#]*)", 1)
    host = F.regexp_extract(before, r"^([^/]*)", 1)
    path = F.substring(before, F.length(host) + 1, F.length(before))
    return ascii_lower(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def _tokens(place: Column) -> Column:
    return F.array_distinct(F.concat(F.array(F.lit(_NO_TOKEN)), F.split(place, _SPLIT)))


def _rarest(pages: DataFrame, rules: Iterable[Rule], place: Column) -> dict[str, int]:
    """How many URLs have each literal token: at most one row per token of the rule list comes back."""
    wanted = sorted({t for r in rules for t in r.literals})
    if not wanted:
        return {}
    seen = pages.select(F.explode(_tokens(place)).alias("token")).where(F.col("token").isin(wanted))
    return {r["token"]: r["n"] for r in seen.groupBy("token").agg(F.count("*").alias("n")).collect()}


def build_index(rules: Iterable[Rule], counts: dict[str, int]) -> list[list[dict]]:
    """Cells of rules; each rule stands once, at its rarest token (ties: the first by code point)."""
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the index is made for {MAX_RULES} at most")
    cells: list[list[dict]] = [[] for _ in range(max(1, 2 * len(rules)))]
    for rule in rules:
        token = min(rule.literals, key=lambda t: (counts.get(t, 0), t), default=_NO_TOKEN)
        cells[zlib.crc32(token.encode()) % len(cells)].append(
            {"token": token, "regex": rule.regex, "name": rule.name, "action": rule.action, "size": len(rule.name or "")}
        )
    return cells


def judge_urls(pages: DataFrame, rules: Iterable[Rule] = RULES, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names are replaced).

    The longest host and path rule that fits decides; without one, a page is blocked if a
    pattern that blocks fits and none that allows, else allowed. A null or empty url has
    empty parts and is allowed. Repeated rows are judged alike; an empty table stays empty.
    """
    rules = list(rules)
    host, path = url_parts(F.col(url))
    place = F.concat(host, path)
    cells = build_index(rules, _rarest(pages, rules, place))
    index = F.from_json(F.lit(json.dumps(cells)), _CELL)
    at = lambda token: (F.crc32(token.cast("binary")) % len(cells)).cast("int")
    place_, fetched_, fits_, named_ = (unused(pages, n) for n in ("_place", "_fetched", "_fits", "_named"))
    fetched = F.flatten(
        F.transform(_tokens(F.col(place_)), lambda t: F.filter(F.get(index, at(t)), lambda r: r["token"] == t))
    )
    fits = F.filter(F.col(fetched_), lambda r: F.rlike(place_, r["regex"]))
    named = F.array_max(
        F.transform(
            F.filter(F.col(fits_), lambda r: r["name"].isNotNull()),
            lambda r: F.struct(r["size"].alias("size"), r["name"].alias("name"), r["action"].alias("action")),
        )
    )
    patterns = lambda action: F.exists(fits_, lambda r: r["name"].isNull() & (r["action"] == action))
    return (
        pages.withColumns({"host": host, "path": path})
        .withColumn(place_, F.concat("host", "path"))
        .withColumn(fetched_, fetched)
        .withColumn(fits_, fits)
        .withColumn(named_, named)
        .withColumn("rule", F.col(f"{named_}.name"))
        .withColumn(
            "verdict",
            F.coalesce(
                F.col(f"{named_}.action"),
                F.when(patterns("block") & ~patterns("allow"), F.lit("block")).otherwise(F.lit("allow")),
            ),
        )
        .drop(place_, fetched_, fits_, named_)
    )
