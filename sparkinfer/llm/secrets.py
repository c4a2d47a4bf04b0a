"""Secret scan by a trigram inverted index and regular expressions, in DataFrame expressions only.

Boolean trigram queries come from the rules' own patterns. Postings say which texts hold
which trigrams; a rule reads the texts in the combination of postings that its query asks
for, and a rule without mandatory trigrams reads all of them.
"""

from __future__ import annotations

import re._parser as pattern_tree
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkinfer.llm.common import fresh, text_of

#: A part of a pattern with more alternatives than this is taken as "any string".
MAX_ALTERNATIVES = 64
#: Bits of a set of trigrams that one number holds.
WORD = 62


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what a match looks like, and which matches count."""

    kind: str
    pattern: str
    #: Condition on the matched string; None keeps every match.
    holds: str | None = None


# The scan's base rules, in the order in which equal starts are listed.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         r"""(?i)^(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{8,})$"""),
    Rule("access", r"AKIA[A-Z0-9]+", r"^.{16,}$"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", None),
)
# Public token formats that the base rules do not name.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}", None),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", None),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", None),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", None),
)


def _strings(node) -> list[set[str] | None]:
    """A parsed pattern as a run of parts: a set of possible strings, or None for anything."""
    parts: list[set[str] | None] = []
    for op, arg in node:
        name = str(op)
        if name == "LITERAL":
            parts.append({chr(arg).lower()})
        elif name == "SUBPATTERN":
            parts.extend(_strings(arg[-1]))
        elif name == "BRANCH":
            options: set[str] | None = set()
            for branch in arg[1]:
                whole = _joined(_strings(branch))
                options = None if options is None or len(whole) != 1 or whole[0] is None else options | whole[0]
            parts.append(options)
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] == 1:
            whole = _joined(_strings(arg[2]))
            parts.append(whole[0] | {""} if arg[0] == 0 and len(whole) == 1 and whole[0] else
                         whole[0] if len(whole) == 1 else None)
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] == arg[1] and isinstance(arg[0], int) and arg[0] <= 8:
            parts.extend(_strings(arg[2]) * arg[0])
        elif name == "IN" and len(arg) <= 8 and all(str(k) == "LITERAL" for k, _ in arg):
            parts.append({chr(v).lower() for _, v in arg})
        elif name not in ("AT", "ASSERT", "ASSERT_NOT"):
            parts.append(None)
    return parts


def _joined(parts: list[set[str] | None]) -> list[set[str] | None]:
    """Neighbouring finite parts multiplied out while they stay few."""
    out: list[set[str] | None] = []
    for part in parts:
        if out and part is not None and out[-1] is not None and len(out[-1]) * len(part) <= MAX_ALTERNATIVES:
            out[-1] = {a + b for a in out[-1] for b in part}
        else:
            out.append(part)
    return out


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """A conjunction of disjunctions of conjunctions of lower-case trigrams that every match holds.

    Empty where the pattern has no mandatory trigram.
    """
    query = []
    for part in _joined(_strings(pattern_tree.parse(pattern))):
        if part and all(len(s) >= 3 and s.isascii() for s in part):
            options = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in part}
            # what asks for more than another option adds nothing
            query.append(sorted(sorted(o) for o in options if not any(other < o for other in options)))
    return query


def postings(df: DataFrame, key: list[str], text: str, trigrams: list[str]) -> DataFrame:
    """Inverted index for a vocabulary of trigrams: one row (trigram, key) for each that a text holds."""
    lowered = fresh(df.columns, "lowered")
    # only ASCII capitals fold, as in the rules
    low = F.translate(F.col(f"`{text}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = F.filter(F.array(*[F.lit(t) for t in trigrams]), lambda t: F.contains(F.col(lowered), t))
    return df.withColumn(lowered, low).select(*key, F.explode(held).alias("trigram"))


def _holds(query: list[list[list[str]]], bits: dict[str, int], masks: list[Column]) -> Column:
    """Whether a bit set of held trigrams, WORD bits a number, answers a query."""
    def all_of(trigrams: list[str]) -> Column:
        wanted = [sum(1 << bits[t] % WORD for t in trigrams if bits[t] // WORD == w) for w in range(len(masks))]
        return reduce(Column.__and__, [m.bitwiseAND(F.lit(w)) == F.lit(w)
                                       for m, w in zip(masks, wanted, strict=True) if w])

    clauses = [reduce(Column.__or__, [all_of(t) for t in options]) for options in query]
    return reduce(Column.__and__, clauses)


def _spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of a rule's matches, in code points.

    Matches and the gaps between them come from the same leftmost search, so adding their
    lengths gives the places.
    """
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    start = F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<start:int,end:int,hit:string>>").alias("found"))

    def step(s: Column, pair: Column) -> Column:
        begin = s["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        return F.struct(end.alias("at"), F.concat(s["found"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), pair["hit"].alias("hit")))).alias("found"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches,
                       lambda g, m: F.struct(g.alias("gap"), m.alias("hit")))
    found = F.aggregate(pairs, start, step, lambda s: s["found"])
    if rule.holds:
        found = F.filter(found, lambda m: m["hit"].rlike(rule.holds))
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))


def _labelled(order: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"),
                              F.lit(kind).alias("kind"))


def scan_secrets(df: DataFrame, id_col: str, text_col: str,
                 rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """Spans of all rules in every text.

    Returns ``id_col`` and ``found``, an array of (start, order, end, kind) sorted by start and
    then by the rule's place in the list; places are code points, the end exclusive. Matches of
    one rule are leftmost and do not overlap; those that fail the rule's condition are dropped
    after matching, as they have used up their text. A null or empty text has no spans. One row
    comes out for every row that goes in, repeated rows and null ids included; other columns
    are not read, so their names cannot clash.

    The index is keyed by a hash of id and text. Its postings hold only the trigrams that the
    rules ask for, are reduced to one bit set per key before they meet, and are joined to the
    texts by adaptive sort-merge join, which splits keys held by many rows. A hash that two
    texts share can only add candidates. Texts in no rule's postings still meet the rules
    without mandatory trigrams.
    """
    id_name = "id"
    rows = df.select(F.col(f"`{id_col}`").alias(id_name), text_of(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64(id_name, "text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    vocabulary = sorted({t for q in queries.values() for options in q for ts in options for t in ts})
    bits = {t: i for i, t in enumerate(vocabulary)}
    names = [f"mask{w}" for w in range(-(-len(bits) // WORD))]
    masks = [F.col(n) for n in names]
    none = F.lit(0).cast("long")
    if vocabulary:
        index = postings(rows, ["key"], "text", vocabulary)
        bit = F.map_from_arrays(F.array(*[F.lit(t) for t in vocabulary]), F.array(*[F.lit(bits[t]) for t in vocabulary]))
        index = index.withColumn("bit", bit[F.col("trigram")])
        one = F.lit(1).cast("long")
        met = index.groupBy("key").agg(*[
            F.bit_or(F.when(F.floor(F.col("bit") / WORD) == w, F.call_function(
                "shiftleft", one, F.pmod("bit", F.lit(WORD)).cast("int"))).otherwise(none)).alias(n)
            for w, n in enumerate(names)])
        # a key that no rule's query accepts needs no row in the join
        asked = reduce(Column.__or__, [_holds(q, bits, masks) for q in queries.values() if q])
        rows = rows.join(met.where(asked), "key", "left").withColumns({n: F.coalesce(F.col(n), none) for n in names})
    empty = F.array().cast("array<struct<start:int,end:int>>")
    found = []
    for order, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule)
        if queries[rule.kind]:
            spans = F.when(_holds(queries[rule.kind], bits, masks), spans).otherwise(empty)
        found.append(F.transform(spans, _labelled(order, rule.kind)))
    return rows.select(F.col(id_name).alias(id_col), F.array_sort(F.concat(*found)).alias("found"))
