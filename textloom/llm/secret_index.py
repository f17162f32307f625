"""Operator 6: secret scans over a trigram index, in DataFrame functions only.

From each rule's pattern a Boolean query over trigrams is derived: alternatives,
each a set of trigrams that every match has.  The index holds the postings of
those trigrams, taken from texts in lower case; the postings of an alternative
are intersected, and only documents left over are searched with the pattern.  A
rule whose pattern has no mandatory trigram is searched for in every document.
"""

from __future__ import annotations

import re._constants as K
import re._parser as patterns
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import BROADCAST_ROWS, materialize

# Alternatives of a query beyond this many are given up for "every document".
MAX_ALTERNATIVES = 64
# Matches of a text that are folded together.
RUN = 256
SPAN = "array<struct<start:int,kind_no:int,stop:int,kind:string>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, from the left; ``group`` must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE


# --- trigram queries ------------------------------------------------------------------


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each the trigrams in lower case that its matches have; None: no constraint."""
    _, query = _needed(patterns.parse(pattern))
    # An alternative that asks for more than another one adds nothing.
    return query and [a for a in dict.fromkeys(query) if not any(b < a for b in query)]


def _lowered(strings: set[str]) -> set[str] | None:
    return {s.lower() for s in strings} if len(strings) <= MAX_ALTERNATIVES else None


def _of(strings: set[str] | None) -> list[frozenset[str]] | None:
    """What one of these strings being in the text means."""
    if not strings or min(map(len, strings)) < 3:
        return None
    return [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]


def _and(a: list | None, b: list | None) -> list | None:
    if a is None or b is None or len(a) * len(b) > MAX_ALTERNATIVES:
        return a if b is None else b if a is None else min(a, b, key=len)
    return [x | y for x, y in product(a, b)]


def _needed(items) -> tuple[set[str] | None, list[frozenset[str]] | None]:
    """All strings a sequence of pattern items can match, if few, and the query of the sequence."""
    run, whole, query = {""}, True, None
    for op, arg in items:
        exact, inner = _item(op, arg)
        longer = _lowered({a + b for a, b in product(run, exact)}) if exact is not None else None
        if longer is not None:
            run = longer
        else:
            query, run, whole = _and(_and(query, _of(run)), inner if exact is None else None), exact or {""}, False
    return (run if whole else None), _and(query, _of(run))


def _item(op, arg) -> tuple[set[str] | None, list[frozenset[str]] | None]:
    if op is K.LITERAL:
        return {chr(arg).lower()}, None
    if op is K.IN:
        chars = set()
        for kind, x in arg:
            if kind is K.LITERAL:
                chars.add(chr(x))
            elif kind is K.RANGE and x[1] - x[0] < MAX_ALTERNATIVES:
                chars |= {chr(c) for c in range(x[0], x[1] + 1)}
            else:
                return None, None
        return (_lowered(chars) if len(chars) <= 8 else None), None
    if op is K.SUBPATTERN:
        return _needed(arg[-1])
    if op is K.BRANCH:
        parts = [_needed(x) for x in arg[1]]
        if all(exact is not None for exact, _ in parts):
            return _lowered(set().union(*(exact for exact, _ in parts))), None
        queries = [_of(exact) if exact is not None else query for exact, query in parts]
        return None, None if None in queries else [x for q in queries for x in q]
    if op in (K.MAX_REPEAT, K.MIN_REPEAT):
        low, high, inner = arg
        exact, query = _needed(inner)
        if (low, high) == (0, 1) and exact is not None:
            return exact | {""}, None
        return None, (query if exact is None else _of(exact)) if low else None
    return None, None


# --- index and candidates -------------------------------------------------------------


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram, doc_id``: the documents whose text in lower case has each of the given trigrams."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("doc_id", F.explode(found).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, rules``: as bits, the rules with trigrams whose query a document meets."""
    terms = [(bit, alt, t, 1 << k, (1 << len(need)) - 1) for bit, rule in enumerate(rules)
             for alt, need in enumerate(trigram_query(rule.pattern) or []) for k, t in enumerate(sorted(need))]
    if not terms:
        return docs.select("doc_id", F.lit(0).cast("long").alias("rules")).limit(0)
    # As many rows as the rules have trigrams.
    table = docs.sparkSession.createDataFrame(terms, "bit int, alt int, trigram string, has long, need long")
    met = (
        postings(docs, sorted({x[2] for x in terms})).join(F.broadcast(table), "trigram")
        .groupBy("doc_id", "bit", "alt", "need").agg(F.bit_or("has").alias("has")).filter("has = need")
    )
    return met.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("rules"))


# --- verification ---------------------------------------------------------------------


def pattern_spans(text: Column, pattern: str, group: int = 0, least: int = 1) -> Column:
    """``array<struct<start int, stop int>>`` in code points of the matches of a pattern.

    The pieces between the matches and the matches themselves add up to the text,
    which gives the places.  Matches whose ``group`` is shorter than ``least`` are
    dropped after matching, so they still use up their characters.  Appending to an
    array copies it, so matches are folded in runs of ``RUN`` that start at sums of
    the runs before.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(whole, F.length).alias("size"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length).alias("part"))
    none = F.expr("CAST(array() AS array<struct<start:int,stop:int>>)")
    zero = F.lit(0)

    def runs(p: Column) -> Column:
        numbers = F.sequence(zero, F.ceil(F.size(p) / RUN).cast("int") - 1)
        return F.transform(numbers, lambda i: F.slice(p, i * RUN + 1, RUN))

    def length(run: Column) -> Column:
        return F.aggregate(run, zero, lambda acc, x: acc + x["gap"] + F.coalesce(x["size"], zero))

    def begins(lengths: Column) -> Column:
        return F.aggregate(
            lengths, F.struct(zero.alias("at"), F.expr("CAST(array() AS array<int>)").alias("all")),
            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.array_append(acc["all"], acc["at"]).alias("all")),
            lambda acc: acc["all"])

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        stop = start + F.coalesce(x["size"], zero)
        span = F.struct(start.alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(x["part"] >= least, F.array_append(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    def fold(run: Column, at: Column) -> Column:
        return F.aggregate(run, F.struct(at.alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])

    # One-element arrays bind values that are used twice.
    def spans(r: Column) -> Column:
        return F.flatten(F.zip_with(r, begins(F.transform(r, length)), fold))

    bound = F.transform(F.transform(F.array(parts), runs), spans)[0]
    enough = F.exists(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda m: F.length(m) >= least)
    return F.when(enough, bound).otherwise(none)


def _quick(rule: Rule) -> str:
    """A pattern that any match long enough contains, so that most texts need one plain search."""
    return f"[0-9a-f]{{{rule.least},}}" if rule.kind == "hex" else rule.pattern


def _named(rule: Rule, number: int) -> Column:
    spans = pattern_spans(F.col("text"), rule.pattern, rule.group, rule.least)
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("kind_no"), s["stop"].alias("stop"), F.lit(rule.kind).alias("kind")))


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans``: start, stop (exclusive, in code points) and kind of all secrets, by start and rule.

    A null text has no spans.  Repeated rows give repeated results, null ids are
    ids like others, an empty table stays empty.  A column named ``spans`` is replaced.
    """
    keyed = materialize(candidates(docs, rules), "secret-candidates").withColumnRenamed("doc_id", "__id")
    few = keyed.count() <= BROADCAST_ROWS
    joined = docs.join(F.broadcast(keyed) if few else keyed, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    full = sum(1 << bit for bit, rule in enumerate(rules) if trigram_query(rule.pattern) is None)
    bits = F.coalesce("rules", F.lit(0)).bitwiseOR(F.lit(full))
    kinds = []
    for bit, rule in enumerate(rules):
        asked = (bits.bitwiseAND(F.lit(1 << bit)) != 0) & F.col("text").rlike(_quick(rule))
        kinds.append(F.when(asked, _named(rule, bit)).otherwise(F.expr(f"CAST(array() AS {SPAN})")))
    return joined.withColumn("spans", F.array_sort(F.flatten(F.array(*kinds)))).drop("__id", "rules")


def listed(spans: Column) -> Column:
    """``kind:start:stop`` of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every run of overlapping spans in ``text`` replaced by ``mark``; null texts stay null."""
    found = find(docs, rules)
    none = F.expr("CAST(array() AS array<string>)")
    begin = F.struct(F.lit(0).alias("at"), none.alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        parts = F.when(s["start"] >= acc["at"], F.concat(acc["parts"], F.array(between, F.lit(mark)))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), parts.alias("parts"))

    def end(acc: Column) -> Column:
        return F.array_join(F.concat(acc["parts"], F.array(F.substring(F.col("text"), acc["at"] + 1, F.length("text")))), "")

    clean = F.when(F.size("spans") > 0, F.aggregate("spans", begin, step, end)).otherwise(F.col("text"))
    return found.withColumn("text", clean).drop("spans")
