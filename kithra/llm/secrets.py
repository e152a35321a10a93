"""Secret scans: a trigram index proposes texts for each rule, its regex decides.

Everything that touches rows is a DataFrame expression.  The driver only turns
each rule's regex into a Boolean query over trigrams that every match must hold.
"""

from __future__ import annotations

import re._constants as constants
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT_LIMIT = 64  # strings a part of a regex may stand for, and clauses of a query


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; those whose ``group`` has under ``min_length`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 0


# The base rules, in the order that ties follow.  A run below the length of `access` or `hex` holds no
# longer run inside, so there the length stands in the pattern; `assign` must match first and drop later.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("prefixed_token", r"(?:ghp|gho|ghu|ghs|ghr|glpat|xoxb|xoxp|sk_live|rk_live)[_-][A-Za-z0-9_-]{16,}"),
)

ANY = [frozenset()]


# ------------------------------------------------------------------ regex to trigram query

def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of lower-case trigrams; a text with a match holds all of some clause.

    ``[frozenset()]`` (one empty clause) means that nothing is mandatory and
    every text must be scanned.  Each step keeps a superset of the matches.
    """
    exact, query = _analyse(parser.parse(pattern))
    return _both(query, _needs(exact)) if exact is not None else query


def _needs(strings: set[str]) -> list[frozenset[str]]:
    return _fewest([frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings])


def _fewest(clauses) -> list[frozenset[str]]:
    """Drop clauses that another one already covers."""
    clauses = sorted(set(clauses), key=lambda c: (len(c), sorted(c)))
    out: list[frozenset[str]] = []
    for clause in clauses:
        if not any(kept <= clause for kept in out):
            out.append(clause)
    return out


def _both(a, b):
    if len(a) * len(b) > EXACT_LIMIT:
        return a if len(a) <= len(b) else b
    return _fewest([x | y for x, y in product(a, b)])


def _analyse(tree) -> tuple[set[str] | None, list[frozenset[str]]]:
    """(the strings a part stands for, if few; the query of its other parts)."""
    run, query, whole = {""}, ANY, True
    for op, arg in tree:
        exact, need = _item(op, arg)
        query = _both(query, need)
        if exact is not None and len(run) * len(exact) <= EXACT_LIMIT:
            run = {a + b for a in run for b in exact}
            continue
        query, whole = _both(query, _needs(run)), False
        run = exact if exact is not None else {""}
    return (run, query) if whole else (None, _both(query, _needs(run)))


def _item(op, arg):
    if op is constants.LITERAL:
        return {chr(arg).lower()}, ANY
    if op is constants.IN:
        literal = [chr(x).lower() for kind, x in arg if kind is constants.LITERAL]
        return (set(literal), ANY) if len(literal) == len(arg) <= 4 else (None, ANY)
    if op is constants.SUBPATTERN:
        return _analyse(arg[-1])
    if op is constants.BRANCH:
        found = [_analyse(branch) for branch in arg[1]]
        if all(e is not None for e, _ in found) and sum(len(e) for e, _ in found) <= EXACT_LIMIT and all(q == ANY for _, q in found):
            return set().union(*[e for e, _ in found]), ANY
        clauses = [c for e, q in found for c in (_both(q, _needs(e)) if e is not None else q)]
        return None, _fewest(clauses) if len(clauses) <= EXACT_LIMIT else ANY
    if op in (constants.MAX_REPEAT, constants.MIN_REPEAT):
        least, most, inner = arg
        exact, query = _analyse(inner)
        if exact is not None and query == ANY and (least, most) == (0, 1):
            return exact | {""}, ANY
        if least == 0:
            return None, ANY
        return None, _both(query, _needs(exact)) if exact is not None else query
    return None, ANY


# ------------------------------------------------------------------ index

def trigram_postings(docs: DataFrame, key: str, text: str, trigrams: list[str] | None = None) -> DataFrame:
    """(trigram, _key, _told): the distinct lower-case trigrams of each text, all or those asked for.

    ``_told`` tells rows of one key apart; an index kept for other rules takes all.
    """
    low = F.lower(F.col(text))
    if trigrams is None:
        held = F.transform(F.array(low), lambda t: F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(t) - 2, F.lit(1))), lambda i: t.substr(i, F.lit(3)))))
    else:
        asked = F.array(*[F.lit(t) for t in trigrams]) if trigrams else F.array().cast("array<string>")
        # a one-element array, so that the text is folded once and not once per trigram
        held = F.transform(F.array(low), lambda t: F.filter(asked, lambda g: F.contains(t, g)))
    rows = docs.filter(F.col(text).isNotNull())
    return rows.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_told"), F.explode(F.element_at(held, 1)).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(_key, _told, kinds): rows that hold all trigrams of some clause of each named query.

    Queries with an empty clause propose nothing here: their rules scan everything.
    """
    spark = postings.sparkSession
    wanted = [(kind, n, t, len(clause)) for kind, clauses in queries.items() if frozenset() not in clauses
              for n, clause in enumerate(clauses) for t in sorted(clause)]
    # one row per trigram of the rules, which the caller wrote by hand
    table = F.broadcast(spark.createDataFrame(wanted, "kind string, clause int, trigram string, needed int"))
    held = postings.join(table, "trigram").groupBy("_key", "_told", "kind", "clause").agg(
        F.count_distinct("trigram").alias("held"), F.first("needed").alias("needed"))
    return held.filter("held = needed").groupBy("_key", "_told").agg(F.collect_set("kind").alias("kinds"))


# ------------------------------------------------------------------ verification

SPANS = "array<struct<start:int,place:int,kind:string,end:int>>"


def rule_spans(text: Column, rule: Rule, place: int) -> Column:
    """Spans of a rule's matches, leftmost first, from the pieces between them."""
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1)).alias("found"),
        (F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.min_length else F.array().cast("array<string>")).alias("told"),
        F.split(text, rule.pattern, -1).alias("between"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

    def step(state, i, x):
        begin = state["at"] + F.length(F.get(x["between"], i))
        end = begin + F.length(F.get(x["found"], i))
        span = F.array(F.struct(begin.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), end.alias("end")))
        keep = F.length(F.get(x["told"], i)) >= rule.min_length if rule.min_length else F.lit(True)
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["out"], span)).otherwise(state["out"]).alias("out"))

    def walk(x):
        n = F.size(x["found"])
        steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, start, lambda state, i: step(state, i, x), lambda state: state["out"])

    return F.element_at(F.transform(F.array(parts), walk), 1)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", base=BASE, more=MORE) -> DataFrame:
    """Per row of ``docs``: key, spans (start, place, kind, end) of all rules, in order.

    Offsets are code points, ends exclusive.  A null or empty text has no
    spans; equal rows give equal results; very long texts are scanned whole.
    """
    rules = [*base, *more]
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    full = {kind for kind, clauses in queries.items() if frozenset() in clauses}
    asked = sorted({t for kind, clauses in queries.items() if kind not in full for c in clauses for t in c})
    proposed = candidates(trigram_postings(docs, key, text, asked), queries)
    proposed = proposed.select(F.col("_key").alias("_pkey"), F.col("_told").alias("_ptold"), F.col("kinds").alias("_kinds"))
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_told"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.join(proposed, F.col("_key").eqNullSafe(F.col("_pkey")) & (F.col("_told") == F.col("_ptold")), "left")
    found = []
    for place, rule in enumerate(rules):
        spans = rule_spans(F.col("_text"), rule, place)
        if rule.kind not in full:
            spans = F.when(F.array_contains("_kinds", rule.kind), spans)
        found.append(F.coalesce(spans, F.array().cast(SPANS)))
    return rows.select(F.col("_key").alias(key), F.array_sort(F.concat(*found)).alias("spans"))


def digest(found: DataFrame, key: str = "doc_id", base=BASE) -> DataFrame:
    """Counts per base kind and the spans as text."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    own = F.filter("spans", lambda s: s["place"] < len(base))
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in base]
    return found.select(key, *counts, F.sha2(text(own).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
