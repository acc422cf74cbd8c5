"""Secrets by a trigram inverted index, in DataFrame functions only.

1. Every rule's pattern is turned into a Boolean trigram query: the literal strings that a match
   must contain, as an OR of ANDs of trigrams. Case is folded, so one index serves all rules.
2. The index holds a posting (trigram, document) for every trigram that some query mentions; other
   trigrams can't change an answer. Postings leave their scan already reduced to one row per
   document and trigram.
3. Postings meet the clauses of the queries; a document that has all trigrams of a clause is a
   candidate of its rule. The intersection is one aggregation by document and clause, so a
   trigram that occurs everywhere doesn't gather in one task.
4. Candidates are verified by the pattern itself. Rules without mandatory trigrams scan every
   text.

A text is verified in the task that reads it after one join by id, in which only candidates carry
a rule mask; no list of documents reaches the driver or a broadcast whose size isn't checked.

Null and empty texts have no spans. Null ids are matched as equal to each other, and repeated ids
are verified for the union of their candidates, which changes nothing, as verification is exact.
Repeated rows each give a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re._constants as ops
import re._parser as patterns
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import free_name, let

#: Alternatives that a literal may have before it is taken as unknown.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of pattern whose group has at_least characters or more."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1


#: Fixed patterns of the base kinds. `hex` names its least length in the pattern: runs of its
#: characters are maximal either way, and shorter ones needn't be listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        at_least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", at_least=18),
    Rule("hex", r"[0-9a-f]{16,}", at_least=16),
)
BASE_KINDS = tuple(rule.kind for rule in BASE_RULES)
RULES = (
    *BASE_RULES,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----"),
)


def trigram_query(pattern: str) -> frozenset[frozenset[str]] | None:
    """OR of ANDs of folded trigrams that every match contains; None if none are mandatory."""
    clauses = [frozenset()]
    for literals in literal_runs(patterns.parse(pattern)):
        options = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in literals}
        if frozenset() not in options and len(clauses) * len(options) <= MOST_STRINGS:
            clauses = [have | more for have in clauses for more in options]
    if frozenset() in clauses:
        return None
    return frozenset(c for c in clauses if not any(other < c for other in clauses))


def literal_runs(parsed) -> list[set[str]]:
    """For each run of known characters of a parsed pattern, the folded strings it may be."""
    done: list[set[str]] = []
    run = {""}

    def extend(options: set[str] | None) -> None:
        nonlocal run
        if options is None or len(run) * len(options) > MOST_STRINGS:
            done.append(run)
            run = {""}
        else:
            run = {a + b for a in run for b in options}

    def strings(parsed) -> set[str] | None:
        """All strings of a sub-pattern, or None if they aren't few."""
        out = {""}
        for op, arg in parsed:
            part = one(op, arg)
            if part is None or len(out) * len(part) > MOST_STRINGS:
                return None
            out = {a + b for a in out for b in part}
        return out

    def one(op, arg) -> set[str] | None:
        if op is ops.LITERAL:
            return {chr(arg).lower()}
        if op is ops.SUBPATTERN:
            return strings(arg[3])
        if op is ops.BRANCH:
            parts = [strings(p) for p in arg[1]]
            return None if None in parts else set().union(*parts)
        if op is ops.MAX_REPEAT and arg[1] != ops.MAXREPEAT and arg[1] <= 3:
            inner = strings(arg[2])
            return None if inner is None else {c * n for c in inner for n in range(arg[0], arg[1] + 1)}
        if op is ops.IN and all(kind is ops.LITERAL for kind, _ in arg):
            return {chr(c).lower() for _, c in arg}
        return None

    for op, arg in parsed:
        extend(one(op, arg))
    return [*done, run]


def postings(docs: DataFrame, id_col: str, text_col: str, trigrams: list[str]) -> DataFrame:
    """(trigram, doc) for the given folded trigrams."""
    folded = F.lower(F.col(text_col))
    found = docs.select(F.col(id_col).alias("doc"), folded.alias("folded")).select(
        "doc",
        F.array_compact(F.array(*(F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in trigrams))).alias("found"),
    )
    return found.select("doc", F.explode("found").alias("trigram"))


def candidates(index: DataFrame, queries: dict[int, frozenset[frozenset[str]]]) -> DataFrame:
    """doc and rules, the mask of the rules whose query the document's postings satisfy."""
    clauses = sorted((rule, tuple(sorted(clause))) for rule, options in queries.items() for clause in options)
    by_trigram: dict[str, list[int]] = {}
    for at, (_, clause) in enumerate(clauses):
        for trigram in clause:
            by_trigram.setdefault(trigram, []).append(at)
    # The clause table is a constant of the rule set, so it goes into the plan as a literal map.
    members = F.create_map(
        *(x for t, at in by_trigram.items() for x in (F.lit(t), F.array(*(F.lit(a) for a in at))))
    )
    table = F.array(*(F.struct(F.lit(len(clause)).alias("size"), F.lit(1 << rule).alias("bit")) for rule, clause in clauses))
    hits = index.select("doc", "trigram", F.explode(members[F.col("trigram")]).alias("clause"))
    whole = hits.groupBy("doc", "clause").agg(F.count_distinct("trigram").alias("n"))
    met = whole.select("doc", "n", table[F.col("clause")].alias("c")).filter("n = c.size")
    return met.groupBy("doc").agg(F.bit_or("c.bit").alias("rules"))


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule: gaps between its matches and the matches, summed up in order."""

    def spans(gaps: Column, found: Column, measured: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.struct(F.length(gaps[i]).alias("gap"), F.length(m).alias("size")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("out"))
        placed = F.aggregate(
            steps,
            start,
            lambda state, s: F.struct(
                (state["at"] + s["gap"] + s["size"]).alias("at"),
                F.array_append(
                    state["out"],
                    F.struct(
                        (state["at"] + s["gap"]).alias("start"), (state["at"] + s["gap"] + s["size"]).alias("stop")
                    ),
                ).alias("out"),
            ),
            lambda state: state["out"],
        )
        long_enough = F.filter(
            F.transform(
                placed,
                lambda s, i: F.when(
                    F.length(measured[i]) >= rule.at_least,
                    F.struct(
                        s["start"].alias("start"), F.lit(rank).alias("rank"), s["stop"].alias("stop"),
                        F.lit(rule.kind).alias("kind"),
                    ),
                ),
            ),
            lambda s: s.isNotNull(),
        )
        return long_enough

    pattern = F.lit(rule.pattern)
    parts = F.struct(
        F.split(text, rule.pattern).alias("gaps"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("measured"),
    )
    return let(parts, lambda p: spans(p["gaps"], p["found"], p["measured"]))


def verified(text: Column, rules: Column, tuple_of_rules: tuple[Rule, ...], scan: set[int]) -> Column:
    """All spans, by start, then by rule; a rule runs on its candidates or, in scan, on all texts."""
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")
    found = []
    for i, rule in enumerate(tuple_of_rules):
        wanted = text.rlike(rule.pattern)
        if i not in scan:
            wanted = (rules.bitwiseAND(F.lit(1 << i)) != 0) & wanted
        found.append(F.when(wanted, rule_spans(text, rule, i)).otherwise(none))
    return F.sort_array(F.concat(*found))


def with_spans(
    docs: DataFrame,
    spans_col: str = "found",
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """docs with an array of spans (start, rank, stop, kind) in code points.

    spans_col must be free in docs; `frames.free_name` gives such a name.
    """
    if free_name(docs, spans_col) != spans_col:
        raise ValueError(f"docs has a column {spans_col} already")
    queries = {i: trigram_query(rule.pattern) for i, rule in enumerate(rules)}
    scan = {i for i, query in queries.items() if query is None}
    queries = {i: query for i, query in queries.items() if query is not None}
    trigrams = sorted(reduce(set.union, (clause for query in queries.values() for clause in query), set()))
    mask, doc = free_name(docs, "rule_mask"), free_name(docs, "candidate")
    hits = candidates(postings(docs, id_col, text_col, trigrams), queries).select(
        F.col("doc").alias(doc), F.col("rules").alias(mask)
    )
    joined = docs.join(hits, F.col(id_col).eqNullSafe(F.col(doc)), "left")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    asked = F.coalesce(F.col(mask), F.lit(0))
    return joined.withColumn(spans_col, verified(text, asked, rules, scan)).drop(doc, mask)


def redacted(text: Column, spans: Column) -> Column:
    """text with every stretch that spans cover replaced by the kind that begins it, in brackets."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        new = s["start"] >= state["at"]
        shown = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], s["stop"]).alias("at"), F.when(new, shown).otherwise(state["out"]).alias("out")
        )

    return F.aggregate(
        spans, start, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    )
