"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one 64-bit mask
with bit i set where rule i failed. Policies are versioned masks: applying one, comparing two or
asking what each rule alone removes needs only the mask, never the texts again.

`ledger` is a narrow pass without a shuffle. `ablation` groups by mask first (at most one row per
combination of failed rules and task), so no document moves.

Null texts count as empty, fail the word-count rule and have zero measurements; null ids stay
null; repeated rows each give a row; an empty table gives an empty ledger; other columns are kept
out of the ledger.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import SPACES, let

WORD_GAP = r"[ \t-\r]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the measurements; its place in RULES is its bit."""

    name: str
    fails: Callable[[], Column]


@dataclass(frozen=True)
class Policy:
    """A version and the rules that it enforces."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, rule in enumerate(RULES) if rule.name in self.rules)


c = F.col
RULES = (
    Rule("too_few_words", lambda: c("n_words") < 50),
    Rule("repeated_words", lambda: 100 * c("n_repeat_words") > 50 * c("n_words")),
    Rule("symbols", lambda: 10 * c("n_symbols") > 3 * c("n_words")),
    Rule("short_words", lambda: c("word_chars") < 2 * c("n_words")),
    Rule("long_words", lambda: c("word_chars") > 15 * c("n_words")),
    Rule("repeated_lines", lambda: 100 * c("n_dup_lines") > 50 * c("n_lines")),
)
BASE = Policy("base", ("too_few_words", "repeated_words"))
STRICT = Policy("strict-1", tuple(rule.name for rule in RULES))


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the array.

    Windows are sorted with their places; a window equal to a neighbour occurs again. The places
    found, in order, cover three words each, less what the next one covers too.
    """

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(2), F.size(w) - 1), lambda i: F.concat_ws(" ", w[i - 2], w[i - 1], w[i]))

    def places(keys: Column) -> Column:
        def flagged(order: Column) -> Column:
            return F.filter(
                F.transform(
                    order,
                    lambda s, i: F.when(
                        (s["key"] == F.get(order, i - 1)["key"]) | (s["key"] == F.get(order, i + 1)["key"]), s["at"]
                    ),
                ),
                lambda p: p.isNotNull(),
            )

        pairs = F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("at")))
        return F.sort_array(let(F.sort_array(pairs), flagged))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, s: total + s)

    def count(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(let(places(keys), covered))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(windows(words), count))


def measured(text: Column) -> Column:
    """All measurements of a text as one struct."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        )

    def of_lines(held: Column) -> Column:
        return F.struct(
            F.size(held).alias("n_lines"), (F.size(held) - F.size(F.array_distinct(held))).alias("n_dup_lines")
        )

    return F.struct(
        let(words, of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.when(text.rlike(f"[{SYMBOLS}]"), F.length(text) - F.length(F.translate(text, SYMBOLS, "")))
        .otherwise(F.lit(0))
        .alias("n_symbols"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements and failed, the mask of the rules that failed."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc_id"), measured(text).alias("m"))
    places = {
        "n_words": "m.w.n_words", "word_chars": "m.w.word_chars", "n_symbols": "m.n_symbols", "n_lines": "m.l.n_lines",
        "n_dup_lines": "m.l.n_dup_lines", "n_repeat_words": "m.w.n_repeat_words",
    }
    values = found.select("doc_id", *(F.col(place).cast("long").alias(name) for name, place in places.items()))
    failed = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        failed = failed.bitwiseOR(F.when(rule.fails(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return values.withColumn("failed", failed)


def passes(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask)) == 0


def ablation(ledger_rows: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents failing it, and those that it alone removes."""
    masks = ledger_rows.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("mask")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = [(r.name, 1 << i) for i, r in enumerate(RULES) if r.name in policy.rules]
    table = F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in rules))
    each = masks.select("mask", "n", F.explode(table).alias("r")).select("mask", "n", "r.*")
    hit = each.filter(F.col("mask").bitwiseAND(F.col("bit")) != 0)
    return hit.groupBy(F.lit(policy.version).alias("policy"), "rule").agg(
        F.sum("n").alias("n_failed"),
        F.sum(F.when(F.bit_count("mask") == 1, F.col("n")).otherwise(0)).alias("n_only_this"),
    )
