"""Language identification by word-first backoff.

A word that the model knows scores by its per-language log frequency. An unseen word falls back
to its character n-grams, the longest order first; the first order with a known n-gram decides,
by the mean of the log frequencies of its known n-grams. The language with the largest sum wins;
the score is its posterior under equal priors. A word without a known n-gram says nothing; a text is
accepted if at least LEAST_KNOWN of its words say something.

Fitting reads a sample of labelled rows, drawn by a hash of the id so that about MAX_ROWS rows are
expected at any size of table; it counts words in one aggregation and the n-grams of all counted
words in another. The model keeps the MAX_WORDS and MAX_GRAMS most frequent entries of every
language, with their counts in all languages, so what goes to the workers grows with the number of
languages only and a rare language has as many entries as it fills. Prediction covers all words of all texts in a narrow
pass; a worker's cache of unseen words holds at most KEEP entries.

Null texts and texts without letters give `und` with score 0; so does every text if nothing was
learned (an empty table, no labels). A text with letters but without a known word or n-gram gets the
language with the most words learned (ties: the smaller name) with score 1/n; `accepted` rejects it.
Null ids are never learned from, nor rows with a null label;
repeated rows each give a row and count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.frames import free_name, map_rows, map_texts
from starloom.session import cut_lineage

MAX_ROWS = 20_000
MAX_WORDS = 20_000  # per language
MAX_GRAMS = 15_000  # per language
ORDERS = (4, 3, 2, 1)
KEEP = 100_000
LEAST_KNOWN = 0.5
UNKNOWN = "und"

WORD = re.compile(r"[^\W\d_]+")
LETTERS = regex.compile(r"\p{L}+")


@dataclass(frozen=True)
class Model:
    """Centred log frequencies: a row of one value per language for each word and n-gram."""

    languages: tuple[str, ...]
    common: str  # the language with the most words learned
    words: dict[str, int]
    grams: dict[str, int]
    word_rows: np.ndarray
    gram_rows: np.ndarray


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def sampled(labelled: DataFrame, doc_id: Column, max_rows: int) -> DataFrame:
    """About max_rows rows of labelled, by a hash of the id; all of them if there are fewer."""
    share = max_rows / max(labelled.count(), 1)
    if share >= 1:
        return labelled
    return labelled.filter(F.shiftrightunsigned(F.xxhash64(doc_id), 11) < F.lit(int(share * 2**53)))


def log_rows(counts: dict[str, dict[str, int]], languages: tuple[str, ...]) -> tuple[dict[str, int], np.ndarray]:
    table = np.full((len(counts), len(languages)), 0.5)
    place = {language: i for i, language in enumerate(languages)}
    for row, by_language in enumerate(counts.values()):
        for language, n in by_language.items():
            table[row, place[language]] += n
    if table.size:
        logs = np.log(table / table.sum(axis=0))
        table = logs - logs.mean(axis=1, keepdims=True)
    return {entry: i for i, entry in enumerate(counts)}, table


def grams_of(word: str, order: int) -> list[str]:
    edged = f"^{word}$" if order > 1 else word
    return [edged[i : i + order] for i in range(len(edged) - order + 1)]


def all_grams(word: Column) -> Column:
    """The n-grams of a word, of all orders, as grams_of gives them."""
    def cut(text: Column, order: int) -> Column:
        places = F.sequence(F.lit(1), F.length(text) - order + 1)
        none = F.array().cast("array<string>")
        return F.when(F.length(text) >= order, F.transform(places, lambda i: F.substring(text, i, F.lit(order)))).otherwise(none)

    edged = F.concat(F.lit("^"), word, F.lit("$"))
    return F.concat(*(cut(edged if order > 1 else word, order) for order in ORDERS))


def kept_entries(counts: DataFrame, most: int) -> dict[str, dict[str, int]]:
    """Counts by language of every entry that is among the most frequent ones of some language."""
    order = Window.partitionBy("language").orderBy(F.desc("n"), "entry")
    ranked = counts.withColumn("place", F.row_number().over(order))
    by = ranked.groupBy("entry").agg(F.min("place").alias("place"), F.collect_list(F.struct("language", "n")).alias("by"))
    return {r.entry: {x.language: x.n for x in r.by} for r in by.filter(F.col("place") <= most).orderBy("entry").collect()}


def learn(
    docs: DataFrame,
    label_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = MAX_ROWS,
    max_words: int = MAX_WORDS,
    max_grams: int = MAX_GRAMS,
) -> Model:
    labelled = docs.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    rows = sampled(labelled, F.col(id_col), max_rows)
    words = rows.select(
        F.col(label_col).cast("string").alias("language"),
        F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"\p{L}+"), F.lit(0))).alias("entry"),
    )
    counts = cut_lineage(words.groupBy("language", "entry").agg(F.count(F.lit(1)).alias("n")))
    grams = counts.select("language", "n", F.explode(all_grams(F.col("entry"))).alias("entry"))
    grams = grams.groupBy("language", "entry").agg(F.sum("n").alias("n"))
    by_word, by_gram = kept_entries(counts, max_words), kept_entries(grams, max_grams)
    sizes: dict[str, int] = {r.language: r.n for r in counts.groupBy("language").agg(F.sum("n").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    common = min(languages, key=lambda name: (-sizes[name], name), default=UNKNOWN)
    tables = [log_rows(by_word, languages), log_rows(by_gram, languages)]
    return Model(languages, common, tables[0][0], tables[1][0], tables[0][1], tables[1][1])


class Scorer:
    """Rows of the model and of the unseen words met so far, for one task."""

    def __init__(self, model: Model):
        self.model = model
        self.known = len(model.words)
        self.reset()

    def reset(self) -> None:
        self.place = dict(self.model.words)
        self.says = np.ones(self.known + KEEP, bool)
        self.rows = np.empty((self.known + KEEP, len(self.model.languages)))
        self.rows[: self.known] = self.model.word_rows

    def back_off(self, word: str) -> np.ndarray | None:
        for order in ORDERS:
            found = [i for g in grams_of(word, order) if (i := self.model.grams.get(g)) is not None]
            if found:
                return self.model.gram_rows[found].mean(axis=0)
        return None

    def total(self, words: list[str]) -> tuple[np.ndarray, int]:
        """Sum of the rows of the words, and how many say something; KEEP words at a time, so that their rows fit."""
        total, n = np.zeros(len(self.model.languages)), 0
        for begin in range(0, len(words), KEEP):
            part = words[begin : begin + KEEP]
            if len(self.place) + len(part) > len(self.rows):
                self.reset()
            for word in set(part).difference(self.place):
                at = len(self.place)
                row = self.back_off(word)
                self.says[at] = row is not None
                self.rows[at] = 0 if row is None else row
                self.place[word] = at
            places = [self.place[w] for w in part]
            total += self.rows[places].sum(axis=0)
            n += int(np.count_nonzero(self.says[places]))
        return total, n

    def judge(self, text: str) -> tuple[str, float, float]:
        """Language, score and the share of words that say something."""
        words = WORD.findall(text.lower())
        if not all(map(str.isalpha, words)):  # digits such as superscripts
            words = [part for word in words for part in LETTERS.findall(word)]
        if not words or not self.model.languages:
            return UNKNOWN, 0.0, 0.0
        total, n = self.total(words)
        if not n:
            return self.model.common, round(1 / len(self.model.languages), 9), 0.0
        best = int(total.argmax())
        return self.model.languages[best], round(1 / math.fsum(np.exp(total - total[best])), 9), n / len(words)

    def predict(self, text: str) -> tuple[str, float]:
        return self.judge(text)[:2]


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row."""

    def make():
        scorer = Scorer(model)

        def work(_, texts: list[str]) -> list[pa.Array]:
            found = [scorer.predict(text) for text in texts]
            return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

        return work

    return map_texts(docs, id_col, text_col, make, "lang_pred string, score double")


def accepted(
    docs: DataFrame, model: Model, least_score: float = 0.0, text_col: str = "text", least_known: float = LEAST_KNOWN
) -> DataFrame:
    """Rows of docs whose text has a language, predicted with at least least_score from at least least_known of its words."""

    def make():
        scorer = Scorer(model)

        def work(texts: list[str]) -> list[pa.Array]:
            found = [scorer.judge(text) for text in texts]
            keep = [name != UNKNOWN and score >= least_score and known >= least_known for name, score, known in found]
            return [pa.array(keep, pa.bool_())]

        return work

    flag = free_name(docs, "accepted")
    return map_rows(docs, text_col, make, f"{flag} boolean").filter(F.col(flag)).drop(flag)
