"""Repeated passages across a corpus, by hashing lines and the sentences in them.

1. A text is cut after sentence marks and line ends, together with the blanks that follow; the pieces
   make up the whole text. A piece with a word becomes a unit: its number, its offsets in code points,
   its weight and a 128-bit digest of its text with A-Z in lower case and single blanks.
2. Digests are grouped over the whole corpus, combined before the shuffle; of each digest that
   occurs more than once the group keeps the earliest rank (id, number) and no list.
3. Units meet the repeated digests; all but the earliest of a digest are later copies. A unit in a third
   of all documents is one hot key of that join, whose unit side adaptive execution splits.
4. Neighbouring later copies of a document form runs. A run of at least LEAST_WEIGHT is removed; a
   lighter one stays, so that a short sentence which many writers use is no passage.
5. Removed runs are gathered per document, bounded by its own units, and the text is put together
   from the stretches between them. Offsets refer to the original text.

The weight of a unit is its number of words, or a tenth of its characters that aren't blanks if that
is more, so that scripts without blanks count too. Words are split at ASCII blanks.

Null and empty texts have no units and stay as they are (null counts as empty). Null ids rank last
and are told apart by their texts. Repeated rows are one document: they keep the same units. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.simhash import LOWER

#: Sentence marks and blanks, fixed.
MARKS, BLANKS = ".!?\u3002\uff01\uff1f", r" \t\n\x0b\f\r"
PIECE = f"[^{MARKS}\\n]*[{MARKS}{BLANKS}]*"
LEAST_WEIGHT = 20
CHARS_A_WORD = 10

pieces = re.compile(PIECE).finditer


def units_of(text: str) -> Iterator[tuple[int, int, int, int, bytes]]:
    """Number, start, end, weight and digest of every unit."""
    for number, piece in enumerate(pieces(text.translate(LOWER))):
        words = piece.group().encode("utf-8", "surrogatepass").split()  # bytes are split at ASCII blanks
        if words:
            unit = b" ".join(words)
            chars = (len(unit) if unit.isascii() else len(unit.decode("utf-8", "surrogatepass"))) - len(words) + 1
            yield number, *piece.span(), max(len(words), chars // CHARS_A_WORD), xxhash.xxh3_128_digest(unit)


def units(texts: DataFrame) -> DataFrame:
    """doc_id, text_key, number, start, stop, weight and digest of every unit of texts (doc_id, text_key, text)."""
    names = ["doc_id", "text_key", "number", "start", "stop", "weight", "digest"]
    kinds = [pa.int32()] * 4 + [pa.binary()]

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                owner, found = [], []
                for row, text in enumerate(part.column(2)):
                    own = list(units_of(text.as_py()))
                    found += own
                    owner += [row] * len(own)
                place = pa.array(owner, pa.int64())
                columns = [pa.array(column, kind) for column, kind in zip(zip(*found) if found else [[]] * 5, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(place), part.column(1).take(place), *columns], names)

    schema = "doc_id long, text_key long, number int, start int, stop int, weight int, digest binary"
    return texts.select("doc_id", "text_key", "text").mapInArrow(run, schema)


def without_repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_weight: int = LEAST_WEIGHT
) -> DataFrame:
    """doc_id, text (what is left) and removed, the runs (start, stop, units) taken out.

    With least_weight 1 every later copy of a line or sentence goes.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    rank = F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text_key")).alias("key"), "number"
    )
    ranked = units(texts).withColumn("rank", rank)
    repeated = (
        ranked.groupBy("digest").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    ).select("digest", "first")
    later = ranked.join(repeated, "digest").filter(F.col("rank") != F.col("first"))
    # repeated rows give every unit several times: dense_rank counts it once, and the sets below keep one
    place = F.dense_rank().over(Window.partitionBy("doc_id", "text_key").orderBy("number"))
    once = later.withColumn("run", F.col("number") - place).groupBy("doc_id", "text_key", "run", "number").agg(
        F.first("start").alias("start"), F.first("stop").alias("stop"), F.first("weight").alias("weight")
    )
    runs = once.groupBy("doc_id", "text_key", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.count(F.lit(1)).cast("int").alias("units"), F.sum("weight").alias("weight")
    )
    removed = runs.filter(F.col("weight") >= least_weight).groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop", "units"))).alias("removed")
    )
    removed = removed.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "removed")
    same = texts["doc_id"].eqNullSafe(F.col("of_id")) & (texts["text_key"] == F.col("of_key"))
    none = F.array().cast("array<struct<start:int,stop:int,units:int>>")
    whole = texts.join(removed, same, "left").select("doc_id", "text", F.coalesce("removed", none).alias("removed"))
    begins = F.concat(F.array(F.lit(0)), F.col("removed.stop"))
    ends = F.concat(F.col("removed.start"), F.array(F.length("text")))
    stretches = F.transform(F.arrays_zip(begins.alias("begin"), ends.alias("end")), lambda s: F.substring("text", s["begin"] + 1, s["end"] - s["begin"]))
    left = F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(stretches, ""))
    return whole.select("doc_id", left.alias("text"), "removed")
