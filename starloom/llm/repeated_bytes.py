"""Repeated byte strings across a corpus, by prefix-free parsing.

Removes every byte covered by a string of LENGTH bytes that also starts earlier: in a document of
smaller id, or earlier in the same one. All strings of the input count, overlapping ones too.

1. Parsing. A rolling hash runs over TRIGGER-byte windows. Each string of LENGTH bytes has its
   trigger, the leftmost window of least hash inside it. Neighbouring strings with the same
   trigger form a phrase; phrases overlap, so no phrase is a prefix of another's continuation.
   Equal strings have equal triggers at equal offsets, wherever they stand.
2. Dictionary. The phrase occurrences (the parse) are sorted by trigger, phrase and corpus order.
   An occurrence of a phrase that stands earlier too repeats as a whole. A first occurrence
   matters further only if other phrases share its trigger.
3. Suffixes. Only the strings of those first occurrences are sorted, cut at LENGTH bytes and
   represented by 128-bit hashes, again with corpus order as the last key; all but the first of
   equal ones repeat. Full suffix ranks aren't needed, as only equality of LENGTH bytes counts.
4. Repeated stretches are gathered per document and cut out of its bytes.

Exact copies and passages cost one row per phrase, not one per byte, and sorting is external, so
no group is ever held in memory: a sorted partition is read as a stream that keeps one row.
Written tables in the shared folder separate the steps, and shuffle files of a finished step are
removed.

Null and empty texts have no bytes. Null ids rank last, by their texts. Rows with the same id and
text are one document: they lose the same bytes, none because of each other. An empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path

LENGTH = 100
TRIGGER = 48
#: Bytes hashed at once; longer documents are hashed in stretches that overlap by LENGTH - 1.
STRETCH = 1 << 20

#: A place packs a start (32 bits), a count of strings (7) and a trigger offset (7); 18 bits are free.
START, COUNT, OFFSET = 32, 25, 18
LAST_ID = (1 << 63) - 1
REPEATED, SHARED = 0, 1
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@lru_cache(maxsize=2)
def powers(multiplier: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values, powers and inverse powers of a rolling hash modulo 2**64."""
    bytes_ = np.random.default_rng(multiplier).integers(0, 1 << 64, 256, dtype=np.uint64)

    def series(base: int) -> np.ndarray:
        out = np.full(STRETCH + 1, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return bytes_, series(multiplier), series(pow(multiplier, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """Hashes of all substrings of a stretch of bytes, in constant time each."""

    def __init__(self, data: np.ndarray, multiplier: int = 0x9E3779B97F4A7C15):
        values, power, self.inverse = powers(multiplier)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.inverse[start]

    def windows(self, size: int) -> np.ndarray:
        return mixed((self.sums[size:] - self.sums[:-size]) * self.inverse[: len(self.sums) - size])


def least_places(values: np.ndarray, window: int) -> np.ndarray:
    """For every window the place of its least value, the leftmost of equal ones."""
    place, span = np.arange(len(values), dtype=np.int32), 1
    while span < window:
        step = min(span, window - span)
        left, right = values[:-step], values[step:]
        place = np.where(left <= right, place[:-step], place[step:])
        values = np.minimum(left, right)
        span += step
    return place


def stretches(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for begin in range(0, max(len(data) - LENGTH + 1, 0), STRETCH - LENGTH + 1):
        yield begin, data[begin : begin + STRETCH]


def phrases(data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(trigger hash, phrase hash, first string, number of strings, trigger offset) of every phrase."""
    for begin, part in stretches(data):
        hashes = Hashes(part)
        trigger_hash = hashes.windows(TRIGGER)
        trigger = least_places(trigger_hash, LENGTH - TRIGGER + 1)
        change = np.flatnonzero(np.diff(trigger)) + 1
        first = np.concatenate([[0], change])
        last = np.concatenate([change, [len(trigger)]]) - 1
        at = trigger[first]
        shape = ((last - first) << 8 | (at - first)).astype(np.uint64)
        phrase = mixed(hashes.of(first, last + LENGTH) + shape * np.uint64(0xD6E8FEB86659FD93))
        yield trigger_hash[at], phrase, begin + first, last - first + 1, at - first


def bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (nulls last), key (64 bits, of the text) and text; repeated rows share doc and key."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.col(id_col).isNull().alias("no_id"),
        F.xxhash64(text).alias("key"),
        text.alias("text"),
    )


def parse(texts: DataFrame) -> DataFrame:
    """One row per phrase occurrence: trigger, phrase, doc, place, key."""
    names = ["a", "b", "doc", "place", "key"]

    def run(batches):
        for batch in batches:
            for doc, key, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2)):
                for trigger, phrase, first, count, offset in phrases(bytes_of(text.as_py())):
                    place = first << START | count << COUNT | offset << OFFSET
                    owner = np.full(len(first), doc), place, np.full(len(first), key)
                    columns = [trigger.view(np.int64), phrase.view(np.int64), *owner]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return texts.select("doc", "key", "text").mapInArrow(gathered(run), "a long, b long, doc long, place long, key long")


def gathered(run: Callable, rows: int = 20_000) -> Callable:
    """run with its small batches put together, so that a batch's fixed cost is paid rarely."""

    def wrapped(batches):
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return wrapped


def in_corpus_order(rows: DataFrame) -> DataFrame:
    """rows dealt by their first key and sorted within partitions, by spilling sorts."""
    return rows.repartition(F.col("a")).sortWithinPartitions("a", "b", "doc", "key", "place")


def columns_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    """a, b, doc, place and key, which is zero if documents are told apart by doc alone."""
    found = [column.to_numpy() for column in batch.columns]
    return found if len(found) > 4 else [*found, np.zeros(batch.num_rows, np.int64)]


def later_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted phrases: REPEATED ones, and first ones whose trigger other phrases SHARE.

    One row is carried over between batches: the first of its trigger and of its phrase.
    """
    names = ["doc", "place", "key", "kind"]
    carried = None  # trigger, phrase, doc, place, key of the phrase's first, and of the trigger's first if unresolved
    for batch in batches:
        a, b, doc, place, key = columns_of(batch)
        n = len(a)
        if not n:
            continue
        out = []
        new_a, new_b = np.ones(n, bool), np.ones(n, bool)
        new_a[1:] = a[1:] != a[:-1]
        new_b[1:] = new_a[1:] | (b[1:] != b[:-1])
        if carried and carried["a"] == a[0]:
            new_a[0] = False
            new_b[0] = carried["b"] != b[0]
        start_b = np.maximum.accumulate(np.where(new_b, np.arange(n), -1))
        inherited = start_b < 0
        first_doc = np.where(inherited, carried["doc"] if carried else 0, doc[start_b])
        first_place = np.where(inherited, carried["place"] if carried else 0, place[start_b])
        first_key = np.where(inherited, carried["key"] if carried else 0, key[start_b])
        first = (doc == first_doc) & (place == first_place) & (key == first_key)
        out.append((doc[~first], place[~first], key[~first], REPEATED))
        # Firsts of further phrases of a trigger are shared, and so is the trigger's first phrase.
        further = new_b & ~new_a
        out.append((doc[further], place[further], key[further], SHARED))
        start_a = np.maximum.accumulate(np.where(new_a, np.arange(n), -1))
        heads = np.unique(start_a[further])
        pending = carried["pending"] if carried else None
        if len(heads) and heads[0] < 0:
            if pending:
                out.append((*(np.array([x]) for x in pending), SHARED))
            pending = None
            heads = heads[1:]
        out.append((doc[heads], place[heads], key[heads], SHARED))
        tail = int(start_a[-1])
        if tail >= 0:
            pending = None if tail in heads else (doc[tail], place[tail], key[tail])
        carried = {"a": a[-1], "b": b[-1], "doc": first_doc[-1], "place": first_place[-1], "key": first_key[-1], "pending": pending}
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(np.concatenate([rows[i] for rows in out])) for i in range(3)),
                pa.array(np.concatenate([np.full(len(rows[0]), rows[3], np.int8) for rows in out])),
            ],
            names,
        )


def later_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted strings all but the first of equal ones; carries that first one over."""
    carried = None
    for batch in batches:
        a, b, doc, place, key = columns_of(batch)
        n = len(a)
        if not n:
            continue
        new = np.ones(n, bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        if carried:
            new[0] = carried[:2] != (a[0], b[0])
        start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        inherited = start < 0
        first_doc = np.where(inherited, carried[2] if carried else 0, doc[start])
        first_place = np.where(inherited, carried[3] if carried else 0, place[start])
        first_key = np.where(inherited, carried[4] if carried else 0, key[start])
        later = (doc != first_doc) | (place != first_place) | (key != first_key)
        carried = (a[-1], b[-1], first_doc[-1], first_place[-1], first_key[-1])
        yield pa.RecordBatch.from_arrays([pa.array(c[later]) for c in (doc, place, key)], ["doc", "place", "key"])


def by_document(places: DataFrame) -> DataFrame:
    """of_doc, of_key and the document's own places."""
    owner = F.col("doc").alias("of_doc"), F.col("key").alias("of_key")
    return places.groupBy(*owner).agg(F.collect_list("place").alias("places"))


def strings(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """The strings of shared phrases: two hashes, doc, place (a start) and key."""
    own = by_document(shared)
    joined = texts.join(own, (F.col("doc") == F.col("of_doc")) & (F.col("key") == F.col("of_key")))
    names = ["a", "b", "doc", "place", "key"]

    def run(batches):
        for batch in batches:
            for doc, key, text, places in zip(
                *(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2), batch.column(3)
            ):
                packed = np.unique(places.values.to_numpy())
                count = packed >> COUNT & 127
                ends = np.cumsum(count)
                starts = np.repeat((packed >> START) - (ends - count), count) + np.arange(ends[-1])
                for begin, part in stretches(bytes_of(text.as_py())):
                    mine = starts[(starts >= begin) & (starts <= begin + len(part) - LENGTH)]
                    at = mine - begin
                    pair = [mixed(Hashes(part, m).of(at, at + LENGTH)) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
                    columns = [*(h.view(np.int64) for h in pair), np.full(len(at), doc), mine << START, np.full(len(at), key)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    rows = joined.select("doc", "key", "text", "places")
    return rows.mapInArrow(gathered(run), "a long, b long, doc long, place long, key long")


def cut_out(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (start, stop) and kept (the bytes left) of every text.

    repeated holds places: a start and a number of strings, zero standing for one.
    """
    own = by_document(repeated)
    same = (F.col("doc") == F.col("of_doc")) & (F.col("key") == F.col("of_key"))
    joined = texts.join(own, same, "left").select("doc", "no_id", "text", "places")
    names = ["doc_id", "n_bytes", "spans", "kept"]
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                sizes, spans, kept = [], [], []
                for text, places in zip(part.column(2), part.column(3)):
                    data = text.as_py().encode("utf-8", "surrogatepass")
                    found = merged(np.sort(places.values.to_numpy())) if places.is_valid else []
                    sizes.append(len(data))
                    spans.append([{"start": a, "stop": b} for a, b in found])
                    edges = [0, *(x for span in found for x in span), len(data)]
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                ids = pa.array(
                    [None if no_id else doc for doc, no_id in zip(*(part.column(i).to_pylist() for i in (0, 1)))],
                    pa.int64(),
                )
                columns = [ids, pa.array(sizes, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def merged(packed: np.ndarray) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by sorted places."""
    start = packed >> START
    stop = start + np.maximum(packed >> COUNT & 127, 1) - 1 + LENGTH
    reach = np.maximum.accumulate(stop)
    opens = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return list(zip(start[opens].tolist(), reach[np.append(opens[1:], len(start)) - 1].tolist()))


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files go when the query that made them has ended."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans removed and kept bytes of every document."""
    texts = prepared(docs, id_col, text_col)
    with shuffles_removed(docs.sparkSession):
        found = stored(
            in_corpus_order(parse(texts)).mapInArrow(later_phrases, "doc long, place long, key long, kind byte"), "phrases"
        )
        shared = found.filter(F.col("kind") == SHARED).select("doc", "place", "key")
        later = stored(
            in_corpus_order(strings(texts, shared)).mapInArrow(later_strings, "doc long, place long, key long"), "strings"
        )
    repeated = found.filter(F.col("kind") == REPEATED).select("doc", "place", "key").union(later)
    return cut_out(texts, repeated)
