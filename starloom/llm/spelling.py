"""Spelling variants of a corpus vocabulary, by edits probed against broadcast Bloom filters.

1. Words of whole texts are counted per task, then over the corpus; words of LEAST_CHARS code points
   and LEAST_COUNT occurrences form the vocabulary.
2. The vocabulary is put into blocked Bloom filters, one per word length: a word sets HASH_BITS bits
   of one 64-bit block. The blocks are formed by a bitwise aggregation.
3. Every word probes its own edits: each deletion against the filter of the next shorter length, and
   each replacement by a larger letter against that of its own length. Insertions and replacements
   by smaller letters are the same links seen from the other word. A word is a polynomial over its
   letters, so the hash of an edit takes one addition instead of a new string.
4. Only edits that a filter admits are shuffled, to an exact join with the vocabulary, which removes
   the false ones. A word has a bounded number of edits, so no word is a hot key of that join.
5. The most frequent near word becomes the form of a word if it is RATIO times as frequent. Counts
   grow by RATIO along a chain of forms, so a few rounds of pointer jumping give every root.

Filters of one pass take at most FILTER_BYTES; a vocabulary whose filters need more is probed in
several passes, each with some lengths or some range of a length's blocks. No edit is left out.

Null and empty texts have no words; a null id counts as an empty one in the hash that plants slips;
repeated rows count as often as they occur; words of equal counts are ordered by code points; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import cut_lineage

#: Letters of a word, fixed; each is one byte in Latin-1.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
LEAST_CHARS = 7
LEAST_COUNT = 2
RATIO = 10
#: Every run whose hash this number divides loses a letter, fixed.
SLIP = 31

HELD = 100_000  # distinct words that a task counts before it passes them on
KEY_BITS, HASH_BITS = 16, 4
CHUNK = 1 << 15  # blocks in a row on their way to the driver
FILTER_BYTES = 64 << 20
CELLS = 1 << 12  # letters of the words that are probed at once

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def slipped(run: str, doc_id: str) -> str:
    """The lower-cased run, without one letter if its hash says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """word and n of every word with at least least_chars code points and least_count occurrences."""
    source = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit("")))

    def listed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = Counter(w for w in RUN.findall(text.as_py().translate(LOWER)) if len(w) >= least_chars)
                for word, n in runs.items():
                    word = slipped(word, doc_id)
                    if len(word) >= least_chars:
                        counts[word] += n
                if len(counts) > HELD:
                    yield listed(counts)
                    counts = Counter()
        yield listed(counts)

    counted = source.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def mixed(values: np.ndarray) -> np.ndarray:
    """The bits of polynomial values spread over all 64 places."""
    h = values ^ (values >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def block_of(hashes: np.ndarray, n_blocks: int) -> np.ndarray:
    return (hashes >> np.uint64(32)) * np.uint64(n_blocks) >> np.uint64(32)


def bits_of(hashes: np.ndarray) -> np.ndarray:
    """The bits that a word sets in its block."""
    bits = np.zeros_like(hashes)
    for k in range(HASH_BITS):
        bits |= np.uint64(1) << (hashes >> np.uint64(6 * k) & np.uint64(63))
    return bits


def letters(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def powers(length: int) -> np.ndarray:
    out = np.full(length, BASE)
    if length:
        out[0] = 1
    return np.multiply.accumulate(out)


def by_length(words: list[str], cells: int = CELLS) -> Iterator[tuple[int, list[int]]]:
    """Places of words of one length, about cells letters at a time."""
    places: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        places.setdefault(len(word), []).append(i)
    for length, own in places.items():
        step = max(1, cells // length)
        for begin in range(0, len(own), step):
            yield length, own[begin : begin + step]


def n_blocks_of(count: int) -> int:
    return max(1, -(-count * KEY_BITS // 64))


def filter_blocks(words: DataFrame, counts: dict[int, int]) -> DataFrame:
    """length, block and bits of the filters of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            for length, places in by_length(found, 1 << 16):
                table = letters([found[i] for i in places], length).astype(np.uint64)
                hashes = mixed((table * powers(length)).sum(axis=1, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(places), length, np.int32)),
                        pa.array(block_of(hashes, n_blocks_of(counts[length])).view(np.int64)),
                        pa.array(bits_of(hashes).view(np.int64)),
                    ],
                    ["length", "block", "bits"],
                )

    rows = words.select("word").mapInArrow(run, "length int, block long, bits long")
    return rows.groupBy("length", "block").agg(F.bit_or("bits").alias("bits"))


Shard = tuple[int, int, int]  # length, first block, end


def passes(counts: dict[int, int], filter_bytes: int) -> list[list[Shard]]:
    """All blocks of all lengths, in groups of at most filter_bytes."""
    most = max(1, filter_bytes // 8)
    groups: list[list[Shard]] = []
    room = 0
    for length in sorted(counts):
        begin, end = 0, n_blocks_of(counts[length])
        while begin < end:
            if not room:
                groups.append([])
                room = most
            take = min(room, end - begin)
            groups[-1].append((length, begin, begin + take))
            begin, room = begin + take, room - take
    return groups


def gathered(blocks: DataFrame, shards: list[Shard]) -> dict[int, tuple[int, np.ndarray]]:
    """First block and bits of every shard, on the driver: at most the bytes that passes() allows."""
    wanted = [(F.col("length") == n) & (F.col("block") >= a) & (F.col("block") < b) for n, a, b in shards]
    chosen = blocks.filter(functools.reduce(operator.or_, wanted))
    rows = chosen.groupBy("length", F.floor(F.col("block") / CHUNK).alias("chunk")).agg(
        F.collect_list("block").alias("block"), F.collect_list("bits").alias("bits")
    )
    out = {n: (a, np.zeros(b - a, np.int64)) for n, a, b in shards}
    for batch in rows.select("length", "block", "bits").toArrow().to_batches():
        for length, block, bits in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            first, held = out[length]
            held[block.values.to_numpy() - first] = bits.values.to_numpy()
    return {n: (a, held.view(np.uint64)) for n, (a, held) in out.items()}


class Prober:
    """Finds the edits of words that the filters of one pass admit."""

    def __init__(self, filters: dict[int, tuple[int, np.ndarray]], n_blocks: dict[int, int], alphabet: bytes):
        self.filters, self.n_blocks = filters, n_blocks
        self.alphabet = np.frombuffer(alphabet, np.uint8)

    def admitted(self, values: np.ndarray, length: int) -> np.ndarray:
        first, held = self.filters[length]
        hashes = mixed(values)
        block = block_of(hashes, self.n_blocks[length]).astype(np.int64) - first
        inside = (block >= 0) & (block < len(held))
        bits = bits_of(hashes)
        return inside & (held[np.where(inside, block, 0)] & bits == bits)

    def probe(self, words: list[str]) -> Iterator[tuple[int, str]]:
        """Place of a word and an admitted edit of it."""
        for length, places in by_length(words):
            own = length in self.filters
            shorter = length - 1 in self.filters
            if not (own or shorter):
                continue
            some = [words[i] for i in places]
            table = letters(some, length)
            wide = table.astype(np.uint64)
            scale = powers(length)
            ends = np.add.accumulate(wide * scale, axis=1)
            whole = ends[:, -1:]
            if shorter:  # of a run of equal letters only the last is deleted
                values = (ends - wide * scale) + (whole - ends) * BASE_INVERSE
                last = np.ones(table.shape, bool)
                last[:, :-1] = table[:, :-1] != table[:, 1:]
                for row, at in np.argwhere(self.admitted(values, length - 1) & last):
                    yield places[row], some[row][:at] + some[row][at + 1 :]
            if own:
                for begin in range(0, length, CELLS):
                    part = slice(begin, begin + CELLS)
                    row, at, new = np.nonzero(self.alphabet > table[:, part, None])
                    at += begin
                    change = self.alphabet[new].astype(np.uint64) - wide[row, at]
                    values = whole[row, 0] + change * scale[at]
                    for k in np.flatnonzero(self.admitted(values, length)):
                        word, i = some[row[k]], at[k]
                        yield places[row[k]], word[:i] + chr(self.alphabet[new[k]]) + word[i + 1 :]


def probed(words: DataFrame, prober: Prober) -> DataFrame:
    """word, n and edit for every admitted edit of words (word, n)."""
    shared = words.sparkSession.sparkContext.broadcast(prober)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                place, edit = [], []
                for i, found in shared.value.probe(part.column(0).to_pylist()):
                    place.append(i)
                    edit.append(found)
                rows = part.take(pa.array(place, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(edit, pa.string())], ["word", "n", "edit"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, edit string")


def near_words(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, near and near_n for every ordered pair of words (word, n) at one edit."""
    counts = {r.length: r.n for r in words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    used = words.select(F.explode(F.split("word", "")).alias("letter")).distinct().collect()
    alphabet = "".join(sorted(r.letter for r in used)).encode("latin-1")
    blocks = cut_lineage(filter_blocks(words, counts))
    sizes = {length: n_blocks_of(n) for length, n in counts.items()}
    found = None
    for shards in passes(counts, filter_bytes):
        some = probed(words, Prober(gathered(blocks, shards), sizes, alphabet))
        found = some if found is None else found.union(some)
    if found is None:
        found = words.select("word", "n", F.col("word").alias("edit")).limit(0)
    known = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    pairs = found.join(known, "edit")
    both = F.array(
        F.struct(F.col("word").alias("word"), F.col("edit").alias("near"), F.col("edit_n").alias("near_n")),
        F.struct(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return pairs.select(F.inline(both))


def with_roots(formed: DataFrame) -> DataFrame:
    """word and root of every word that has a form, over formed (word, form, form_n)."""
    most = formed.agg(F.max("form_n").alias("n")).first()["n"]
    links = cut_lineage(formed.select("word", F.col("form").alias("root")))
    hops, reach = 1, RATIO
    while most is not None and reach <= most:  # a form of a form is RATIO times as frequent again
        hops, reach = hops + 1, reach * RATIO
    for _ in range((hops - 1).bit_length()):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        links = links.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
        links = cut_lineage(links)
    return links


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ratio: int = RATIO,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of the vocabulary of docs."""
    words = cut_lineage(vocabulary(docs, id_col, text_col))
    near = near_words(words, filter_bytes)
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    judged = words.join(best, "word", "left")
    often = -F.col("best.n") >= F.lit(ratio) * F.col("n")
    judged = judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.n")).alias("form_n"),
    )
    judged = cut_lineage(judged)
    roots = with_roots(judged.filter(F.col("form").isNotNull()))
    named = judged.join(roots, "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
