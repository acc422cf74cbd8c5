"""Benchmark passages in documents, by q-gram lemma filtering.

A region of a text matches an item of m characters if at most k edits turn one into the other,
k being a tenth of m. By the q-gram lemma such a region shares at least m - q + 1 - kq q-grams with
the item, all on diagonals (place in the text less place in the item) that differ by at most k.

1. The items' q-grams are indexed. A text's rolling q-gram hashes are looked up in one pass.
2. Shared q-grams are counted per item in diagonal bands of a power of two at least k wide; two
   neighbouring bands together are an overlapping band that holds every match. Bands below the
   bound are dropped.
3. The bands left are verified by banded alignment with free ends in the text, in which only
   diagonals within k of the band are computed. The alignment gives edits, start and stop.

Letters compare without case and any white space as a blank; offsets are code points of the
original text. Items are the query set: they go to the workers in blocks of BLOCK characters, one
narrow pass over the documents per block, so an index never outgrows a worker; the driver holds one
block at a time, as each pass of several is stored before the next block is fetched. Texts are looked
at in slices of SLICE characters that overlap by more than a match, so every place of every text
counts. There is no shuffle.

Null and empty texts match nothing; null and empty items are ignored; items shorter than q
characters match only exactly; repeated documents and items each give rows; an empty table on
either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import free_name, map_rows
from starloom.session import cut_lineage

Q = 8
BUDGET = 0.1
BLOCK = 4_000_000
SLICE = 1_000_000
TABLE_BITS = 22
#: Candidates aligned together.
TOGETHER = 64

MIX = np.uint64(0x9E3779B97F4A7C15)
NONE = np.uint32(0xFFFFFFFF)  # no character


def codes(text: str) -> np.ndarray:
    """Folded code points, one per code point of text."""
    folded = text.lower()
    if len(folded) != len(text):
        folded = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    found = np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    found[(found <= 32) & ((found == 32) | ((found >= 9) & (found <= 13)))] = 32
    return found


def gram_hashes(characters: np.ndarray) -> np.ndarray:
    n = len(characters) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    wide = characters.astype(np.uint64)
    out = wide[:n].copy()
    for i in range(1, Q):
        out *= MIX
        out += wide[i : i + n]
    out ^= out >> np.uint64(29)
    out *= MIX
    return out


def exact_places(characters: np.ndarray, wanted: np.ndarray) -> list[int]:
    if len(characters) < len(wanted):
        return []
    windows = np.lib.stride_tricks.sliding_window_view(characters, len(wanted))
    return np.flatnonzero((windows == wanted).all(axis=1)).tolist()


class Items:
    """The q-gram index of a block of items."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = ids
        self.codes = [codes(t) for t in texts]
        self.size = np.array([len(c) for c in self.codes], np.int64)
        most = np.maximum((self.size - Q) // Q, 0)  # keeps the bound above zero
        self.edits = np.minimum((self.size * BUDGET).astype(int), most)
        self.shift = np.array([max(int(k) - 1, 0).bit_length() for k in self.edits], np.int64)
        self.bound = self.size - Q + 1 - self.edits * Q
        self.short = [i for i, size in enumerate(self.size) if size < Q]
        self.reach = int((self.size + 3 * (1 << self.shift) + 2 * self.edits).max(initial=0)) + Q
        hashes = [gram_hashes(c) for c in self.codes]
        every = np.concatenate([np.empty(0, np.uint64), *hashes])
        item = np.repeat(np.arange(len(hashes)), np.array([len(h) for h in hashes], np.int64))
        place = np.concatenate([np.empty(0, int), *(np.arange(len(h)) for h in hashes)])
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.grams >> np.uint64(64 - TABLE_BITS)] = True

    def hits(self, characters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, item, place in the item) of every shared q-gram."""
        hashes = gram_hashes(characters)
        at = np.flatnonzero(self.table[hashes >> np.uint64(64 - TABLE_BITS)])
        gram = np.searchsorted(self.grams, hashes[at])
        gram[gram == len(self.grams)] = 0
        same = self.grams[gram] == hashes[at] if len(self.grams) else np.zeros(len(at), bool)
        at, gram = at[same], gram[same]
        n = self.count[gram]
        posting = np.repeat(self.first[gram] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item = self.item[posting]
        # An item without enough shared q-grams in the whole text has no band with enough either.
        enough = (np.bincount(item, minlength=len(self.size)) >= self.bound)[item]
        return np.repeat(at, n)[enough], item[enough], self.place[posting[enough]]

    def bands(self, at: np.ndarray, item: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, band): overlapping bands of two widths that meet the item's bound."""
        band = (at - place) >> self.shift[item]
        keys, counts = np.unique((item << 40) + (band + (1 << 39)), return_counts=True)
        keys, counts = np.concatenate([keys, keys - 1]), np.concatenate([counts, counts])
        keys, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, counts, len(keys))
        item = keys >> 40
        met = total >= self.bound[item]
        return item[met], (keys[met] & ((1 << 40) - 1)) - (1 << 39)

    def on_diagonal(self, characters, item, band, at, of, place) -> tuple[np.ndarray, np.ndarray]:
        """Bands whose fullest diagonal holds the whole item without an edit, and where it begins.

        Any other match in such a band overlaps that one, as a band is narrower than its item.
        """
        exact, start = np.zeros(len(item), bool), np.zeros(len(item), np.int64)
        diagonal = at - place
        for row, (i, b) in enumerate(zip(item, band)):
            low = b << self.shift[i]
            mine = diagonal[of == i] - low
            mine = mine[(mine >= 0) & (mine < 2 << self.shift[i])]
            start[row] = low + np.bincount(mine).argmax()
            stop = start[row] + self.size[i]
            if start[row] >= 0 and stop <= len(characters):
                exact[row] = np.array_equal(characters[start[row] : stop], self.codes[i])
        return exact, start

    def align(self, characters: np.ndarray, item: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Rows (edits, start, stop) of the best alignment of each item inside its band."""
        k, width = self.edits[item], 1 << self.shift[item]
        low = band * width - k
        span = int((2 * width + 2 * k).max()) + 1
        size = self.size[item]
        longest = int(size.max())
        pattern = np.full((len(item), longest), NONE)
        for row, i in enumerate(item):
            pattern[row, : self.size[i]] = self.codes[i]
        places = low[:, None] + np.arange(longest + span)
        inside = (places >= 0) & (places < len(characters))
        text = np.where(inside, characters[np.clip(places, 0, len(characters) - 1)], NONE - np.uint32(1))
        # A cell is its cost and, to break ties and to remember it, the place where its path began.
        edit, lanes = np.int64(1) << 32, np.arange(span, dtype=np.int64) << 32
        cells = np.broadcast_to(np.arange(span, dtype=np.int64), (len(item), span)).copy()
        out = np.empty((len(item), 3), np.int64)
        for row in range(longest):
            dropped = cells[:, 1:] + edit
            cells = cells + np.where(pattern[:, row, None] == text[:, row : row + span], 0, edit)
            np.minimum(cells[:, :-1], dropped, out=cells[:, :-1])
            cells = np.minimum.accumulate(cells - lanes, axis=1) + lanes
            if (ends := size == row + 1).any():
                lane = cells[ends].argmin(axis=1)
                best = cells[ends][np.arange(len(lane)), lane]
                out[ends, 0] = best >> 32
                out[ends, 1] = low[ends] + (best & 0xFFFFFFFF)
                out[ends, 2] = low[ends] + lane + size[ends]
        out[:, 1:] = np.clip(out[:, 1:], 0, len(characters))
        return out

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, stop, edits), the best of overlapping regions of an item."""
        characters = codes(text)
        found: dict[int, set[tuple[int, int, int]]] = {}
        step = max(SLICE - self.reach, self.reach)
        for begin in range(0, max(len(characters) - self.reach, 1), step):
            part = characters[begin : begin + step + self.reach]
            hits = self.hits(part)
            if not len(hits[0]):
                continue
            item, band = self.bands(*hits)
            exact, start = self.on_diagonal(part, item, band, *hits)
            for i, place in zip(item[exact].tolist(), start[exact].tolist()):
                found.setdefault(i, set()).add((0, begin + place, begin + place + int(self.size[i])))
            left = ~exact
            for i, place in zip(item[exact], start[exact]):  # matches in bands this near overlap it as well
                left &= (item != i) | (abs((band << self.shift[i]) - place) > 3 << self.shift[i])
            item, band = item[left], band[left]
            for at in range(0, len(item), TOGETHER):
                some = item[at : at + TOGETHER]
                for i, (edits, start, stop) in zip(some, self.align(part, some, band[at : at + TOGETHER]).tolist()):
                    if edits <= self.edits[i]:
                        found.setdefault(int(i), set()).add((edits, begin + start, begin + stop))
        for i in self.short:
            for start in exact_places(characters, self.codes[i]):
                found.setdefault(i, set()).add((0, start, start + int(self.size[i])))
        rows = []
        for i, regions in found.items():
            kept: list[tuple[int, int]] = []
            for edits, start, stop in sorted(regions):
                if all(stop <= a or b <= start for a, b in kept):
                    kept.append((start, stop))
                    rows.append((i, start, stop, edits))
        return sorted(rows)


def blocks(
    items: DataFrame, id_col: str, text_col: str, block: int = BLOCK
) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """The number of blocks of about block characters, and the blocks, each fetched when it is its turn."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("text <> ''")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // block))
    bucket = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return n, ([tuple(r) for r in rows.filter(bucket == i).sort("id", "text").collect()] for i in range(n))


def one_at_a_time(found: DataFrame, n: int) -> DataFrame:
    """The result of a block's pass; of several blocks each is let go before the next is fetched."""
    return found if n == 1 else cut_lineage(found)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """doc_id, item_id, start, stop and edits of every matching region."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.filter("text <> ''")
    schema = "doc_id long, item_id long, start long, stop long, edits long"
    names = ["doc_id", "item_id", "start", "stop", "edits"]

    def searched(some: list[tuple[int, str]]) -> DataFrame:
        def run(batches):
            index = Items([i for i, _ in some], [t for _, t in some])
            for batch in batches:
                rows = [
                    (doc_id, index.ids[i], start, stop, edits)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for i, start, stop, edits in index.find(text.as_py())
                ]
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        return source.mapInArrow(run, schema)

    n, parts = blocks(items, item_id_col, item_text_col, block)
    return reduce(DataFrame.union, (one_at_a_time(searched(some), n) for some in parts))


def clean(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """Rows of docs without a matching region, one narrow pass per block of items."""
    flag = free_name(docs, "contaminated")

    def without(rows: DataFrame, some: list[tuple[int, str]]) -> DataFrame:
        def make():
            index = Items([i for i, _ in some], [t for _, t in some])
            return lambda texts: [pa.array([bool(index.find(text)) for text in texts], pa.bool_())]

        return map_rows(rows, text_col, make, f"{flag} boolean").filter(~F.col(flag)).drop(flag)

    n, parts = blocks(items, item_id_col, item_text_col, block)
    for some in parts:
        docs = one_at_a_time(without(docs, some), n)
    return docs
