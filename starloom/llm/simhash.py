"""SimHash near-duplicates by a binary trie self-join.

1. A text's fingerprint takes XXH64 of its word shingles; a bit is set if more than half of the
   shingles set it.
2. Equal fingerprints meet in one aggregation; only distinct ones go on.
3. The distinct fingerprints form a binary trie. Node pairs are traversed together from the root:
   a pair's children inherit the bits that differ so far, and a pair is pruned as soon as these
   exceed the budget. The first levels are walked as data: the trie is cut into subtrees of
   bounded size, and every pair of subtrees within the budget is one unit of work, so a subtree is
   sent to a number of units that grows with the logarithm of the table only. The levels below are
   walked inside a task, over sorted arrays, breadth first in chunks of bounded size.
4. A unit returns a spanning forest of the links that it found, so a group of near copies sends as
   many rows as it has members, and not one per pair. Components of the forests are found by
   alternating star contractions, whose state is written to the checkpoint folder.

Null and empty texts have fingerprint zero, linked like any other. A null id gets the component
of its fingerprint and is never a component's name unless all ids in it are null. Repeated rows
each give a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import free_name, map_rows, map_texts
from starloom.session import cut_and_count, cut_lineage, parts_for

BITS = 64
SEED = 42
#: Most fingerprints of a subtree that one unit of work walks; depth of the deepest cut.
SUBTREE = 8_192
DEEPEST = 16
#: Node pairs and leaf pairs held at once while walking a pair of subtrees.
CHUNK = 400_000

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def fingerprint(text: str, shingle: int = 3) -> int:
    words = WORD.findall(text.translate(LOWER))
    if not words:
        return 0
    parts = [words[i:] for i in range(min(shingle, len(words)))]
    return voted(np.array([xxhash.xxh64_intdigest(" ".join(p), SEED) for p in zip(*parts)], np.uint64))


def voted(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes set."""
    votes = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 65_536):
        raw = hashes[begin : begin + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        partial = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8)  # 255 ones fit a byte
        votes += partial.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number."""

    def make():
        def work(_, texts: list[str]) -> list[pa.Array]:
            values = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            return [pa.array(values.view(np.int64))]

        return work

    return map_texts(docs, id_col, text_col, make, "fp long")


def cut_depth(distinct: DataFrame, subtree: int = SUBTREE) -> int:
    """The least depth at which no subtree has more than subtree fingerprints.

    The driver gets one count per node at DEEPEST, at most 2**DEEPEST numbers. Beyond that depth
    subtrees may be larger; they are then walked in chunks all the same.
    """
    node = F.shiftrightunsigned("fp", BITS - DEEPEST)
    rows = distinct.groupBy(node.alias("node")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = np.zeros(1 << DEEPEST, np.int64)
    for row in rows:
        sizes[row.node] = row.n
    for depth in range(DEEPEST):
        if sizes.reshape(1 << depth, -1).sum(axis=1).max() <= subtree:
            return depth
    return DEEPEST


def flips(depth: int, budget: int) -> list[int]:
    """All differences between two nodes of that depth with at most budget bits, zero first."""
    found = [0]
    for _ in range(min(budget, depth)):
        found = sorted({f | 1 << b for f in found for b in range(depth)} | set(found))
    return found


def linked_pairs(left: np.ndarray, right: np.ndarray, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in two sorted arrays whose values differ in at most budget bits, in chunks.

    All values of an array agree in their first depth bits. Node pairs are rows (left from, left
    to, right from, right to, differing bits so far).
    """
    same = left is right
    if not len(left) or not len(right):
        return
    differing = int(np.bitwise_count((left[0] ^ right[0]) >> np.uint64(BITS - depth))) if depth else 0
    root = np.array([[0], [len(left)], [0], [len(right)], [differing]], np.int64)
    stack = [(depth, root)]
    while stack:
        level, nodes = stack.pop()
        if nodes.shape[1] > CHUNK:
            half = nodes.shape[1] // 2
            stack += [(level, nodes[:, :half]), (level, nodes[:, half:])]
            continue
        a, b, c, d, differ = nodes
        work = (b - a) * (d - c)
        small = (work <= 64) | (level >= BITS)
        if small.any():
            yield from leaf_pairs(left, right, nodes[:, small], budget, same)
            nodes = nodes[:, ~small]
            a, b, c, d, differ = nodes
        if not nodes.shape[1]:
            continue
        bit = np.uint64(BITS - 1 - level)
        middle_left = a + zeros_in(left, bit, a, b)
        middle_right = c + zeros_in(right, bit, c, d)
        children = []
        for x in (0, 1):
            for y in (0, 1):
                child = np.stack(
                    [a if x == 0 else middle_left, middle_left if x == 0 else b,
                     c if y == 0 else middle_right, middle_right if y == 0 else d, differ + (x != y)]
                )
                alive = (child[0] < child[1]) & (child[2] < child[3]) & (child[4] <= budget)
                if same:  # of two mirrored pairs one is enough
                    alive &= child[0] <= child[2]
                children.append(child[:, alive])
        stack.append((level + 1, np.concatenate(children, axis=1)))


def zeros_in(values: np.ndarray, bit: np.uint64, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many values of each node have a zero at bit; a node's zeros come first."""
    ones = np.concatenate([[0], np.cumsum((values >> bit) & np.uint64(1), dtype=np.int64)])
    return (end - begin) - (ones[end] - ones[begin])


def leaf_pairs(left, right, nodes, budget: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    a, b, c, d, _ = nodes
    work = (b - a) * (d - c)
    ends = np.cumsum(work)
    total, at, node = int(ends[-1]), 0, 0
    while at < total:
        stop = min(total, at + 4 * CHUNK)
        last = int(np.searchsorted(ends, stop, "left")) + 1
        place = np.arange(at, stop)
        owner = node + np.searchsorted(ends[node:last], place, "right")
        inner = place - (ends[owner] - work[owner])
        width = d[owner] - c[owner]
        x, y = a[owner] + inner // width, c[owner] + inner % width
        near = np.bitwise_count(left[x] ^ right[y]) <= budget
        if same:
            near &= x < y
        yield x[near], y[near]
        at, node = stop, max(last - 1, 0)


def forest(values: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) places for all linked values that aren't their component's root."""
    root = np.arange(len(values))
    for x, y in pairs:
        while len(x):
            rx, ry = root[x], root[y]
            open_ = rx != ry
            if not open_.any():
                break
            x, y, rx, ry = x[open_], y[open_], rx[open_], ry[open_]
            np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
            while (root[root] != root).any():
                root = root[root]
    member = np.flatnonzero(root != np.arange(len(values)))
    return member, root[member]


def links(distinct: DataFrame, budget: int = 3, subtree: int = SUBTREE) -> DataFrame:
    """(src, dst) fingerprints whose components are those of all pairs within budget bits."""
    depth = cut_depth(distinct, subtree)
    near = np.array(flips(depth, budget), np.int64)
    node = F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("long")
    other = node.bitwiseXOR(F.col("flip"))
    units = distinct.select("fp", F.explode(F.lit(near.tolist()).cast("array<long>")).alias("flip")).select(
        F.least(node, other).alias("low"), F.greatest(node, other).alias("high"), "fp"
    )

    def walk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(rows["fp"].to_numpy().view(np.uint64))
        if key[0] == key[1]:
            left = right = values
            pairs = linked_pairs(left, right, depth, budget)
        else:
            side = (values >> np.uint64(BITS - depth)).astype(np.int64) == key[0]
            left, right = values[side], values[~side]
            cut = len(left)  # the low node's values sort first
            pairs = ((x, y + cut) for x, y in linked_pairs(left, right, depth, budget))
        member, root = forest(values, pairs)
        return pd.DataFrame({"src": values[member].view(np.int64), "dst": values[root].view(np.int64)})

    return units.groupBy("low", "high").applyInPandas(walk, "src long, dst long")


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, root) of every node in edges (src, dst); root is the component's least node.

    Each round joins every node's larger neighbours to its least neighbour, then its smaller ones,
    until no edge changes: every edge then ends in a root. Rounds grow with the logarithm of the
    longest path.
    """
    edges, n_edges = cut_and_count(edges.filter("src <> dst").distinct())
    parts = parts_for(2 * n_edges)
    seen = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        large = star(both, lambda node, other, least: other > node, parts)
        down = large.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        small = star(down, lambda node, other, least: F.lit(True), parts)
        edges = cut_lineage(small.coalesce(parts))
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)"))
        ).first()
        if state == seen:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
        seen = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def star(edges: DataFrame, chosen, parts: int) -> DataFrame:
    """Edges (other, least) for each node's chosen neighbours, and (node, least).

    Steps without a shuffle run in so many parts at most: what is left of few edges fills no more.
    """
    edges = edges.coalesce(parts)
    least = edges.groupBy("src").agg(F.least(F.col("src"), F.min("dst")).alias("least"))
    joined = edges.join(least, "src")
    moved = joined.filter(chosen(F.col("src"), F.col("dst"), F.col("least"))).select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    own = least.select("src", F.col("least").alias("dst"))
    return moved.union(own).filter("src <> dst").coalesce(parts).distinct()


def print_components(prints: DataFrame, budget: int = 3) -> DataFrame:
    """fp and root, the least fingerprint reachable over links, for all fingerprints in prints."""
    distinct = cut_lineage(prints.select("fp").distinct())
    roots = components(links(distinct, budget))
    joined = distinct.join(roots, F.col("fp") == F.col("node"), "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 3, shingle: int = 3
) -> DataFrame:
    """doc_id, fp and component_id, the smallest id reachable over links."""
    prints = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    member = print_components(prints, budget)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    member = cut_lineage(member.join(first, "fp"))
    named = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = member.select("fp", "root").join(named, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 3, shingle: int = 3
) -> DataFrame:
    """docs with one row left of every component: the one of the smallest id, nulls last.

    Rows with the same id and fingerprint are one document repeated. Survivors are found on
    fingerprints alone; texts move once, in the join that keeps them.
    """
    prints = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    order = F.struct(F.col("first_id").isNull(), F.col("first_id").alias("id"), F.col("fp").alias("fp"))
    kept = print_components(prints, budget).join(first, "fp").groupBy("root").agg(F.min(order).alias("kept"))
    kept_id, kept_fp = free_name(docs, "kept_id"), free_name(docs, "kept_fp")
    kept = kept.select(F.col("kept.id").alias(kept_id), F.col("kept.fp").alias(kept_fp))

    def make():
        def work(texts: list[str]) -> list[pa.Array]:
            return [pa.array(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))]

        return work

    fp = free_name(docs, "fp")
    marked = map_rows(docs, text_col, make, f"{fp} long")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(kept_id)) & (F.col(fp) == F.col(kept_fp))
    return marked.join(kept, same, "left_semi").dropDuplicates([id_col, fp]).drop(fp)
