"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

1. Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest length, and queries a zero;
   the largest inner product is then the least distance. A Gaussian matrix projects both to
   DIMENSIONS numbers. If a point is at distance d from a query, the squared distance of their
   projections is d^2 times a chi-square variable, whatever the data.
2. A kd-tree over projections, whose upper levels are fitted on a bounded sample of SAMPLE rows, deals
   all candidates into cells, and a hash of the id splits cells of many rows into buckets. Within a
   bucket a task grows the tree down to leaves.
3. A query first searches one bucket of its own cell, which gives a first k-th distance d. It is then
   sent to the buckets of those cells whose box, at projected distance r, fails the stopping test.
4. In a bucket a query verifies whole leaves in the order of their projected distance, by inner products
   of the original vectors, until the test holds: with the next leaf at distance r, a better
   candidate would have stayed nearer than r with probability SURE = chi2(r^2 / d^2). Boxes are never
   farther than their points, so more than SURE of the neighbours are found.
5. The lists of the buckets are merged by a rank.

Buckets and the queries that meet one at a time are bounded. Of equal vectors only the k + 1 smallest
ids are candidates, which no answer misses, and equal queries search once; so groups of copies cost
no more than one vector. Scores are summed in the order of the components, so equal vectors have
equal scores.

Rows with a null id or vector, a component that isn't finite or only zeros take no part. Rows that
share an id count as one, the one of the smallest vector. Shorter vectors are filled up with zeros.
Ties go to the smaller id. A query with fewer candidates than k gets them all; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.vector_rows import cogrouped, matrix, sound
from starloom.session import cut_lineage

DIMENSIONS = 8  # an even number, which the closed form of the chi-square distribution needs
SURE = 0.9
SAMPLE = 16_384
LEAST_SAMPLED = 64  # sampled rows per cell
BUCKET = 4096  # rows of a bucket, about
SLOT = 4096  # queries that meet a bucket at once, about
LEAF = 32
STEP = 16  # leaves that a query visits before it looks at its k-th distance again
TOGETHER = 1024  # queries that walk at once
SEED = 42


def chi_square_quantile(share: float, dimensions: int = DIMENSIONS) -> float:
    """The value below which a chi-square variable of an even number of dimensions stays with this probability."""
    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * math.fsum((x / 2) ** i / math.factorial(i) for i in range(dimensions // 2))

    low, high = 0.0, 1.0
    while below(high) < share:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return high


@dataclass(frozen=True)
class Projection:
    """Scaled vectors, lifted by one component and projected."""

    width: int
    scale: float  # largest absolute component
    longest: float  # largest length of a scaled vector
    dimensions: int = DIMENSIONS

    @property
    def table(self) -> np.ndarray:
        return np.random.default_rng(SEED).standard_normal((self.width + 1, self.dimensions))

    def candidates(self, vectors: np.ndarray) -> np.ndarray:
        scaled, table = vectors / self.scale, self.table
        lifted = np.sqrt(np.maximum(self.longest**2 - np.einsum("ij,ij->i", scaled, scaled), 0))
        return scaled @ table[:-1] + lifted[:, None] * table[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return vectors / self.scale @ self.table[:-1]

    def distances(self, vectors: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Squared lifted distance of candidates of these inner products; infinite for none."""
        scaled = vectors / self.scale
        own = self.longest**2 + np.einsum("ij,ij->i", scaled, scaled)
        return np.maximum(own - 2 * (scores / self.scale / self.scale), 0)


@dataclass(frozen=True)
class Splits:
    """The upper levels of a kd-tree: a complete tree of cuts, by node number from 1."""

    depth: int
    axis: np.ndarray
    cut: np.ndarray

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + (points[rows, self.axis[node]] > self.cut[node])
        return (node - (1 << self.depth)).astype(np.int32)


def fitted(sample: np.ndarray, n_rows: int) -> Splits:
    """Cuts at medians of the widest axis, down to cells of about BUCKET rows of n_rows."""
    cells = min(-(-n_rows // BUCKET), len(sample) // LEAST_SAMPLED)
    depth = max(0, cells - 1).bit_length() if cells > 1 else 0
    axis, cut = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
    held = {1: sample}
    for node in range(1, 1 << depth):
        own = held.pop(node)
        if len(own):
            axis[node] = np.argmax(own.max(axis=0) - own.min(axis=0))
            cut[node] = np.median(own[:, axis[node]])
        right = own[:, axis[node]] > cut[node]
        held[2 * node], held[2 * node + 1] = own[~right], own[right]
    return Splits(depth, axis, cut)


def leaves_of(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Places of the points of every leaf of a kd-tree."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        own = todo.pop()
        if len(own) <= size:
            out.append(own)
            continue
        some = points[own]
        axis = np.argmax(some.max(axis=0) - some.min(axis=0))
        half = len(own) // 2
        order = np.argpartition(some[:, axis], half)
        todo += [own[order[:half]], own[order[half:]]]
    return out


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point from every box."""
    gaps = np.maximum(np.maximum(low[None] - points[:, None], points[:, None] - high[None]), 0)
    return np.einsum("qbd,qbd->qb", gaps, gaps)


class Bucket:
    """Candidates of one bucket, leaf by leaf of a kd-tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projection: Projection):
        points = projection.candidates(vectors)
        leaves = leaves_of(points)
        self.projection = projection
        self.low = np.array([points[own].min(axis=0) for own in leaves])
        self.high = np.array([points[own].max(axis=0) for own in leaves])
        self.sizes = np.array([len(own) for own in leaves])
        self.starts = np.cumsum(self.sizes) - self.sizes
        order = np.concatenate(leaves)
        self.ids, self.vectors = ids[order], vectors[order]
        self.longest = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors).max())

    def products(self, queries: np.ndarray, row: np.ndarray, leaf: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
        """Inner products by matrices, one per leaf; column place of row gets the leaf's candidates."""
        most = int(self.sizes.max())
        out = np.full((len(queries), width * most), -np.inf)
        order = np.argsort(leaf, kind="stable")
        row, leaf, place = row[order], leaf[order], place[order]
        for begin in np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]]):
            end = np.searchsorted(leaf, leaf[begin], "right")
            start, size = self.starts[leaf[begin]], self.sizes[leaf[begin]]
            columns = place[begin:end, None] * most + np.arange(size)
            out[row[begin:end, None], columns] = queries[row[begin:end]] @ self.vectors[start : start + size].T
        return out

    def exact(self, queries: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Inner products of rows, summed in the order of the components."""
        total = np.zeros(len(at))
        for x, y in zip(queries.T, self.vectors[at].T):
            total += x * y
        return total

    def search(self, queries: np.ndarray, first: np.ndarray, k: int, limit: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores and ids of the k best verified candidates per query, and how many were verified.

        first has k-th scores known from elsewhere. Free places have a score of minus infinity. Matrix
        products only choose, within a bound on their rounding, what is summed exactly.
        """
        n, most = len(queries), int(self.sizes.max())
        scores, ids = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        slack = 4 * queries.shape[1] * np.finfo(float).eps * self.longest * np.sqrt(np.einsum("ij,ij->i", queries, queries))
        reach = box_distances(self.projection.queries(queries), self.low, self.high)
        order = np.argsort(reach, axis=1, kind="stable")
        active, verified = np.arange(n), 0
        for begin in range(0, order.shape[1], STEP):
            leaf = order[active, begin : begin + STEP]
            known = np.maximum(first[active], scores[active, -1])
            bound = limit * self.projection.distances(queries[active], known)
            open_ = np.take_along_axis(reach[active], leaf, 1) <= bound[:, None]
            going = open_[:, 0]  # leaves come in the order of their distance
            active, leaf, known, open_ = active[going], leaf[going], known[going], open_[going]
            if not len(active):
                break
            row, place = np.nonzero(open_)
            leaf_of = leaf[row, place]
            verified += int(self.sizes[leaf_of].sum())
            found = self.products(queries[active], row, leaf_of, place, leaf.shape[1])
            if found.shape[1] > k:
                known = np.maximum(known, np.partition(found, -k, axis=1)[:, -k])
            row, column = np.nonzero((found >= (known - slack[active])[:, None]) & (found > -np.inf))
            at = self.starts[leaf[row, column // most]] + column % most
            better = self.exact(queries[active[row]], at)
            merged = np.unique(row)
            row = np.searchsorted(merged, row)
            rows = active[merged]
            owner = np.concatenate([np.repeat(np.arange(len(rows)), k), row])
            both = np.concatenate([scores[rows].ravel(), better])
            names = np.concatenate([ids[rows].ravel(), self.ids[at]])
            best = np.lexsort((names, -both, owner))
            starts = np.searchsorted(owner[best], np.arange(len(rows)))
            chosen = best[starts[:, None] + np.arange(k)]
            scores[rows], ids[rows] = both[chosen], names[chosen]
        return scores, ids, verified


FOUND = "query long, vec_id long, score double"


@dataclass(frozen=True)
class Index:
    """What the driver and all tasks know of the cells: no more rows than the sample."""

    projection: Projection
    splits: Splits
    cells: np.ndarray  # numbers of the cells that have rows
    parts: np.ndarray  # buckets of each
    low: np.ndarray
    high: np.ndarray


def build(candidates: DataFrame, dimensions: int = DIMENSIONS) -> tuple[Index, DataFrame]:
    """The index of candidates (id, vector of doubles), and all of them in its buckets (cell, part, cand_id, vector)."""
    sizes = candidates.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"),
        F.max(F.array_max(F.transform("vector", F.abs))).alias("scale"),
    ).first()
    n, width, scale = sizes["n"], sizes["width"] or 1, sizes["scale"] or 1.0
    squares = F.aggregate(F.transform("vector", lambda x: (x / scale) * (x / scale)), F.lit(0.0), lambda a, b: a + b)
    longest = math.sqrt(candidates.agg(F.max(squares).alias("most")).first()["most"] or 1.0)
    projection = Projection(width, scale, longest, dimensions)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = projection.candidates(matrix(batch.column(0), width))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(points.ravel(), dimensions).cast(pa.list_(pa.float64()))], ["point"])

    drawn = candidates.filter(F.shiftrightunsigned(F.xxhash64("id"), 11) <= F.lit(int(min(1.0, SAMPLE / max(n, 1)) * 2**53)))
    sample = matrix(drawn.select("vector").mapInArrow(project, "point array<double>").toArrow()["point"], dimensions)
    splits = fitted(sample, n)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = projection.candidates(matrix(batch.column("vector"), width))
            lists = pa.FixedSizeListArray.from_arrays(points.ravel(), dimensions).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(splits.cells(points)), lists], ["id", "vector", "cell", "point"])

    rows = candidates.select("id", "vector").mapInArrow(dealt, "id long, vector array<double>, cell int, point array<double>")
    rows = cut_lineage(rows)
    ends = [f(F.col("point")[i]).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(dimensions)]
    boxes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *ends).orderBy("cell").collect()
    cells = np.array([b["cell"] for b in boxes], np.int32)
    parts = np.array([-(-b["n"] // (2 * BUCKET)) for b in boxes], np.int32)
    low, high = (np.array([[b[f"{f}{i}"] for i in range(dimensions)] for b in boxes]).reshape(-1, dimensions) for f in ("min", "max"))
    by_cell = np.ones(1 << splits.depth, int)
    by_cell[cells] = parts
    part = F.pmod(F.xxhash64("id"), F.element_at(F.lit(by_cell.tolist()), F.col("cell") + 1)).cast("int")
    placed = rows.select("cell", part.alias("part"), F.col("id").alias("cand_id"), "vector")
    return Index(projection, splits, cells, parts, low, high), placed


def routed(index: Index, queries: DataFrame, limit: float, onward: bool) -> DataFrame:
    """queries (query, vector, known) with the buckets (cell, part) that they search next.

    At first that is one bucket of a query's own cell; onward it is all others that its k-th score
    can't rule out.
    """
    own, width = index.projection, index.projection.width
    order = np.full(1 << index.splits.depth, -1)
    order[index.cells] = np.arange(len(index.cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(begin, TOGETHER)
                vectors, known = matrix(some.column("vector"), width), some.column("known").to_numpy(zero_copy_only=False)
                numbers = some.column("query").to_numpy().view(np.uint64)
                points = own.queries(vectors)
                home = order[index.splits.cells(points)]
                reach = box_distances(points, index.low, index.high)
                home = np.where(home < 0, reach.argmin(axis=1), home)
                first = (numbers * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % index.parts[home]
                if onward:
                    row, at = np.nonzero(reach <= limit * own.distances(vectors, known)[:, None])
                    times = index.parts[at]
                    row, at = np.repeat(row, times), np.repeat(at, times)
                    part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                    new = (at != home[row]) | (part != first[row])
                    row, at, part = row[new], at[new], part[new]
                else:
                    row, at, part = np.arange(len(vectors)), home, first
                taken = some.take(pa.array(row))
                places = [pa.array(index.cells[at]), pa.array(part.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*taken.columns, *places], ["query", "vector", "known", "cell", "part"])

    return queries.select("query", "vector", "known").mapInArrow(
        run, "query long, vector array<double>, known double, cell int, part int"
    )


def searched(index: Index, rows: DataFrame, visits: DataFrame, k: int, limit: float) -> DataFrame:
    """query, vec_id and score of the k best verified candidates of every visit (query, vector, known, cell, part)."""
    visits = cut_lineage(visits)
    loads = visits.groupBy("cell", "part").agg(F.ceil(F.count(F.lit(1)) / SLOT).cast("int").alias("slots"))
    loads = cut_lineage(loads)
    n_groups = loads.agg(F.sum("slots").alias("n")).first()["n"] or 0
    slot = F.pmod(F.xxhash64("query"), F.col("slots")).cast("int")
    left = rows.join(loads, ["cell", "part"]).select(
        "cell", "part", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"), "cand_id", F.col("vector").alias("found")
    )
    right = visits.join(loads, ["cell", "part"]).select("cell", "part", slot.alias("slot"), "query", "vector", "known")
    projection = index.projection

    def work(held: pa.Table, asked: pa.Table) -> pa.Table:
        numbers, scores, ids = [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)]
        if held.num_rows and asked.num_rows:
            bucket = Bucket(held["cand_id"].to_numpy(), matrix(held["found"], projection.width), projection)
            for begin in range(0, asked.num_rows, TOGETHER):
                some = asked.slice(begin, TOGETHER)
                vectors, known = matrix(some["vector"], projection.width), some["known"].to_numpy()
                score, name, _ = bucket.search(vectors, known, k, limit)
                there = score > -np.inf
                numbers.append(np.repeat(some["query"].to_numpy(), there.sum(axis=1)))
                scores.append(score[there])
                ids.append(name[there])
        columns = [pa.array(np.concatenate(c)) for c in (numbers, ids, scores)]
        return pa.Table.from_arrays(columns, ["query", "vec_id", "score"])

    return cogrouped(left, right, ["cell", "part", "slot"], n_groups, work, FOUND)


def nearest(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "id",
    vector_col: str = "vector",
    k: int = 20,
    sure: float = SURE,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for every row that is_query names."""
    limit = chi_square_quantile(sure, dimensions)
    vector = F.col(vector_col).cast("array<double>")
    kept = rows.filter(F.col(id_col).isNotNull() & sound(F.col(vector_col)))
    kept = kept.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    kept = kept.filter(F.exists("vector", lambda x: x != 0))
    one = cut_lineage(kept.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asked").alias("asked")))

    copies = Window.partitionBy("vector").orderBy("id")
    candidates = one.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).select("id", "vector")
    index, placed = build(cut_lineage(candidates), dimensions)
    if not len(index.cells):
        return one.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    asked = one.filter("asked")
    queries = cut_lineage(asked.groupBy("vector").agg(F.min("id").alias("query")).withColumn("known", F.lit(float("-inf"))))

    def best(found: DataFrame, most: int) -> DataFrame:
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    at_home = cut_lineage(searched(index, placed, routed(index, queries, limit, False), k + 1, limit))
    last = best(at_home, k + 1).filter(F.col("rank") == k + 1).select("query", F.col("score").alias("last"))
    again = queries.join(last, "query", "left").select("query", "vector", F.coalesce("last", "known").alias("known"))
    elsewhere = searched(index, placed, routed(index, again, limit, True), k + 1, limit)
    found = best(at_home.union(elsewhere), k + 1).select("query", "vec_id", "score")

    named = asked.join(queries.select("query", F.col("vector").alias("asked_vector")), F.col("vector") == F.col("asked_vector"))
    named = named.select(F.col("id").alias("query_id"), "query").join(found, "query").filter(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
