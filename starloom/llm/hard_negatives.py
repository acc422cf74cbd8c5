"""Hard negatives by candidate lists that the anchors of a cluster share.

1. Anchors are clustered by direction (spherical k-means, fitted on a bounded sample of at most
   SAMPLE_CELLS components) and every cluster is split into blocks of about BLOCK anchors.
2. Candidates are dealt into shards of bounded size by a hash of their id; each group of blocks meets
   each shard once.
3. In a shard a block sorts the candidates once, by an upper bound of their inner product with any of
   its anchors: with centre c and angle r from c to the block's farthest anchor, a candidate x at
   angle t from c has <u, x> <= |u| |x| cos(max(0, t - r)). Every anchor of the block walks that list
   until the bound of what is left falls below the last score it still needs.
4. The first walk finds the best rows of an anchor's own label, the second those of other labels whose
   score lies in a window below each positive. Partial lists of the shards are merged by a rank.

Scores are integers; they are products of float64 matrices where these are exact, else of Python
integers. What leaves the operator fits in a long or becomes the nearest long.

Rows with a null id, label or vector, or with a component that isn't finite, take no part. Rows that
share an id count as one, the one of the smallest (label, vector). Vectors of different lengths are
filled up with zeros. Ties go to the smaller id. Anchors without a positive, and positives without a
negative, give no row, nor does an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.vector_rows import cogrouped, matrix, sound
from starloom.session import cut_lineage

SHARD_CELLS = 1 << 18  # components of a shard
SLOT_CELLS = 1 << 19  # components of the anchors that meet a shard at once
BLOCK = 128
CHUNK = 1024  # candidates that a block scores at once
SAMPLE_CELLS = 1 << 19
ROUNDS = 8
MOST_CLUSTERS = 256
SEED = 42
#: Relative slack of the bounds, far above the rounding of an angle.
SLACK = 1e-7

LONG = (-(1 << 63), (1 << 63) - 1)


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as longs; values beyond a long become the nearest long."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))


def directions(vectors: np.ndarray) -> np.ndarray:
    floats = vectors.astype(float)
    norms = np.linalg.norm(floats, axis=1, keepdims=True)
    return np.divide(floats, norms, out=np.zeros_like(floats), where=norms > 0)


def centres(sample: np.ndarray, k: int) -> np.ndarray:
    """k directions by spherical k-means; a cluster that runs empty keeps its direction."""
    rows = directions(sample)
    found = rows[np.random.default_rng(SEED).permutation(len(rows))[:k]]
    for _ in range(ROUNDS):
        own = (rows @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, own, rows)
        filled = np.linalg.norm(sums, axis=1) > 0
        found[filled] = directions(sums[filled])
    return found


@dataclass
class Shard:
    """Candidates in order of their ids."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    exact: bool  # whether float64 products and packed ranks are exact

    def __post_init__(self):
        floats = self.vectors.astype(float)
        self.norms = np.linalg.norm(floats, axis=1)
        self.units = directions(floats)
        if self.exact:
            self.vectors = floats
        else:
            self.vectors = np.array(self.vectors.tolist(), object).reshape(self.vectors.shape)

    @property
    def low(self) -> int:
        """Below every packed score."""
        return -(1 << 62) if self.exact else -(1 << 400)

    def listed(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidates in falling order of their bound for anchors of these directions, and the bounds per unit length."""
        centre = units.sum(axis=0)
        length = np.linalg.norm(centre)
        if not length:
            return np.argsort(-self.norms, kind="stable"), -np.sort(-self.norms)
        centre /= length
        cosines = np.clip(units[np.any(units != 0, axis=1)] @ centre, -1, 1)
        spread = np.arccos(cosines).max(initial=0)
        angles = np.arccos(np.clip(self.units @ centre, -1, 1))
        bounds = self.norms * np.cos(np.clip(angles - spread, 0, np.pi))
        order = np.argsort(-bounds, kind="stable")
        return order, bounds[order]

    def products(self, anchors: np.ndarray, places: np.ndarray) -> np.ndarray:
        scores = anchors @ self.vectors[places].T
        return scores.astype(np.int64) if self.exact else scores

    def walk(
        self, anchors: np.ndarray, order: np.ndarray, bounds: np.ndarray, own: np.ndarray | None,
        low: np.ndarray, high: np.ndarray, k: int,
    ) -> tuple[np.ndarray, int]:
        """Packed scores (anchor, window, k) of the best candidates in every window, best first, and the scores computed.

        own has labels of anchors whose candidates must have another one; None takes all in the list.
        A packed score holds the score and the place of the candidate, smaller places first.
        """
        n = len(self.ids)
        best = np.full((*low.shape, k), self.low, np.int64 if self.exact else object)
        lengths = np.linalg.norm(anchors.astype(float), axis=1)
        active, scored = np.arange(len(anchors)), 0
        for begin in range(0, len(order), CHUNK):
            reach = lengths[active] * bounds[begin]
            reach += np.abs(reach) * SLACK + SLACK
            last = best[active, :, -1]
            needed = np.where(last > self.low, last // n, low[active])
            active = active[(reach[:, None] >= needed).any(axis=1)]
            if not len(active):
                break
            places = order[begin : begin + CHUNK]
            scores = self.products(anchors[active], places)
            scored += scores.size
            packed = scores * n + (n - 1 - places)
            if own is not None:
                packed = np.where(self.labels[places] != own[active][:, None], packed, self.low)
            for j in range(low.shape[1]):
                fits = (scores >= low[active, j][:, None]) & (scores <= high[active, j][:, None])
                both = np.concatenate([best[active, j], np.where(fits, packed, self.low)], axis=1)
                if self.exact and both.shape[1] > 4 * k:
                    both = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                best[active, j] = np.sort(both, axis=1)[:, ::-1][:, :k]
        return best, scored


def blocks_of(slot: pa.Table, width: int, exact: bool) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The blocks of a slot and their anchors' vectors."""
    slot = slot.sort_by([("block", "ascending"), ("anchor_id", "ascending")])
    block = slot["block"].to_numpy()
    for begin in np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else ():
        part = slot.slice(begin, int(np.searchsorted(block, block[begin], "right") - begin))
        vectors = matrix(part["vector"], width)
        yield part, vectors.astype(float) if exact else np.array(vectors.tolist(), object).reshape(vectors.shape)


@dataclass(frozen=True)
class Layout:
    """Sizes that are the same for both walks."""

    width: int
    largest: float  # absolute component
    n_shards: int
    n_slots: int

    def shard(self, table: pa.Table) -> Shard:
        table = table.sort_by("cand_id")
        most = self.largest * self.largest * max(1, self.width)
        exact = most * max(1, table.num_rows) < 2.0**61 and most < 2.0**52
        return Shard(table["cand_id"].to_numpy(), table["cand_label"].to_numpy(), matrix(table["vector"], self.width), exact)

    def meet(self, candidates: DataFrame, anchors: DataFrame, work, schema: str) -> DataFrame:
        """work(shard's table, slot's table) for every shard and slot."""
        def every(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        left = candidates.withColumn("slot", every(self.n_slots))
        right = anchors.withColumn("shard", every(self.n_shards))
        return cogrouped(left, right, ["shard", "slot"], self.n_shards * self.n_slots, work, schema)


def best_rows(found: DataFrame, keys: list[str], score: str, tie: str, k: int, rank: str) -> DataFrame:
    """The k first rows per key; tasks cut their own lists to k before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def clipped(values: list) -> pa.Array:
    return pa.array([min(max(int(v), LONG[0]), LONG[1]) for v in values], pa.int64())


def positives_of(layout: Layout, candidates: DataFrame, anchors: DataFrame, n_positives: int) -> DataFrame:
    """anchor_id, positive_id and positive_score of the best rows of an anchor's label, itself left out."""
    names = ["anchor_id", "positive_id", "positive_score"]

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        shard, rows = layout.shard(left), ([], [], [])
        n = len(shard.ids)
        for part, vectors in blocks_of(right, layout.width, shard.exact):
            order, bounds = shard.listed(directions(vectors))
            ids, labels = part["anchor_id"].to_numpy(), part["label"].to_numpy()
            for label in np.unique(labels):
                at = np.flatnonzero(labels == label)
                kept = shard.labels[order] == label
                low = np.full((len(at), 1), shard.low + 1, np.int64 if shard.exact else object)  # any score will do
                high = -low
                best, _ = shard.walk(vectors[at], order[kept], bounds[kept], None, low, high, n_positives + 1)
                for row, window, k in np.argwhere(best > shard.low):
                    packed = best[row, window, k]
                    place = n - 1 - int(packed % n)
                    if shard.ids[place] != ids[at[row]]:
                        rows[0].append(ids[at[row]])
                        rows[1].append(shard.ids[place])
                        rows[2].append(packed // n)
        return pa.Table.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), clipped(rows[2])], names)

    found = layout.meet(candidates, anchors, work, "anchor_id long, positive_id long, positive_score long")
    return best_rows(found, ["anchor_id"], "positive_score", "positive_id", n_positives, "place").drop("place")


def negatives_of(
    layout: Layout, candidates: DataFrame, anchors: DataFrame, n_negatives: int, percent: tuple[int, int]
) -> DataFrame:
    """The first rows of another label in the window of each positive; anchors has positives (id, score)."""
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        shard, rows = layout.shard(left), ([], [], [], [], [])
        n = len(shard.ids)
        for part, vectors in blocks_of(right, layout.width, shard.exact):
            order, bounds = shard.listed(directions(vectors))
            ids, labels, positives = part["anchor_id"].to_numpy(), part["label"].to_numpy(), part["positives"].to_pylist()
            kind = np.int64 if shard.exact else object
            most = max(map(len, positives))
            low = np.full((len(ids), most), 1, kind)  # an empty window where an anchor has fewer positives
            high = np.full((len(ids), most), 0, kind)
            for row, own in enumerate(positives):
                for j, positive in enumerate(own):
                    low[row, j] = -(-percent[0] * positive["score"] // 100)
                    high[row, j] = percent[1] * positive["score"] // 100
            low = np.where(low > high, -(shard.low + 1), low)  # nothing is needed there
            best, _ = shard.walk(vectors, order, bounds, labels, low, high, n_negatives)
            for row, j, k in np.argwhere(best > shard.low):
                packed = best[row, j, k]
                rows[0].append(ids[row])
                rows[1].append(positives[row][j]["id"])
                rows[2].append(shard.ids[n - 1 - int(packed % n)])
                rows[3].append(positives[row][j]["score"])
                rows[4].append(packed // n)
        whole = [pa.array(r, pa.int64()) for r in rows[:3]]
        return pa.Table.from_arrays([*whole, clipped(rows[3]), clipped(rows[4])], names)

    found = layout.meet(candidates, anchors, work, ", ".join(f"{name} long" for name in names))
    return best_rows(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives, "rank")


def in_blocks(anchors: DataFrame, width: int) -> DataFrame:
    """anchors (anchor_id, label, vector) with the number of their block."""
    most = max(2, SAMPLE_CELLS // max(1, width))
    n = anchors.count()
    drawn = anchors.select("vector").orderBy(F.xxhash64("anchor_id"), "anchor_id").limit(most) if n > most else anchors.select("vector")
    sample = matrix(drawn.toArrow()["vector"], width)
    k = max(1, min(MOST_CLUSTERS, len(sample) // 16, -(-n // BLOCK)))
    found = centres(sample, k) if len(sample) else np.zeros((1, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = (directions(matrix(batch.column("vector"), width)) @ found.T).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], [*batch.schema.names, "cluster"])

    named = cut_lineage(anchors.mapInArrow(run, "anchor_id long, label long, vector array<long>, cluster int"))
    sizes = {r["cluster"]: r["count"] for r in named.groupBy("cluster").count().collect()}
    first, parts, begin = [], [], 0
    for cluster in range(len(found)):
        first.append(begin)
        parts.append(max(1, -(-sizes.get(cluster, 0) // BLOCK)))
        begin += parts[-1]
    at = F.col("cluster") + 1
    split = F.pmod(F.xxhash64("anchor_id"), F.element_at(F.array(*map(F.lit, parts)), at))
    return named.withColumn("block", F.element_at(F.array(*map(F.lit, first)), at).cast("long") + split).drop("cluster")


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "id",
    label_col: str = "label",
    vector_col: str = "vector",
    n_positives: int = 5,
    n_negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows has whole ids, labels and components; is_anchor speaks of its columns. The negatives of a
    positive of score s are the first rows of another label with percent[0] * s <= 100 * score <=
    percent[1] * s.
    """
    kept = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & sound(F.col(vector_col)))
    kept = kept.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<long>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    one = kept.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"), F.max("anchor").alias("anchor"))
    one = cut_lineage(one.select("id", "row.label", "row.vector", "anchor"))
    sizes = one.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"),
        F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))).alias("largest"),
        F.count_if("anchor").alias("anchors"),
    ).first()
    width = max(1, sizes["width"] or 0)
    n_shards = max(1, -(-sizes["n"] * width // SHARD_CELLS))
    blocked = cut_lineage(
        in_blocks(one.filter("anchor").select(F.col("id").alias("anchor_id"), "label", "vector"), width)
    )
    per_slot = max(1, SLOT_CELLS // width // BLOCK)
    n_slots = 1 + (blocked.agg(F.max("block")).first()[0] or 0) // per_slot
    anchors = blocked.withColumn("slot", F.floor(F.col("block") / per_slot).cast("int"))
    candidates = one.select(
        F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int").alias("shard"),
        F.col("id").alias("cand_id"), F.col("label").alias("cand_label"), "vector",
    )
    layout = Layout(width, sizes["largest"] or 0.0, n_shards, n_slots)
    positives = cut_lineage(positives_of(layout, candidates, anchors, n_positives))
    listed = positives.groupBy(F.col("anchor_id").alias("of_anchor")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("positive_score").alias("score"), F.col("positive_id").alias("id")))).alias("positives")
    )
    wanted = anchors.join(listed, F.col("anchor_id") == F.col("of_anchor")).drop("of_anchor")
    found = negatives_of(layout, candidates, wanted, n_negatives, percent)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
