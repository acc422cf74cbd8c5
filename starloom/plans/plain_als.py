"""ALS with a plain ridge term: every entity solves (sum v v^T + reg I) x = sum r v.

Each half step is one join, partial sums of the normal equations per task, one shuffle of those sums
and a batched solve of the small k x k systems.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import hex_window
from ..functions.vectors import dot
from ..operators.cleaning import dedupe_last, observed_only
from ..operators.skew import hot_keys, skew_join
from ..schemas import Columns
from ..session import cut_lineage
from .model import FactorModel
from .rating_blocks import Equations, RatingBlocks, Weighting, lay_out

INIT_SCALE = 0.1
HELD_SUMS = 8_000_000  # doubles per task


def initial_factors(
    ids: DataFrame, rank: int, seed: int, side: str, scale: float = INIT_SCALE
) -> DataFrame:
    """(id, features) with normal(0, ``scale``) entries from a hash of (seed, side, id, position).

    Box-Muller over two 32-bit parts of an md5, so an id has the same vector in any partitioning.
    """

    def entry(position: int) -> Column:
        text = F.md5(F.concat_ws(":", F.lit(f"{seed}:{side}"), F.col("id"), F.lit(str(position))))
        u1 = (hex_window(text, 1, 8) + 1) / F.lit(4294967296.0)
        u2 = hex_window(text, 9, 8) / F.lit(4294967296.0)
        return F.lit(scale) * F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0) * F.pi() * u2)

    return ids.select("id", F.array(*[entry(i) for i in range(rank)]).alias("features"))


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _equation_steps(rank: int, reg: float, scaled: bool) -> tuple[Step, Step]:
    """The two per-partition steps of a half step, over Arrow batches.

    ``add_up`` turns rows (id, rating, features) into partial sums per id: the upper triangle of
    sum v v^T, then sum r v, then the count. ``solve`` merges partial sums that arrive ordered by id
    and solves the small systems. Both hold a bounded number of sums.
    """
    rows, columns = np.triu_indices(rank)
    upper = len(rows)
    width = upper + rank + 1
    diagonal = np.arange(rank)
    held_limit = max(1, HELD_SUMS // width)

    def merge(ids: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        every, values = np.concatenate(ids), np.concatenate(sums)
        order = np.argsort(every, kind="stable")
        every = every[order]
        starts = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        return every[starts], np.add.reduceat(values[order], starts, axis=0)

    def listed(ids: np.ndarray, values: np.ndarray, name: str) -> pa.RecordBatch:
        ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(ids), lists], ["id", name])

    def unlisted(batch: pa.RecordBatch, name: str) -> np.ndarray:
        flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(batch.num_rows, -1)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sums, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            v = unlisted(batch, "features").astype(float, copy=False)
            cells = np.empty((len(v), width))
            cells[:, :upper] = v[:, rows] * v[:, columns]
            cells[:, upper:-1] = v * batch.column("rating").to_numpy()[:, None]
            cells[:, -1] = 1.0
            some_ids, some = merge([batch.column("id").to_numpy()], [cells])
            ids.append(some_ids)
            sums.append(some)
            held += len(some_ids)
            if held > held_limit:
                merged, values = merge(ids, sums)
                ids, sums, held = [merged], [values], len(merged)
                if held > held_limit // 2:
                    yield listed(merged, values, "sums")
                    ids, sums, held = [], [], 0
        if held:
            yield listed(*merge(ids, sums), "sums")

    def solved(ids: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        a = np.empty((len(ids), rank, rank))
        a[:, rows, columns] = a[:, columns, rows] = sums[:, :upper]
        a[:, diagonal, diagonal] += reg * sums[:, -1:] if scaled else reg
        return listed(ids, np.linalg.solve(a, sums[:, upper:-1, None])[:, :, 0], "features")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sums = [], []  # the last id so far: its sums may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            some_ids, some = merge(
                [*ids, batch.column("id").to_numpy()], [*sums, unlisted(batch, "sums")]
            )
            if len(some_ids) > 1:
                yield solved(some_ids[:-1], some[:-1])
            ids, sums = [some_ids[-1:]], [some[-1:]]
        if ids:
            yield solved(ids[0], sums[0])

    return add_up, solve


def solve_rated(
    rated: DataFrame,
    entity: str,
    rating: str,
    rank: int,
    reg: float,
    scaled: bool = False,
    *,
    gather: list | None = None,
) -> DataFrame:
    """(id, features) for every entity from rows (entity, rating, features of the other side).

    Sums are formed per task and only they are merged per entity. That is cheap if a task holds the
    rows of an entity together, or few entities. Otherwise a rating would send k(k+1)/2 sums instead
    of k factors; then ``gather`` brings the rows of an entity together first, and its sums are solved
    where they are formed. It lists the hot entities: few, so their rows stay where they are and only
    sums move. Features in single precision move as such; sums are double.

    ``stats.gram`` writes the same sums as SQL aggregates: 66 columns at rank 10, 861 at rank 40.
    Over Arrow batches the cost per rating stays the cost of one outer product.
    """
    add_up, solve = _equation_steps(rank, reg, scaled)
    id_type = rated.schema[entity].dataType.simpleString()
    rows = rated.select(F.col(entity).alias("id"), F.col(rating).alias("rating"), "features")
    solution = f"id {id_type}, features array<double>"

    def merged(some: DataFrame) -> DataFrame:
        partial = some.mapInArrow(add_up, f"id {id_type}, sums array<double>")
        return partial.repartition("id").sortWithinPartitions("id").mapInArrow(solve, solution)

    if gather is None:
        return merged(rows)
    hot = F.col("id").isin(gather) if gather else F.lit(False)
    cold = rows.where(~hot).repartition("id").sortWithinPartitions("id")
    cold = cold.mapInArrow(lambda batches: solve(add_up(batches)), solution)
    return cold.unionByName(merged(rows.where(hot))) if gather else cold


def als_half_step(
    ratings: DataFrame,
    factors: DataFrame,
    rank: int,
    reg: float = 0.1,
    scaled: bool = False,
    solve_for: str = "user",
    cols: Columns = Columns(),
) -> DataFrame:
    """Solve all users with the item ``factors`` fixed, or all items with the user factors fixed.

    The features of ``factors`` are array<double>, or array<float>, which halves what a rating moves.
    """
    if solve_for not in ("user", "item"):
        raise ValueError("solve_for must be 'user' or 'item'")
    entity, other = (
        (cols.user, cols.item) if solve_for == "user" else (cols.item, cols.user)
    )
    if reg <= 0:
        raise ValueError("reg must be above zero; without it an entity with few ratings has no unique solution")
    ratings = ratings.select(entity, other, cols.rating).dropna()
    rated = skew_join(
        ratings, factors.withColumnRenamed("id", other), other
    )
    hot = hot_keys(ratings, entity)[entity]
    return solve_rated(rated, entity, cols.rating, rank, reg, scaled, gather=hot)


@dataclass(frozen=True)
class PlainAlsRun:
    model: FactorModel
    history: DataFrame  # (iteration, rmse) on the training ratings


def train_plain_als(
    ratings: DataFrame,
    rank: int = 10,
    max_iter: int = 10,
    reg: float = 0.1,
    scaled: bool = False,
    seed: int = 42,
    cols: Columns = Columns(),
    track_rmse: bool = True,
    implicit: bool = False,
    alpha: float = 1.0,
) -> PlainAlsRun:
    """Alternate user and item half steps; per iteration users come first.

    A repeated pair counts once (its last rating), and an entity without an observed rating keeps its
    initial vector. Explicit: a rating at or below 0 is not observed. Implicit: every pair of a user
    and an item counts; a rating r gives the preference [r > 0] with confidence 1 + alpha |r|, all
    other pairs the preference 0 with confidence 1. Their sum is one k x k matrix per half step, to
    which the ratings add, so the pairs are never built.

    Ratings are laid out once per side (see ``rating_blocks``). The error after an iteration comes
    from the sums of its item step, without another pass: explicit, the RMSE of the nonzero ratings;
    implicit, the weighted RMSE of the preferences over all pairs of a user and a rated item. Factor tables are checkpointed
    after every half step, so lineage stays one step deep.
    """
    if reg <= 0:
        raise ValueError("reg must be above zero; without it an entity with few ratings has no unique solution")
    weighting = Weighting(implicit, alpha)
    last = dedupe_last(ratings, cols).where(F.col(cols.rating) != 0)
    last = last.select(cols.user, cols.item, cols.rating).persist(StorageLevel.MEMORY_AND_DISK)

    def start(column: str, side: str) -> DataFrame:
        ids = ratings.select(F.col(column).alias("id")).where("id IS NOT NULL").distinct()
        return cut_lineage(initial_factors(ids, rank, seed, side))

    laid: list[RatingBlocks] = []
    try:
        first = {"user": start(cols.user, "user"), "item": start(cols.item, "item")}
        counts = {side: table.count() for side, table in first.items()}
        row_bytes = 8 * rank + 64
        sizes = {side: n * row_bytes for side, n in counts.items()}
        observed = last if implicit else observed_only(last, cols)
        found = last.agg(
            F.count("*").alias("n"), F.count_if(F.col(cols.rating) > 0).alias("observed"),
            F.sum(F.abs(cols.rating)).alias("weight"),
        ).first()
        n_laid = found["n"] if implicit else found["observed"]
        for entity, other in ((cols.user, cols.item), (cols.item, cols.user)):
            laid.append(lay_out(observed, entity, other, n_laid, cols))
        rated = {side: b.rows.select("entity").distinct().count() for side, b in zip(("user", "item"), laid)}
        negative = last.where(F.col(cols.rating) < 0) if not implicit and found["n"] > found["observed"] else None
        total = counts["user"] * rated["item"] + alpha * (found["weight"] or 0.0) if implicit else found["n"]

        def solve(blocks: RatingBlocks, side: str, fixed: DataFrame, fixed_side: str) -> DataFrame:
            shared = gram_of(fixed, rank) if implicit else np.zeros((rank, rank))
            equations = Equations(rank, reg, scaled, weighting, shared)
            solved = blocks.half_step(fixed, sizes[fixed_side], equations)
            if rated[side] < counts[side]:
                solved = first[side].join(solved.withColumnRenamed("features", "_solved"), "id", "left").select(
                    "id", F.coalesce("_solved", "features").alias("features"), "error"
                )
            return cut_lineage(solved)

        def squares(users: DataFrame, items: DataFrame) -> float:
            """Sum of squared errors; negative ratings, which no equation holds, are scored one by one."""
            inside = items.agg(F.sum("error").alias("s")).first()["s"] or 0.0
            if negative is None:
                return inside
            rows = skew_join(negative, users.select(F.col("id").alias(cols.user), F.col("features").alias("_u")), cols.user, dim_bytes=sizes["user"])
            rows = skew_join(rows, items.select(F.col("id").alias(cols.item), F.col("features").alias("_v")), cols.item, dim_bytes=sizes["item"])
            error = dot(F.col("_u"), F.col("_v"), rank) - F.col(cols.rating)
            return inside + (rows.agg(F.sum(error * error).alias("s")).first()["s"] or 0.0)

        users, items, history = first["user"], first["item"], []
        for iteration in range(1, max_iter + 1):
            users = solve(laid[0], "user", items, "item")
            items = solve(laid[1], "item", users, "user")
            if track_rmse and total:
                # Rounding may leave a sum of almost zero below it.
                history.append((iteration, math.sqrt(max(squares(users, items), 0.0) / total)))
            elif track_rmse:
                history.append((iteration, None))
    finally:
        for blocks in laid:
            blocks.unpersist()
        last.unpersist()
    table = ratings.sparkSession.createDataFrame(history, "iteration INT, rmse DOUBLE")
    users, items = users.select("id", "features"), items.select("id", "features")
    return PlainAlsRun(FactorModel(users, items, rank, cols, counts["user"], counts["item"]), table)


def gram_of(factors: DataFrame, rank: int) -> np.ndarray:
    """Sum of v v^T over all factors: k (k + 1) / 2 numbers, whatever the number of factors."""
    pairs = list(zip(*np.triu_indices(rank)))
    f = F.col("features")
    sums = factors.agg(*(F.sum(f[int(i)] * f[int(j)]).alias(f"g{i}_{j}") for i, j in pairs)).first()
    out = np.zeros((rank, rank))
    for (i, j), value in zip(pairs, sums):
        out[i, j] = out[j, i] = value or 0.0
    return out
