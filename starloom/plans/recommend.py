"""Top-n matching between two factor tables, and the recommendations built on it.

The exact best n of many targets for every query vector needs every score, but not every pair as a
row. Queries are hashed into blocks and targets into shards of bounded size. A task receives one
block and one shard, multiplies the two matrices and returns at most the n best (plus ties) per
query. Only those rows leave the task, which holds one block, one shard, its result and a bounded
number of candidates, however many targets tie.

Products are pruned by bounds: a score is at most the product of both vectors' lengths, and at most the
score of a bucket's mean plus the query's length times the bucket's radius. A task cuts its targets by
length, then into buckets that lie close together, and a query meets a bucket only if its bound there reaches
its n-th best score. Products that fit a core's cache, in single precision, choose
within a bound on their rounding the few pairs that are scored exactly. Several shards are ranges of
length. The longest targets come first, and a query is then sent only to the ranges that can
still change its n best.

With ties by rank the number of rows has no bound but users times items. The n-th best scores come first,
by a search with ties by row; the search that they limit gives final rows, which leave a task as they
are found and are neither stored nor compared again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.vectors import as_double_vector
from ..operators.ranking import top_n_per_user
from ..operators.skew import BROADCAST_BYTES
from ..schemas import Columns
from ..session import cut_lineage
from .model import FactorModel, require_model

BLOCK_ROWS = 8192
SHARD_ROWS = 65536
#: Bytes of rows in a block or shard of a model's tables. Larger tiles mean fewer copies of either
#: table in the shuffle; a task multiplies them in pieces of SCORES_AT_ONCE.
TILE_BYTES = 32 * 1024 * 1024
#: What a row of a tile takes in a task besides its vector: ids, keys, lengths, offsets and places.
ROW_BYTES = 96
PAIRS_PER_TASK = 4_000_000
SCORES_AT_ONCE = 1 << 20  # stay in a core's cache in single precision
BOUND_SLACK = 1e-9  # relative, far above the rounding of lengths and scores
BUCKET_ROWS = 2048  # targets that share a bound
STRATUM = 8  # at most so many buckets of targets of about one length are formed by place
#: Candidates of the queries at hand before all but their best go; rows of a batch that leaves a task.
HELD_CANDIDATES = 1_000_000
ROWS_OUT = 100_000
#: Kinds of rows in a group.
QUERY, LEFT_OUT, TARGET = 0, 1, 2


def _close_together(points: np.ndarray, width: int) -> np.ndarray:
    """An order of the rows in which every ``width`` lie close together: halves of halves along their widest axis."""
    order, parts = np.arange(len(points)), [(0, len(points))]
    while parts:
        lo, hi = parts.pop()
        middle = lo + -(-(hi - lo) // width) // 2 * width
        if middle > lo:
            some = points[order[lo:hi]]
            axis = np.argmax(some.max(axis=0) - some.min(axis=0))
            order[lo:hi] = order[lo:hi][np.argpartition(some[:, axis], middle - lo)]
            parts += [(lo, middle), (middle, hi)]
    return order


def _block_matcher(
    n: int, keep_ties: bool, unit_length: bool, count: bool = False
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The per-task step: best ``n`` targets of a shard for every query of a block.

    Rows are queries, lists of excluded targets and targets, told apart by ``side``. The matrix
    product only selects candidates. Its rounding depends on the block shape, so candidates are
    taken within a bound on that rounding, and their final scores are summed in index order. The
    result is the same for any block and shard size. Queries go a few at a time, neighbours by direction,
    and their candidates are cut to the best before the next ones start. With ``count`` the step gives the number of products, possible
    and computed, instead.
    """

    def matrix(column: pa.Array) -> np.ndarray:
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)

    def vectors(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in ascending order, their vectors, of length one for cosine scores, and their floors."""
        ids, rows, floors = (np.concatenate(column) for column in zip(*parts))
        parts.clear()
        if unit_length:
            length = np.sqrt((rows * rows).sum(axis=1))
            ids, rows, floors = ids[length > 0], rows[length > 0] / length[length > 0, None], floors[length > 0]
        order = np.argsort(ids)
        return ids[order], rows[order], floors[order]

    def positions(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each wanted id in the sorted ``ids``, and whether it is there."""
        at = np.searchsorted(ids, wanted)
        at = np.minimum(at, len(ids) - 1)
        return at, ids[at] == wanted

    def pairs(excluded: list[pa.RecordBatch], u_ids: np.ndarray, v_ids: np.ndarray, u_place: np.ndarray, v_place: np.ndarray):
        """(place of a query, place of a target) of the excluded pairs, by the first; ids ascend."""
        rows, cols = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        while excluded:
            batch = excluded.pop()
            lists = batch.column("excluded")
            owners = np.repeat(batch.column("left_id").to_numpy(zero_copy_only=False), pc.list_value_length(lists))
            row, row_known = positions(u_ids, owners)
            col, col_known = positions(v_ids, lists.flatten().to_numpy(zero_copy_only=False))
            known = row_known & col_known
            rows.append(u_place[row[known]].astype(np.int32))
            cols.append(v_place[col[known]].astype(np.int32))
        row, col = np.concatenate(rows), np.concatenate(cols)
        order = np.argsort(row, kind="stable")
        return row[order], col[order]

    def best_of(r: np.ndarray, c: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best of (place in u, place in v, score), by query, best first; ties by place in v."""
        order = np.lexsort((c, -exact, r))
        r, c, exact = r[order], c[order], exact[order]
        first = np.searchsorted(r, r)  # start of each query's candidates
        if keep_ties:
            last = np.minimum(first + n, np.searchsorted(r, r, side="right")) - 1
            best = exact >= exact[last]
        else:
            best = np.arange(len(r)) - first < n
        return r[best], c[best], exact[best]

    def reaching(nth: np.ndarray, lo: int, *found: tuple[np.ndarray, ...]) -> list[np.ndarray]:
        """Of candidates (place in u, place in v, score) those that reach their query's n-th best score."""
        r, c, exact = (np.concatenate(column) for column in zip(*found))
        kept = exact >= nth[r - lo]
        return [r[kept], c[kept], exact[kept]]

    def by_bounds(u: np.ndarray, v: np.ndarray, order: np.ndarray, row: np.ndarray, col: np.ndarray, floor: np.ndarray):
        """(place in u, place in ids, score) of some queries at a time, and the products formed.

        v has targets of a bucket together, order their places in the ids. (row, col) are pairs to leave
        out, by row; ``floor`` is a score below which a query wants none.
        """
        rank = u.shape[1]
        u_length, v_length = np.linalg.norm(u, axis=1), np.linalg.norm(v, axis=1)
        reach = 4 * (rank + 2) * np.finfo(float).eps * u_length * v_length.max()
        most = min(n, len(v))
        width = min(BUCKET_ROWS, len(v))
        buckets = range(0, len(v), width)
        step = max(1, SCORES_AT_ONCE // width)
        longest, means = np.maximum.reduceat(v_length, buckets), np.add.reduceat(v, buckets)
        means /= np.diff([*buckets, len(v)])[:, None]
        apart = v - np.repeat(means, np.diff([*buckets, len(v)]), axis=0)
        unit = np.abs(apart).max() or 1.0  # squares neither overflow nor vanish
        radius = unit * np.sqrt(np.maximum.reduceat(np.square(apart / unit).sum(axis=1), buckets)) * (1 + BOUND_SLACK)
        del apart
        u_scale, v_scale, kind, blur = np.ones(len(u)), np.ones(len(buckets)), float, 0.0
        if np.isfinite(u).all() and np.isfinite(v).all():  # in single precision, entries within one
            u_scale = np.abs(u).max(axis=1)
            v_scale = np.maximum.reduceat(np.abs(v).max(axis=1), buckets)
            u_scale[u_scale == 0], v_scale[v_scale == 0] = 1.0, 1.0
            kind, blur = np.float32, 4 * (rank + 2) * rank * np.finfo(np.float32).eps
        shapes = [np.ascontiguousarray((v[b : b + width] / scale).T, kind) for b, scale in zip(buckets, v_scale)]
        room, least = np.empty(step * width, kind), np.finfo(kind).min
        parts = [(lo, min(lo + step, len(u))) for lo in range(0, len(u), step)][::-1]
        while parts:
            lo, hi = parts.pop()
            products, held = 0, (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
            slack = 2 * reach[lo:hi]
            best, nth = np.full((hi - lo, most), -np.inf), floor[lo:hi].copy()
            a, b = np.searchsorted(row, [lo, hi])
            by_bucket = np.argsort(col[a:b] // width, kind="stable")
            out_row, out_col = row[a:b][by_bucket] - lo, col[a:b][by_bucket]
            out_edges = np.searchsorted(out_col // width, np.arange(len(buckets) + 1))
            shape = (u[lo:hi] / u_scale[lo:hi, None]).astype(kind)
            found, waiting, whole = [], 0, True
            most_long = np.outer(longest, u_length[lo:hi])
            bound = np.minimum(most_long, means @ u[lo:hi].T + np.outer(radius, u_length[lo:hi])) + slack
            promise = (bound / np.where(u_length[lo:hi] > 0, u_length[lo:hi], 1.0)).max(axis=1)
            for k in np.argsort(-promise, kind="stable").tolist():
                active = np.flatnonzero(~(bound[k] < nth))
                if not len(active):
                    continue
                begin, part = buckets[k], shapes[k]
                scores = room[: len(active) * part.shape[1]].reshape(len(active), -1)
                np.matmul(shape[active], part, out=scores)
                products += scores.size
                c, d = out_edges[k], out_edges[k + 1]
                slot = np.full(hi - lo, -1)
                slot[active] = np.arange(len(active))
                left_out = slot[out_row[c:d]]
                scores[left_out[left_out >= 0], out_col[c:d][left_out >= 0] - begin] = -np.inf
                unsure = slack[active] / u_scale[lo + active] / v_scale[k] + blur
                wanted = nth[active] / u_scale[lo + active] / v_scale[k] - unsure
                wanted = np.clip(np.nan_to_num(wanted, nan=least), least, -least).astype(kind)
                better = np.flatnonzero(np.fmax.reduce(scores, axis=1) >= wanted)
                some, wanted, unsure, better = scores[better], wanted[better], unsure[better], active[better]
                if some.shape[1] > n:  # the n-th best of this bucket alone bounds what it can add
                    own = np.flatnonzero(np.count_nonzero(some >= wanted[:, None], axis=1) > 4 * n)
                    each = max(1, some.shape[1] // (8 * n))  # the best of so many: n of them are n targets
                    groups = some.shape[1] // each
                    heads = np.fmax.reduce(some[own, : each * groups].reshape(len(own), each, groups), axis=1)
                    heads[np.isnan(heads)] = -np.inf
                    last = np.partition(heads, -n, axis=1)[:, -n]
                    wanted[own] = np.fmax(wanted[own], last - 2 * unsure[own])
                r, c = np.divmod(np.flatnonzero(some >= wanted[:, None]), some.shape[1])
                if not len(r):
                    continue
                starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                each, rows = np.diff(np.r_[starts, len(r)]), better[r[starts]]
                r, c = lo + better[r], begin + c
                exact = np.zeros(len(r))
                for entry in range(rank):
                    exact += u[r, entry] * v[c, entry]
                if most == n:
                    merged = np.full((len(rows), int(each.max()) + n), -np.inf)
                    merged[:, -n:] = best[rows]
                    merged[np.repeat(np.arange(len(rows)), each), np.arange(len(r)) - np.repeat(starts, each)] = exact
                    best[rows] = np.partition(merged, -n, axis=1)[:, -n:]
                    nth[rows] = np.fmax(nth[rows], best[rows].min(axis=1))
                    near = exact >= (nth - slack)[r - lo]
                    r, c, exact = r[near], c[near], exact[near]
                found.append((r, order[c], exact))
                waiting += len(r)
                if waiting > HELD_CANDIDATES:
                    held, found, waiting = best_of(*reaching(nth, lo, held, *found)), [], 0
                    if len(held[0]) > HELD_CANDIDATES and hi - lo > 1:
                        whole = False
                        break
            if whole:  # all that tie with the n-th best, or the first of them
                best_found = reaching(nth, lo, held, *found)
                yield *(best_found if keep_ties else best_of(*best_found)), products
            else:  # too many ties for so many queries
                middle = (lo + hi) // 2
                parts += [(middle, hi), (lo, middle)]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, targets, excluded = [], [], []
        for batch in batches:
            side = batch.column("side")
            part = batch.filter(pc.and_(pc.equal(side, QUERY), pc.is_valid(batch.column("features"))))
            if part.num_rows:
                ids, floor = (part.column(c).to_numpy(zero_copy_only=False) for c in ("left_id", "floor"))
                queries.append((ids, matrix(part.column("features")), floor))
            part = batch.filter(pc.equal(side, TARGET))
            if part.num_rows:
                ids = part.column("right_id").to_numpy(zero_copy_only=False)
                targets.append((ids, matrix(part.column("features")), np.zeros(len(ids))))
            part = batch.filter(pc.equal(side, LEFT_OUT))
            if part.num_rows:
                excluded.append(part.select(["left_id", "excluded"]))
        u_ids, u, floor = vectors(queries) if queries else ([], None, None)
        v_ids, v, _ = vectors(targets) if targets else ([], None, None)
        if not len(u_ids) or not len(v_ids):
            if count:
                yield pa.RecordBatch.from_pydict({"possible": [0], "computed": [0]})
            return
        with np.errstate(all="ignore"):
            length = np.linalg.norm(u, axis=1)
            turn = _close_together(u / np.where(length > 0, length, 1.0)[:, None], max(1, SCORES_AT_ONCE // BUCKET_ROWS))
            order = np.argsort(-np.linalg.norm(v, axis=1), kind="stable")
            begin = 0
            while begin < len(v):  # strata grow: a few of the longest targets settle most queries
                end = begin + min(max(begin, BUCKET_ROWS), STRATUM * BUCKET_ROWS)
                order[begin:end] = order[begin:end][_close_together(v[order[begin:end]], BUCKET_ROWS)]
                begin = end
        places = [np.empty(len(at), np.int64) for at in (turn, order)]
        for place, at in zip(places, (turn, order)):
            place[at] = np.arange(len(at))
        row, col = pairs(excluded, u_ids, v_ids, *places)
        total, u_ids, u, floor, v = 0, u_ids[turn], u[turn], floor[turn], v[order]
        for r, c, exact, products in by_bounds(u, v, order, row, col, floor):
            total += products
            for begin in range(0, 0 if count else len(r), ROWS_OUT):
                some = slice(begin, begin + ROWS_OUT)
                yield pa.RecordBatch.from_pydict({"left_id": u_ids[r[some]], "right_id": v_ids[c[some]], "score": exact[some]})
        if count:
            yield pa.RecordBatch.from_pydict({"possible": [len(u) * len(v)], "computed": [total]})

    return match


def tile_rows(rank: int) -> int:
    return max(1024, TILE_BYTES // (8 * rank + ROW_BYTES))


def top_matches(
    queries: DataFrame,
    targets: DataFrame,
    n: int,
    *,
    exclude: DataFrame | None = None,
    ties: str = "row",
    cosine: bool = False,
    block_rows: int = BLOCK_ROWS,
    shard_rows: int = SHARD_ROWS,
    query_count: int | None = None,
    target_count: int | None = None,
    exclude_count: int | None = None,
) -> DataFrame:
    """(left_id, right_id, score): the ``n`` best targets by dot product for every query.

    With ``cosine`` the score is the cosine similarity, and zero vectors match nothing.

    ``queries`` and ``targets`` are (id, features); ``exclude`` holds (left_id, right_id) pairs that
    must not be returned. ``ties`` is "row" (at most n, lower target ids first) or "rank" (all
    targets tied with the n-th). The counts only size the blocks; they are computed when not given
    and may be upper bounds.
    """
    if ties not in ("row", "rank"):
        raise ValueError("ties must be 'row' or 'rank'")
    n_queries = max(1, queries.count() if query_count is None else query_count)
    n_targets = max(1, targets.count() if target_count is None else target_count)
    n_pairs = 0
    if exclude is not None:
        n_pairs = exclude.count() if exclude_count is None else exclude_count
    tiles = _Tiles(n, ties, cosine, block_rows, shard_rows, exclude, n_pairs)
    queries = queries.select("id", as_double_vector(F.col("features")).alias("features"), F.lit(-math.inf).alias("floor"))
    targets = targets.select("id", as_double_vector(F.col("features")).alias("features"))
    if n_targets <= shard_rows:
        return tiles.best(*_one_range(queries, targets), [n_queries], [n_targets])
    cuts = [] if cosine else _cuts(targets, n_targets, shard_rows)  # cosine: all lengths are one
    if ties == "row":
        return _best_rows(tiles, queries, targets, n_queries, n_targets, cuts)
    rows = _best_rows(replace(tiles, ties="row"), queries, targets, n_queries, n_targets, cuts)
    limited = _limited(queries, rows, n, cuts).withColumn("ranges", F.col("ranges") + 1)
    limited, targets = cut_lineage(limited), targets.withColumn("range", _below(_length("features"), cuts))
    return tiles.best(limited, targets, _met(limited, len(cuts) + 1), _sizes(targets, len(cuts) + 1))


def _best_rows(
    tiles: _Tiles, queries: DataFrame, targets: DataFrame, n_queries: int, n_targets: int, cuts: Sequence[float]
) -> DataFrame:
    """(left_id, right_id, score): at most n of every query, from ranges of targets that ``cuts`` separate."""
    n, named = tiles.n, Columns("left_id", "right_id", prediction="score")
    if not cuts:
        found = tiles.best(*_one_range(queries, targets), [n_queries], [n_targets])
        return top_n_per_user(found, n, "row", named)
    long = targets.where(_length("features") >= F.lit(cuts[0]))
    n_long = max(1, long.count())
    first = replace(tiles, exclude=_pairs_of(tiles.exclude, long, n_long))
    first = first.best(*_one_range(queries, long), [n_queries], [n_long])
    first = cut_lineage(top_n_per_user(first, n, "row", named).select("left_id", "right_id", "score"))
    open_ = cut_lineage(_limited(queries, first, n, cuts).where("ranges > 0"))
    rest = targets.where(_length("features") < F.lit(cuts[0]))
    rest = rest.withColumn("range", _below(_length("features"), cuts[1:]))
    more = tiles.best(open_, rest, _met(open_, len(cuts)), _sizes(rest, len(cuts)))
    return top_n_per_user(first.unionByName(more), n, "row", named)


def _one_range(queries: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    return queries.withColumn("ranges", F.lit(1)), targets.withColumn("range", F.lit(0))


def _cuts(targets: DataFrame, n_targets: int, rows: int) -> list[float]:
    """Falling lengths that cut the targets into ranges of about so many rows; equal lengths stay together."""
    shares = [1 - i * rows / n_targets for i in range(1, math.ceil(n_targets / rows))]
    found = targets.agg(F.approx_percentile(_length("features"), shares)).first()[0] or []
    return sorted({c for c in found if not math.isnan(c)}, reverse=True) or [math.inf]


def _counted(cuts: Sequence[float], holds: Callable[[Column], Column]) -> Column:
    """How many of the falling cuts something holds for: the first ones."""

    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        return F.when(holds(F.lit(cuts[middle])), among(middle + 1, hi)).otherwise(among(lo, middle))

    return among(0, len(cuts))


def _below(length: Column, cuts: Sequence[float]) -> Column:
    return _counted(cuts, lambda cut: length < cut)


def _limited(queries: DataFrame, found: DataFrame, n: int, cuts: Sequence[float]) -> DataFrame:
    """Queries (id, features, floor, ranges): their n-th best score found, and the ranges below a cut that reach it."""
    settled = found.groupBy("left_id").agg(F.count("*").alias("_n"), F.min("score").alias("_nth"))
    settled = settled.where(F.col("_n") >= n).select(F.col("left_id").alias("id"), "_nth")
    reach = _length("features") * F.lit(1 + BOUND_SLACK)
    ranges = _counted(cuts, lambda cut: F.col("_nth").isNull() | (reach * cut >= F.col("_nth")))
    limited = queries.join(settled, "id", "left")
    return limited.select("id", "features", F.coalesce("_nth", "floor").alias("floor"), ranges.alias("ranges"))


def _met(queries: DataFrame, n_ranges: int) -> list[int]:
    """Per range, the queries that meet it."""
    found = {r["ranges"]: r["count"] for r in queries.groupBy("ranges").count().collect()}
    return [sum(found.get(k, 0) for k in range(i + 1, n_ranges + 1)) for i in range(n_ranges)]


def _sizes(targets: DataFrame, n_ranges: int) -> list[int]:
    found = {r["range"]: r["count"] for r in targets.groupBy("range").count().collect()}
    return [found.get(i, 0) for i in range(n_ranges)]


def matching_work(queries: DataFrame, targets: DataFrame, n: int, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row (possible, computed): products of a search in one shard, and those that pruning leaves."""
    n_queries, n_targets = max(1, queries.count()), max(1, targets.count())
    tiles = _Tiles(n, "row", False, block_rows, n_targets, None, 0)
    queries = queries.select("id", as_double_vector(F.col("features")).alias("features"), F.lit(-math.inf).alias("floor"))
    targets = targets.select("id", as_double_vector(F.col("features")).alias("features"))
    work = tiles.best(*_one_range(queries, targets), [n_queries], [n_targets], True)
    return work.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("possible", "computed")))


def _pairs_of(exclude: DataFrame | None, targets: DataFrame, n_targets: int) -> DataFrame | None:
    """The excluded pairs of some targets."""
    if exclude is None:
        return None
    kind = targets.schema["id"].dataType
    ids = targets.select(F.col("id").alias("right_id"))
    ids = F.broadcast(ids) if 8 * n_targets <= BROADCAST_BYTES else ids
    return exclude.select("left_id", F.col("right_id").cast(kind).alias("right_id")).join(ids, "right_id", "left_semi")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (left_id, shard, list of different right_id) from sorted rows, a list for each id and shard."""

    def lists(rows: list[np.ndarray], starts: np.ndarray, edges: np.ndarray) -> pa.RecordBatch:
        left, right, shard = rows
        values = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(right[: edges[-1]]))
        return pa.RecordBatch.from_arrays([pa.array(left[starts]), pa.array(shard[starts]), values], ["left_id", "shard", "excluded"])

    last = None  # the different pairs of the last id and shard, which the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy() for c in ("left_id", "right_id", "shard")]
        if last is not None:
            rows = [np.concatenate(both) for both in zip(last, rows)]
        left, right, _ = rows
        rows = [column[np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])]] for column in rows]
        left, _, shard = rows
        starts = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (shard[1:] != shard[:-1])])
        if len(starts) > 1:
            yield lists(rows, starts[:-1], starts)
        last = [column[starts[-1] :] for column in rows]
    if last is not None:
        yield lists(last, np.array([0]), np.array([0, len(last[0])]))


def _length(column: str) -> Column:
    return F.sqrt(F.aggregate(column, F.lit(0.0), lambda total, x: total + x * x))


@dataclass(frozen=True)
class _Tiles:
    """Matching in blocks of queries and shards of targets, one task or less for each pair of them."""

    n: int
    ties: str
    cosine: bool
    block_rows: int
    shard_rows: int
    exclude: DataFrame | None
    n_pairs: int

    def best(
        self, queries: DataFrame, targets: DataFrame, n_queries: Sequence[int], n_targets: Sequence[int], count: bool = False
    ) -> DataFrame:
        """(left_id, right_id, score): the best of every shard that a query meets.

        Queries are (id, features, floor, ranges), targets (id, features, range): a query meets the first
        ``ranges`` ranges. The counts are, per range, of queries that meet it and of targets. A range has as
        many shards as its targets fill, by their ids' hashes; a shard as many blocks as its queries fill.
        """
        spark = queries.sparkSession
        cores = spark.sparkContext.defaultParallelism
        shards = [max(1, math.ceil(some / self.shard_rows)) for some in n_targets]
        begins = np.concatenate([[0], np.cumsum(shards)]).tolist()
        wanted = math.ceil(4 * cores / begins[-1])  # blocks that keep every core busy
        blocks = [
            max(1, math.ceil(some / self.block_rows), min(wanted, math.ceil(some / 64)))
            for some, number in zip(n_queries, shards) for _ in range(number)
        ]
        left_type = queries.schema["id"].dataType
        right_type = targets.schema["id"].dataType
        lists, in_shard = self._lists(queries, targets, shards, begins) if self.exclude is not None else (None, {})
        for shard, number in in_shard.items():  # keep the excluded pairs of one block and shard in bounds as well
            blocks[shard] = max(blocks[shard], min(max(1, max(n_queries)), math.ceil(number / PAIRS_PER_TASK)))

        def of(values: Sequence[int], place: Column) -> Column:
            return F.lit(values[0]) if len(set(values)) == 1 else F.element_at(F.lit(values), place + 1)

        def block_of(c: Column) -> Column:
            return F.pmod(F.xxhash64(c.cast("bigint")), of(blocks, F.col("shard"))).cast("int")

        def up_to(number: Column) -> Column:
            return F.explode(F.sequence(F.lit(0), number - 1))

        left = queries.select(
            F.col("id").alias("left_id"),
            "features",
            "floor",
            F.lit(None).cast(T.ArrayType(right_type)).alias("excluded"),
            up_to(of(begins[1:], F.col("ranges") - 1)).alias("shard"),
            F.lit(QUERY).alias("side"),
        )
        if lists is not None:
            left = left.unionByName(
                lists.select(
                    F.col("left_id").cast(left_type),
                    F.lit(None).cast("array<double>").alias("features"),
                    F.lit(None).cast("double").alias("floor"),
                    "excluded",
                    "shard",
                    F.lit(LEFT_OUT).alias("side"),
                )
            )
        left = left.withColumn("block", block_of(F.col("left_id")))
        right = targets.select(F.col("id").alias("right_id"), "features", _shard("id", "range", shards, begins).alias("shard"))
        right = right.select(
            "shard", "right_id", "features", up_to(of(blocks, F.col("shard"))).alias("block"), F.lit(TARGET).alias("side")
        )
        # One partition per (block, shard) pair up to a bound: the work is in the product, which the
        # size-based coalescing of shuffles cannot see.
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        partitions = min(sum(blocks), 8 * max(width, cores))
        schema = T.StructType(
            [
                T.StructField("left_id", left_type),
                T.StructField("right_id", right_type),
                T.StructField("score", T.DoubleType()),
            ]
        )
        work = _block_matcher(self.n, self.ties == "rank", self.cosine, count)
        if self.ties == "rank":  # rows without a bound: they leave the task one batch after the other
            both_sides = left.unionByName(right, allowMissingColumns=True).repartition(partitions, "block", "shard")
            return both_sides.groupBy("block", "shard").applyInArrow(work, schema)

        def both(left: pa.Table, right: pa.Table) -> pa.Table:
            found = list(work(iter([*left.to_batches(), *right.to_batches()])))
            if found:
                return pa.Table.from_batches(found)
            return pa.table({"left_id": left["left_id"][:0], "right_id": right["right_id"][:0], "score": np.empty(0)})

        return (
            left.repartition(partitions, "block", "shard")
            .groupBy("block", "shard")
            .cogroup(right.repartition(partitions, "block", "shard").groupBy("block", "shard"))
            .applyInArrow(both, "possible long, computed long" if count else schema)
        )

    def _lists(
        self, queries: DataFrame, targets: DataFrame, shards: Sequence[int], begins: Sequence[int]
    ) -> tuple[DataFrame, dict[int, int]]:
        """(left_id, shard, excluded) of the pairs whose query meets their target's range, and bounds of their numbers per shard."""
        right_type = targets.schema["id"].dataType
        pairs = self.exclude.select("left_id", F.col("right_id").cast(right_type).alias("right_id")).dropna()
        kind = pairs.schema["left_id"].dataType.simpleString()
        if len(shards) == 1:
            pairs = pairs.withColumn("range", F.lit(0))
        else:
            pairs = pairs.join(targets.select(F.col("id").alias("right_id"), "range"), "right_id")
            pairs = pairs.join(queries.select(F.col("id").alias("left_id"), "ranges"), "left_id").where("range < ranges")
        pairs = pairs.select("left_id", _shard("right_id", "range", shards, begins).alias("shard"), "right_id")
        lists = pairs.repartition("left_id", "shard").sortWithinPartitions("left_id", "shard", "right_id").mapInArrow(
            _listed, f"left_id {kind}, shard int, excluded array<{right_type.simpleString()}>"
        )
        if len(shards) == 1:
            return lists, dict.fromkeys(range(begins[-1]), math.ceil(self.n_pairs / begins[-1]))
        lists = cut_lineage(lists)
        return lists, {r["shard"]: r["n"] for r in lists.groupBy("shard").agg(F.sum(F.size("excluded")).alias("n")).collect()}


def _shard(key: str, place: str, shards: Sequence[int], begins: Sequence[int]) -> Column:
    """The shard of a target: of those of its range the one that its id's hash names."""
    hashed = F.xxhash64(F.col(key).cast("bigint"))
    if len(shards) == 1:
        return F.pmod(hashed, F.lit(shards[0])).cast("int")
    in_range = F.pmod(hashed, F.element_at(F.lit(list(shards)), F.col(place) + 1))
    return (F.element_at(F.lit(list(begins)), F.col(place) + 1) + in_range).cast("int")


def _named(matches: DataFrame, left: str, right: str, score: str) -> DataFrame:
    return matches.select(
        F.col("left_id").alias(left), F.col("right_id").alias(right), F.col("score").alias(score)
    )


def _chosen(factors: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    wanted = ids.select(F.col(column).alias("id")).distinct()
    return factors.join(wanted, "id", "left_semi")


def _tiles(model: FactorModel) -> dict[str, int]:
    return dict.fromkeys(("block_rows", "shard_rows"), tile_rows(model.rank))


def recommend_excluding_rated(
    model: FactorModel,
    ratings: DataFrame,
    n: int = 10,
    ties: str = "row",
    **sizes,
) -> DataFrame:
    """(user, item, prediction): the ``n`` best items the user has not rated.

    Users and items are those occurring in ``ratings``. A user with fewer than n unrated items gets
    fewer rows. ``ties`` as in ``top_n_per_user``: "rank" returns all items tied with the n-th, which
    for a user vector of zeros is the whole catalogue.
    """
    cols = require_model(model).cols
    sizes = _tiles(model) | sizes
    if {"query_count", "target_count", "exclude_count"} - set(sizes):
        # One scan sizes all blocks; users and items are those of the ratings.
        found = ratings.agg(
            F.approx_count_distinct(cols.user).alias("query_count"),
            F.approx_count_distinct(cols.item).alias("target_count"),
            F.count("*").alias("exclude_count"),
        ).first()
        sizes = found.asDict() | sizes
    pairs = ratings.select(F.col(cols.user).alias("left_id"), F.col(cols.item).alias("right_id"))
    users, items = _chosen(model.users, ratings, cols.user), _chosen(model.items, ratings, cols.item)
    if sizes["target_count"] > sizes["shard_rows"]:  # the search reads them several times
        users, items = cut_lineage(users), cut_lineage(items)
    matches = top_matches(
        users,
        items,
        n,
        exclude=pairs,
        ties=ties,
        **sizes,
    )
    return _named(matches, cols.user, cols.item, cols.prediction)


def recommend_all_users(model: FactorModel, n: int = 10, **options) -> DataFrame:
    """(user, item, prediction): the ``n`` best items of every user, rated ones included."""
    cols = require_model(model).cols
    options = _tiles(model) | {"query_count": model.n_users, "target_count": model.n_items} | options
    return _named(
        top_matches(model.users, model.items, n, **options), cols.user, cols.item, cols.prediction
    )


def recommend_for_users(model: FactorModel, ids: DataFrame, n: int = 10, **options) -> DataFrame:
    """The same for the users in ``ids``; an unknown id gives no row."""
    cols = require_model(model).cols
    options = _tiles(model) | {"target_count": model.n_items} | options
    matches = top_matches(_chosen(model.users, ids, cols.user), model.items, n, **options)
    return _named(matches, cols.user, cols.item, cols.prediction)


def recommend_users_for_items(
    model: FactorModel, ids: DataFrame, n: int = 10, **options
) -> DataFrame:
    """(item, user, prediction): the ``n`` users who would rate each item highest."""
    cols = require_model(model).cols
    options = _tiles(model) | {"target_count": model.n_users} | options
    matches = top_matches(_chosen(model.items, ids, cols.item), model.users, n, **options)
    return _named(matches, cols.item, cols.user, cols.prediction)


def similar_items(
    factors: DataFrame, ids: DataFrame, n: int = 10, column: str = "movieId", **options
) -> DataFrame:
    """(item, similar item, cosine) for the items in ``ids``, the item itself left out."""
    wanted = _chosen(factors, ids, column)
    itself = wanted.select(F.col("id").alias("left_id"), F.col("id").alias("right_id"))
    matches = top_matches(wanted, factors, n, exclude=itself, cosine=True, **options)
    return _named(matches, column, f"similar_{column}", "similarity")


def nest_recommendations(recs: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """(user, recommendations array<struct<item, rating>>), best first."""
    entry = F.struct(
        F.col(cols.prediction).alias("rating"), (-F.col(cols.item)).alias("_o"),
        F.col(cols.item).alias(cols.item),
    )
    ordered = F.sort_array(F.collect_list(entry), asc=False)
    return recs.groupBy(cols.user).agg(
        F.transform(
            ordered, lambda e: F.struct(e[cols.item].alias(cols.item), e["rating"].alias("rating"))
        ).alias("recommendations")
    )


def flatten_recommendations(nested: DataFrame, cols: Columns = Columns()) -> DataFrame:
    """Nested recommendations, as MLlib returns them, to (user, item, prediction) rows."""
    return nested.select(cols.user, F.inline("recommendations")).select(
        cols.user, cols.item, F.col("rating").cast("double").alias(cols.prediction)
    )
