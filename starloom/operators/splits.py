"""Train/test splits, samples and folds, all decided by key hashes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.hashing import bucket52, digest, threshold
from ..schemas import Columns
from ..session import cut_lineage
from .skew import skew_joins

COLS = Columns()
# Default sample fractions.
DEFAULT_FRACTIONS = (0.01, 0.1, 0.25, 0.5, 0.75, 1.0)
COPIES_PER_TASK = 1_000_000


def split_bernoulli(
    ratings: DataFrame, p: float = 0.8, seed: int | None = None, cols: Columns = COLS
) -> tuple[DataFrame, DataFrame]:
    """(train, test): a (user, item) pair is in train with probability ``p``.

    Two complementary narrow filters. Repeated pairs fall on the same side, so no test pair leaks
    into training.
    """
    in_train = bucket52([cols.user, cols.item], "split", seed) < threshold(p)
    return ratings.where(in_train), ratings.where(~in_train)


def _repeat(df: DataFrame, times: str) -> DataFrame:
    """Every row ``times`` times, generated in bounded chunks that are spread over tasks."""
    chunk = F.lit(COPIES_PER_TASK)
    chunks = df.where(F.col(times) > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / chunk)))
    )
    size = F.least(chunk, F.col(times) - F.col("_chunk") * chunk).cast("int")
    return (
        chunks.repartition(*df.columns, "_chunk")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), size)))
        .drop("_chunk", "_copy", times)
    )


def _locate(counts: list[tuple[str, int]], wanted: int) -> tuple[str, int]:
    """The hash prefix in which the running count reaches ``wanted``, and the count before it."""
    below = 0
    for prefix, n in sorted(counts):
        if below + n >= wanted:
            return prefix, below
        below += n
    raise ValueError(f"asked for {wanted} of {below} rows")


def split_exact(
    ratings: DataFrame, test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ``ceil(test_size * n)`` test rows.

    Rows are ordered by (md5 of the whole row, the row); the first ones form the test set. Counts
    per 4-digit hash prefix (65,536 at most) locate the prefix that holds the cut, and a narrow
    filter places all rows with other prefixes. The rows of that one prefix, with exact copies
    counted, are written to the shared folder and cut there in the same way, one level deeper.
    """
    columns = ratings.columns
    hashed = ratings.withColumn("_md5", digest(columns, seed))
    head, longer = F.substring("_md5", 1, 4), F.substring("_md5", 1, 8)
    head_counts = [tuple(r) for r in hashed.groupBy(head.alias("prefix")).agg(F.count("*")).collect()]
    n_rows = sum(n for _, n in head_counts)
    if not n_rows:
        return ratings, ratings
    wanted = math.ceil(round(test_size * n_rows, 6))
    cut, below = _locate(head_counts, wanted)

    edge = cut_lineage(
        hashed.where(head == cut).groupBy("_md5", *columns).agg(F.count("*").alias("_n"))
    )
    tail_counts = [tuple(r) for r in edge.groupBy(longer.alias("prefix")).agg(F.sum("_n")).collect()]
    last_cut, last_below = _locate(tail_counts, wanted - below)
    remaining = wanted - below - last_below
    order = Window.partitionBy(longer).orderBy("_md5", *columns)
    earlier = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    in_test = (
        F.when(longer < last_cut, F.col("_n"))
        .when(longer > last_cut, F.lit(0))
        .otherwise(F.greatest(F.lit(0), F.least(F.col("_n"), F.lit(remaining) - earlier)))
    )
    edge = edge.withColumn("_test", in_test).withColumn("_train", F.col("_n") - F.col("_test"))
    train, test = hashed.where(head > cut), hashed.where(head < cut)
    return (
        train.select(columns).unionByName(_repeat(edge, "_train").select(columns)),
        test.select(columns).unionByName(_repeat(edge, "_test").select(columns)),
    )


def sample_fraction(
    ratings: DataFrame, fraction: float, seed: int = 42, cols: Columns = COLS
) -> DataFrame:
    """Sample without replacement by key hash; ``fraction >= 1`` is the whole table.

    Samples of one seed are nested: every row of a smaller one is in each larger one.
    """
    if fraction >= 1:
        return ratings
    return ratings.where(bucket52([cols.user, cols.item], "sample", seed) < threshold(fraction))


def sample_ladder(
    ratings: DataFrame,
    fractions: Sequence[float] = DEFAULT_FRACTIONS,
    seed: int = 42,
    cols: Columns = COLS,
) -> list[tuple[float, DataFrame]]:
    """One growing sample per fraction, to train on."""
    return [(f, sample_fraction(ratings, f, seed, cols)) for f in fractions]


def sample_ladder_counts(
    ratings: DataFrame,
    fractions: Sequence[float] = DEFAULT_FRACTIONS,
    seed: int = 42,
    cols: Columns = COLS,
) -> DataFrame:
    """(fraction, sample_size) of every ladder step from one scan.

    Conditional counts in one aggregate: no row is copied per fraction, and only one row per map
    task is shuffled.
    """
    bucket = bucket52([cols.user, cols.item], "sample", seed)
    counts = ratings.select(bucket.alias("b")).agg(
        *[
            F.count_if(F.col("b") < threshold(min(f, 1.0))).alias(f"n{i}")
            for i, f in enumerate(fractions)
        ]
    )
    steps = [
        F.struct(F.lit(float(f)).alias("fraction"), F.col(f"n{i}").alias("sample_size"))
        for i, f in enumerate(fractions)
    ]
    return counts.select(F.inline(F.array(*steps)))


def sample_n(df: DataFrame, n: int, key: str, seed: int | None = None) -> DataFrame:
    """``n`` pseudo-random rows: a distributed top-n by hash, not a full sort."""
    return df.orderBy(digest([key], seed), key).limit(n)


def filter_by_id(df: DataFrame, column: str, value: int) -> DataFrame:
    """Rows of one id; pushed down to the scan. An absent id gives no row."""
    return df.where(F.col(column) == F.lit(value))


def known_pairs(test: DataFrame, train: DataFrame, cols: Columns = COLS) -> DataFrame:
    """Test rows whose user and item both occur in train."""
    ids = {key: train.select(key).distinct() for key in (cols.user, cols.item)}
    return skew_joins(test, ids, "left_semi").select(test.columns)


def kfold_assign(
    ratings: DataFrame, k: int = 3, seed: int = 42, cols: Columns = COLS, fold_col: str = "fold"
) -> DataFrame:
    """Add the fold number 0..k-1 of every row; repeated pairs share a fold."""
    return ratings.withColumn(
        fold_col, F.pmod(bucket52([cols.user, cols.item], "fold", seed), F.lit(k)).cast("int")
    )
