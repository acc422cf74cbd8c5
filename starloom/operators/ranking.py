"""Top-n per user. The ``rank <= n`` shape lets Spark limit each group before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import Columns

COLS = Columns()


def _best_first(cols: Columns, ties: str) -> Column:
    if ties not in ("rank", "row"):
        raise ValueError("ties must be 'rank' or 'row'")
    best = F.col(cols.prediction).desc()
    by_user = Window.partitionBy(cols.user)
    if ties == "rank":
        return F.rank().over(by_user.orderBy(best))
    return F.row_number().over(by_user.orderBy(best, F.col(cols.item).asc()))


def top_n_per_user(
    preds: DataFrame, n: int = 10, ties: str = "rank", cols: Columns = COLS
) -> DataFrame:
    """The ``n`` best items of every user.

    ``rank`` keeps every item tied with the n-th; ``row`` keeps exactly n at most, lower item ids
    first among equal predictions.
    """
    return preds.withColumn("_r", _best_first(cols, ties)).where(F.col("_r") <= n).drop("_r")


def with_rank(recs: DataFrame, cols: Columns = COLS, rank_col: str = "rank") -> DataFrame:
    """Number each user's recommendations 1, 2, ... from the best prediction down."""
    return recs.withColumn(rank_col, _best_first(cols, "row"))


def first_k(recs: DataFrame, k: int, cols: Columns = COLS, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` recommendations of every user with their rank."""
    return with_rank(recs, cols, rank_col).where(F.col(rank_col) <= k)


def top_n_for_user(preds: DataFrame, user: int, n: int = 10, cols: Columns = COLS) -> DataFrame:
    """The ``n`` best items of one user: a pushed-down filter and a distributed top-n."""
    return (
        preds.where(F.col(cols.user) == F.lit(user))
        .orderBy(F.col(cols.prediction).desc(), F.col(cols.item).asc())
        .limit(n)
    )
