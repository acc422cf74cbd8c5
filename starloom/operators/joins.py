"""Joins between candidates, ratings, factor tables and item details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.vectors import as_double_vector, dot
from ..schemas import Columns
from .skew import skew_join, skew_joins

COLS = Columns()


def candidate_counts(ratings: DataFrame, cols: Columns = COLS) -> DataFrame:
    """Per user: size of the user x item candidate space, pairs already rated, pairs left.

    The product of all users and items is never built. Its size per user follows from the number of
    items, and the rated part from the distinct pairs.
    """
    pairs = ratings.select(cols.user, cols.item).distinct()
    per_user = pairs.groupBy(cols.user).agg(F.count("*").alias("rated_pairs"))
    n_items = ratings.agg(F.count_distinct(cols.item)).scalar()
    return per_user.select(
        cols.user,
        n_items.alias("all_pairs"),
        "rated_pairs",
        (n_items - F.col("rated_pairs")).alias("unrated_pairs"),
    )


def exclude_rated(candidates: DataFrame, rated: DataFrame, cols: Columns = COLS) -> DataFrame:
    """Candidates whose (user, item) pair does not occur in ``rated``."""
    seen = rated.select(cols.user, cols.item).distinct()
    return candidates.join(seen, [cols.user, cols.item], "left_anti").select(candidates.columns)


def enrich_titles(
    recs: DataFrame, movies: DataFrame, how: str = "left", cols: Columns = COLS
) -> DataFrame:
    """Attach title and genres. ``left`` keeps items without details, ``inner`` drops them."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    details = movies.select(cols.item, "title", "genres")
    return skew_join(recs, details, cols.item, how).select(*recs.columns, "title", "genres")


def score_pairs(
    pairs: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    *,
    how: str = "inner",
    rank: int | None = None,
    cols: Columns = COLS,
    dim_bytes: dict[str, int | None] | None = None,
) -> DataFrame:
    """``pairs`` with the dot product of their user and item vectors.

    Factor tables are (id, features). ``inner`` leaves out pairs with an unknown id; ``left`` keeps
    them with a null prediction. Pass ``rank`` to keep the product in generated code, and the sizes
    of the factor tables by key column, if known, to have small ones broadcast.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")

    def vectors(factors: DataFrame, key: str, name: str) -> DataFrame:
        return factors.select(
            F.col("id").alias(key), as_double_vector(F.col("features")).alias(name)
        )

    dims = {
        cols.user: vectors(user_factors, cols.user, "_u"),
        cols.item: vectors(item_factors, cols.item, "_v"),
    }
    score = dot(F.col("_u"), F.col("_v"), rank)
    return skew_joins(pairs, dims, how, dim_bytes=dim_bytes).select(*pairs.columns, score.alias(cols.prediction))


def recommendation_hits(
    recs: DataFrame, test: DataFrame, k: int, rank_col: str = "rank", cols: Columns = COLS
) -> DataFrame:
    """(user, item) pairs that are among the user's first ``k`` recommendations and in test."""
    first = recs.where(F.col(rank_col) <= k).select(cols.user, cols.item).distinct()
    return first.join(
        test.select(cols.user, cols.item).distinct(), [cols.user, cols.item], "left_semi"
    )


def popularity_lookup(ratings: DataFrame, counts: DataFrame, cols: Columns = COLS) -> DataFrame:
    """One row: rating rows whose item has a count, and the sum of the counts they look up.

    Ratings are counted per item before the join, so the join sees one row per item.
    """
    def wide(c) -> Column:  # an item's product of two counts can exceed a bigint
        return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")

    per_item = ratings.groupBy(cols.item).agg(F.count("*").alias("_rows"))
    return per_item.join(counts.select(cols.item, "count"), cols.item).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("hit_rows"),
        F.coalesce(F.sum(wide("_rows") * wide("count")), wide(F.lit(0))).cast("decimal(38,0)").alias("lookup_total"),
    )
