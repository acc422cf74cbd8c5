"""Aggregates over rating tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import Columns

COLS = Columns()


def dataset_stats(ratings: DataFrame, cols: Columns = COLS) -> DataFrame:
    """One row: ratings, distinct users and distinct items, from one scan."""
    return ratings.agg(
        F.count("*").alias("num_ratings"),
        F.count_distinct(cols.user).alias("num_users"),
        F.count_distinct(cols.item).alias("num_items"),
    )


def item_popularity(ratings: DataFrame, cols: Columns = COLS) -> DataFrame:
    """(item, count): ratings per item."""
    return ratings.groupBy(cols.item).count()


def split_report(
    train: DataFrame, test: DataFrame, users: DataFrame, movies: DataFrame, cols: Columns = COLS
) -> DataFrame:
    """One row describing a prepared dataset; the four tables are independent scalar subqueries."""
    total_users = users.agg(F.count_distinct(cols.user)).scalar()
    total_movies = movies.agg(F.count_distinct(cols.item)).scalar()
    test_count = test.agg(F.count("*")).scalar()
    return train.agg(
        F.count("*").alias("train_count"), F.avg(cols.rating).alias("mean_rating")
    ).select(
        total_users.alias("total_users"),
        total_movies.alias("total_movies"),
        (F.col("train_count") + test_count).alias("total_ratings"),
        "train_count",
        test_count.alias("test_count"),
        "mean_rating",
    )


def profile_ratings(ratings: DataFrame, cols: Columns = COLS) -> DataFrame:
    """One row: rating count, mean rating and distinct users, from one scan."""
    return ratings.agg(
        F.count("*").alias("num_ratings"),
        F.avg(cols.rating).alias("mean_rating"),
        F.count_distinct(cols.user).alias("num_users"),
    )


def partition_counts(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """(partition, records), with a 0 row for every empty partition."""
    n = num_partitions or df.rdd.getNumPartitions()
    counts = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("records"))
    every = df.sparkSession.range(n).select(F.col("id").cast("int").alias("partition"))
    return every.join(counts, "partition", "left").select(
        "partition", F.coalesce("records", F.lit(0)).alias("records")
    )


def gram_columns(rank: int) -> tuple[list[str], list[str]]:
    """Names of the upper-triangle sums and of the right-hand side sums."""
    upper = [f"a_{i}_{j}" for i in range(rank) for j in range(i, rank)]
    return upper, [f"b_{i}" for i in range(rank)]


def gram_sums(vector: Column, rating: Column, rank: int) -> list[Column]:
    """count, sum(v v^T) (upper triangle) and sum(r v) as plain sums.

    Being ordinary sums they combine on the map side: an entity with very many ratings sends one
    row of k(k+1)/2 + k + 1 numbers per task, never its ratings.
    """
    upper, rhs = gram_columns(rank)
    cells = [(i, j) for i in range(rank) for j in range(i, rank)]
    return (
        [F.count("*").alias("n")]
        + [F.sum(vector[i] * vector[j]).alias(name) for (i, j), name in zip(cells, upper)]
        + [F.sum(rating * vector[i]).alias(name) for i, name in enumerate(rhs)]
    )


def gram(rated_vectors: DataFrame, entity: str, rank: int, rating: str = COLS.rating) -> DataFrame:
    """Normal equations per entity from rows (entity, rating, features)."""
    return rated_vectors.groupBy(entity).agg(*gram_sums(F.col("features"), F.col(rating), rank))
