"""Writers. All write in parallel from the executors and replace what was there."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schemas import TRIPLES


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; quotes inside a field are doubled."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Run metrics as JSON, one object per line."""
    df.write.mode("overwrite").json(path)


def write_training_triples(ratings: DataFrame, path: str) -> None:
    """Only what training reads: (user, item, rating)."""
    write_parquet(ratings.select(TRIPLES.fieldNames()), path)


def write_id_mappings(movies: DataFrame, users: DataFrame, folder: str) -> None:
    """The lookup tables (movieId, title) and (userId)."""
    write_csv(movies.select("movieId", "title"), f"{folder}/movie_mapping")
    write_csv(users.select("userId"), f"{folder}/user_mapping")
