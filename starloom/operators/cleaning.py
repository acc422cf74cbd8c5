"""Cleaning of rating, item and user tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..schemas import GENRE_FLAG_COLUMNS, GENRE_NAMES, RATINGS, Columns

COLS = Columns()


def genres_from_flags(
    movies: DataFrame,
    names: Sequence[str] = GENRE_NAMES,
    flags: Sequence[str] = GENRE_FLAG_COLUMNS,
) -> DataFrame:
    """(movieId, title, genres) from 0/1 genre columns; no flag set gives an empty string."""
    if len(names) != len(flags):
        raise ValueError(f"{len(names)} genre names for {len(flags)} flag columns")
    parts = [F.when(F.col(flag) == 1, F.lit(name)) for flag, name in zip(flags, names)]
    return movies.select("movieId", "title", F.concat_ws("|", *parts).alias("genres"))


def clean_movies(movies: DataFrame, names: Sequence[str] = GENRE_NAMES) -> DataFrame:
    """(movieId, title, genres), building genres from flag columns where they come as flags."""
    if {"title", "genres"} <= set(movies.columns):
        return movies.select("movieId", "title", "genres")
    return genres_from_flags(movies, names)


def clean_users(users: DataFrame) -> DataFrame:
    """(userId, gender, age) where both details exist, else the table as it is."""
    if {"gender", "age"} <= set(users.columns):
        return users.select("userId", "gender", "age")
    return users


def synthesize_users(ratings: DataFrame, cols: Columns = COLS) -> DataFrame:
    """A user table for rating files that come without one."""
    return ratings.select(cols.user).distinct().select(
        cols.user, F.lit("unknown").alias("gender"), F.lit(-1).alias("age")
    )


def _typed_ratings(ratings: DataFrame) -> DataFrame:
    types = {field.name: field.dataType for field in RATINGS}
    return ratings.select(
        *[
            F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
            for c in ratings.columns
        ]
    )


def clean_ratings(ratings: DataFrame, cols: Columns = COLS) -> DataFrame:
    """Typed ratings without the rows whose user, item or rating is missing or unreadable.

    The identity on clean data; ``cleaning_report`` counts what is dropped.
    """
    return _typed_ratings(ratings).dropna(subset=[cols.user, cols.item, cols.rating])


def cleaning_report(ratings: DataFrame, cols: Columns = COLS) -> DataFrame:
    """One row: rows read, rows kept and rows that ``clean_ratings`` drops."""
    typed = _typed_ratings(ratings)
    usable = (
        F.col(cols.user).isNotNull() & F.col(cols.item).isNotNull() & F.col(cols.rating).isNotNull()
    )
    return typed.agg(
        F.count("*").alias("rows_read"),
        F.count_if(usable).alias("rows_kept"),
        F.count_if(~usable).alias("rows_dropped"),
    )


def observed_only(ratings: DataFrame, cols: Columns = COLS) -> DataFrame:
    """Ratings above zero; a zero stands for "not rated" in matrix form."""
    return ratings.where(F.col(cols.rating) > 0)


def dedupe_last(ratings: DataFrame, cols: Columns = COLS) -> DataFrame:
    """One row per (user, item): the latest rating, the higher one on equal timestamps.

    A grouped maximum combines on the map side, so a pair with very many copies stays cheap.
    """
    by_time = cols.timestamp in ratings.columns
    fields = [cols.timestamp, cols.rating] if by_time else [cols.rating]
    last = ratings.groupBy(cols.user, cols.item).agg(F.max(F.struct(*fields)).alias("last"))
    keep = [F.col("last")[cols.rating].alias(cols.rating)]
    if by_time:
        keep.append(F.col("last")[cols.timestamp].alias(cols.timestamp))
    return last.select(cols.user, cols.item, *keep)
