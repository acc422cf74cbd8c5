"""Raw dumps in every supported layout, written by Spark from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.schemas import GENRE_FLAG_COLUMNS
from starloom.session import scratch_path

from . import views


def write_delimited(df: DataFrame, sep: str, path: str) -> str:
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    df.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def quoted_title() -> Column:
    """A title with a comma and quotes, as CSV dumps have them."""
    return F.concat(F.col("title"), F.lit(', "the '), F.col("movieId").cast("string"), F.lit('"'))


def movies_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.movies(spark, sf_dir).withColumn("title", quoted_title())


def movies_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.movies_flags(spark, sf_dir).select(
        "movieId",
        "title",
        F.lit("01-Jan-1995").alias("release_date"),
        F.lit(None).cast("string").alias("video_release_date"),
        F.concat(F.lit("http://example.org/title?"), F.col("movieId")).alias("IMDb_URL"),
        *GENRE_FLAG_COLUMNS,
    )


def write_ratings(spark: SparkSession, sf_dir: str, fmt: str, path: str) -> str:
    rows = views.ratings(spark, sf_dir)
    if fmt == "csv":
        rows.write.mode("overwrite").csv(path, header=True)
        return path
    return write_delimited(rows, {"tsv": "\t", "dat": "::"}[fmt], path)


def write_movies(spark: SparkSession, sf_dir: str, fmt: str, path: str) -> str:
    if fmt == "csv":
        movies_csv(spark, sf_dir).write.mode("overwrite").csv(path, header=True, escape='"')
        return path
    if fmt == "dat":
        return write_delimited(views.movies(spark, sf_dir), "::", path)
    return write_delimited(movies_wide(spark, sf_dir), "|", path)


def write_users(spark: SparkSession, sf_dir: str, fmt: str, path: str) -> str:
    rows = views.users(spark, sf_dir)
    if fmt == "u_user":
        return write_delimited(
            rows.select("userId", "age", "gender", "occupation", "zip_code"), "|", path
        )
    rows = rows.withColumn("occupation", F.length("occupation"))
    return write_delimited(
        rows.select("userId", "gender", "age", "occupation", "zip_code"), "::", path
    )


def write_dump(spark: SparkSession, sf_dir: str, size: str) -> str:
    """The folder tree of one dump size; returns its root."""
    root = scratch_path(spark, f"raw-{size}")
    if size == "100k":
        folder = f"{root}/ml-100k"
        write_ratings(spark, sf_dir, "tsv", f"{folder}/u.data")
        write_movies(spark, sf_dir, "u_item", f"{folder}/u.item")
        write_users(spark, sf_dir, "u_user", f"{folder}/u.user")
    elif size == "25m":
        write_ratings(spark, sf_dir, "csv", f"{root}/ml-25m/ratings.csv")
        write_movies(spark, sf_dir, "csv", f"{root}/ml-25m/movies.csv")
    else:
        folder = f"{root}/{'ml-1m' if size == '1m' else 'ml-10M100K'}"
        write_ratings(spark, sf_dir, "dat", f"{folder}/ratings.dat")
        write_movies(spark, sf_dir, "dat", f"{folder}/movies.dat")
        if size == "1m":
            write_users(spark, sf_dir, "dat", f"{folder}/users.dat")
    return root
