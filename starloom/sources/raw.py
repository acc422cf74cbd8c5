"""Readers for raw rating dumps. Every reader has a fixed schema, so no file is scanned to infer one.

A field that does not parse becomes null; ``clean_ratings`` drops and counts such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cleaning import synthesize_users
from ..schemas import (
    MOVIES, MOVIES_WIDE, RATINGS, USER_DETAIL_COLUMNS, USERS_DAT, USERS_PIPE,
)

# Separators, encoding and file names of the known dump layouts.
LATIN_1 = "ISO-8859-1"
PLAIN = {"encoding": LATIN_1, "quote": "", "nullValue": ""}
HEADED = {"header": True, "escape": '"', "encoding": "UTF-8"}
RATING_FORMATS = {
    "tsv": {"sep": "\t", **PLAIN},
    "dat": {"sep": "::", **PLAIN},
    "csv": HEADED,
}
MOVIE_FORMATS = {
    "u_item": ({"sep": "|", **PLAIN}, MOVIES_WIDE),
    "dat": ({"sep": "::", **PLAIN}, MOVIES),
    "csv": (HEADED, MOVIES),
}
USER_FORMATS = {
    "u_user": ({"sep": "|", **PLAIN}, USERS_PIPE),
    "dat": ({"sep": "::", **PLAIN}, USERS_DAT),
}
DATASETS = {
    "100k": (["ml-100k"], ("u.data", "tsv"), ("u.item", "u_item"), ("u.user", "u_user")),
    "1m": (["ml-1m"], ("ratings.dat", "dat"), ("movies.dat", "dat"), ("users.dat", "dat")),
    "10m": (["ml-10m", "ml-10M100K"], ("ratings.dat", "dat"), ("movies.dat", "dat"), None),
    "25m": (["ml-25m"], ("ratings.csv", "csv"), ("movies.csv", "csv"), None),
}
DATASET_SIZES = list(DATASETS)


def _format(formats: dict, fmt: str):
    if fmt not in formats:
        raise ValueError(f"unknown format {fmt!r}; known: {', '.join(formats)}")
    return formats[fmt]


def read_ratings(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Ratings from ``tsv`` (tab), ``dat`` (``::``, latin-1) or ``csv`` (header) files."""
    return spark.read.csv(path, schema=RATINGS, **_format(RATING_FORMATS, fmt))


def read_movies(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Items from ``u_item`` (19 genre flags), ``dat`` or ``csv`` files.

    Titles in ``csv`` may hold commas and doubled quotes.
    """
    options, schema = _format(MOVIE_FORMATS, fmt)
    return spark.read.csv(path, schema=schema, **options)


def read_users(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Users from ``u_user`` or ``dat`` files, in one column order."""
    options, schema = _format(USER_FORMATS, fmt)
    return spark.read.csv(path, schema=schema, **options).select(USER_DETAIL_COLUMNS)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on any file system Spark can read.

    A file system that can't be reached is an error, not a missing path.
    """
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)


def dataset_folder(spark: SparkSession, root: str, size: str) -> str:
    """Folder of a dataset below ``root``; the 10m dump may have either of two folder names."""
    if size not in DATASETS:
        raise ValueError(f"unknown dataset size {size!r}; known: {', '.join(DATASETS)}")
    folders = [f"{root.rstrip('/')}/{name}" for name in DATASETS[size][0]]
    for folder in folders:
        if path_exists(spark, folder):
            return folder
    raise FileNotFoundError(f"no raw data for {size} at {' or '.join(folders)}")


def read_dataset(
    spark: SparkSession, root: str, size: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ratings, movies, users) of a dump; sizes without a user file get synthesised users."""
    folder = dataset_folder(spark, root, size)
    _, ratings_file, movies_file, users_file = DATASETS[size]

    def located(name: str) -> str:
        path = f"{folder}/{name}"
        if not path_exists(spark, path):
            raise FileNotFoundError(f"no raw data at {path}")
        return path

    ratings = read_ratings(spark, located(ratings_file[0]), ratings_file[1])
    movies = read_movies(spark, located(movies_file[0]), movies_file[1])
    if users_file is None:
        return ratings, movies, synthesize_users(ratings)
    return ratings, movies, read_users(spark, located(users_file[0]), users_file[1])
