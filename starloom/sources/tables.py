"""Readers for tables the library itself writes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from ..schemas import RATINGS, RECOMMENDATIONS, RUN_METRICS
from .raw import HEADED, path_exists

SPLIT_NAMES = ("train_ratings", "test_ratings")


def _read(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType
) -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt == "csv":
        return spark.read.csv(path, schema=schema, **HEADED)
    raise ValueError(f"unknown format {fmt!r}; known: parquet, csv")


def read_split(
    spark: SparkSession, folder: str, fmt: str = "parquet", names: Sequence[str] = SPLIT_NAMES
) -> tuple[DataFrame, DataFrame]:
    """(train, test) written as ``<folder>/<name>.<fmt>``."""
    train, test = (_read(spark, f"{folder}/{name}.{fmt}", fmt, RATINGS) for name in names)
    return train, test


def read_recommendations(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, fmt, RECOMMENDATIONS)


def read_metrics(
    spark: SparkSession,
    paths: Iterable[str],
    schema: T.StructType = RUN_METRICS,
    lines: bool = False,
) -> DataFrame:
    """Run metrics from JSON; missing paths give no rows.

    A file holds one object, pretty-printed or not. With ``lines`` it holds one object per line, as
    ``write_metrics`` leaves it.
    """
    found = [p for p in paths if path_exists(spark, p)]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(found, multiLine=not lines)


def ids_frame(spark: SparkSession, ids: Iterable[int | str], column: str) -> DataFrame:
    """A one-column table of user or item ids to score: 64-bit numbers, or strings if any id is one."""
    wanted = list(ids)
    if any(isinstance(i, str) for i in wanted):
        return spark.createDataFrame([(str(i),) for i in wanted], f"{column} STRING")
    return spark.createDataFrame([(int(i),) for i in wanted], f"{column} BIGINT")
