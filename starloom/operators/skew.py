"""Joins and aggregations that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A key above this share of the rows counts as hot. At most 1/share keys can exceed it, so the list
# of hot keys is bounded by 256 entries at any data size.
HOT_SHARE = 1 / 256
BROADCAST_BYTES = 10 * 1024 * 1024
SALT = "_salt"


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (file sizes for scans, products of sizes after joins)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def hot_keys(df: DataFrame, *keys: str, share: float = HOT_SHARE) -> dict[str, list]:
    """Per key column, the values holding more than ``share`` of the rows, plus possibly colder ones.

    One scan of the key columns with bounded per-task state, and at most ``1/share`` values per
    column. The lists only steer where rows go: extra or missing values never change a result.
    """
    found = df.stat.freqItems(list(keys), share).first()
    return {key: sorted(v for v in found[i] or [] if v is not None) for i, key in enumerate(keys)}


def default_salts(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _is_hot(key: str, hot: list) -> Column:
    return F.col(key).isNull() | F.col(key).isin(hot) if hot else F.col(key).isNull()


def add_salt(fact: DataFrame, key: str, hot: list, salts: int) -> DataFrame:
    """Spread the rows of hot (and null) keys over ``salts`` values of ``_salt``; others get 0.

    The row hash spreads different rows of one key; the map partition spreads exact copies. Both
    are the same when a task is retried.
    """
    others = [c for c in fact.columns if c != key]
    spread = F.spark_partition_id().cast("bigint")
    if others:
        spread = spread + F.pmod(F.xxhash64(*others), F.lit(salts))
    salt = F.when(_is_hot(key, hot), F.pmod(spread, F.lit(salts))).otherwise(F.lit(0))
    return fact.withColumn(SALT, salt.cast("int"))


def replicate(dim: DataFrame, key: str, hot: list, salts: int) -> DataFrame:
    """The other side of ``add_salt``: hot keys once per salt, all other keys once."""
    copies = F.when(
        F.col(key).isin(hot) if hot else F.lit(False), F.sequence(F.lit(0), F.lit(salts - 1))
    ).otherwise(F.array(F.lit(0)))
    return dim.withColumn(SALT, F.explode(copies))


def skew_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int | None = None,
    hot: list | None = None,
    dim_bytes: int | None = None,
) -> DataFrame:
    """Join a fact table with a table that is unique (or nearly so) on ``key``.

    ``how`` is inner, left, left_semi or left_anti. A ``dim`` of at most ``broadcast_bytes`` is
    broadcast; its size is ``dim_bytes`` where the caller knows it, else Catalyst's estimate.
    Otherwise both sides shuffle on the key, and adaptive execution splits the fact partitions of
    hot keys. With a list of hot keys of a stored table (see ``hot_keys``) the shuffle is on
    (key, salt) instead, which also spreads hot keys on the map side of later steps. No job runs
    while the join is planned.
    """
    size = estimated_bytes(dim) if dim_bytes is None else dim_bytes
    if size <= broadcast_bytes:
        return fact.join(F.broadcast(dim), key, how)
    if hot is None:
        return fact.join(dim, key, how)
    salts = salts or default_salts(fact)
    joined = add_salt(fact, key, hot, salts).join(
        replicate(dim, key, hot, salts), [key, SALT], how
    )
    return joined.drop(SALT)


def skew_joins(
    fact: DataFrame,
    dims: dict[str, DataFrame],
    how: str = "inner",
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    dim_bytes: dict[str, int | None] | None = None,
) -> DataFrame:
    """``skew_join`` with several tables, each on its own key column of ``fact``."""
    known = dim_bytes or {}
    for key, dim in dims.items():
        fact = skew_join(fact, dim, key, how, broadcast_bytes=broadcast_bytes, dim_bytes=known.get(key))
    return fact
