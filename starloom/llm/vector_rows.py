"""What the vector searches share: sound rows, matrices from Arrow columns, groups dealt to tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most partitions that groups are dealt to; beyond it several groups share a task, one after another.
MOST_TASKS = 20_000


def sound(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.coalesce(F.forall(vector.cast("array<double>"), finite), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(values) == len(column) * width:
        return values.reshape(len(column), width)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), values.dtype)
    out[np.repeat(np.arange(len(column)), sizes), np.concatenate([np.arange(s) for s in sizes])] = values
    return out


def cogrouped(left: DataFrame, right: DataFrame, keys: list[str], n_groups: int, work: Callable, schema: str) -> DataFrame:
    """work(left table, right table) for every group of keys, spread over about as many tasks as groups.

    Groups are few rows for much work, so the number of tasks follows their count, not their bytes.
    """
    tasks = min(3 * max(1, n_groups), MOST_TASKS)
    sides = [side.repartition(tasks, *keys).groupBy(*keys) for side in (left, right)]
    return sides[0].cogroup(sides[1]).applyInArrow(work, schema)
