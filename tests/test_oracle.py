"""Every query with SQL gives the rows and types of that SQL."""

import pytest

import __spark_entry__ as entry_module
from check import TYPE_NAMES, canonical, oracle_rows
from workload import registry


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_rows_equal_sql(spark, sf_dir, name):
    frame = registry.QUERIES[name](spark, sf_dir)
    columns, types, rows = oracle_rows(sf_dir, registry.SQL[name])
    assert canonical(frame.columns, [tuple(r) for r in frame.collect()]) == canonical(columns, rows)
    assert {c: TYPE_NAMES.get(t, t) for c, t in frame.dtypes} == dict(zip(columns, types))


def test_entry_has_stable_columns(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == ["userId", "movieId", "prediction", "title", "genres"]
    assert frame.count() > 0


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
