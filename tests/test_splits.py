import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from starloom.functions import threshold
from starloom.operators import ids, splits
from workload import views


@pytest.fixture
def source(spark, sf_dir):
    return views.ratings(spark, sf_dir).cache()


def test_bernoulli_split_is_disjoint_and_complete(source, rows_of):
    train, test = splits.split_bernoulli(source, 0.8, seed=5)
    assert rows_of(train.unionByName(test)) == rows_of(source)
    pairs = ["userId", "movieId"]
    assert train.select(pairs).intersect(test.select(pairs)).count() == 0
    again, _ = splits.split_bernoulli(source.repartition(7), 0.8, seed=5)
    assert rows_of(again) == rows_of(train)


@pytest.mark.parametrize("test_size", [0.0, 0.013, 0.2, 0.5, 1.0])
def test_exact_split_has_exact_sizes(source, rows_of, test_size):
    train, test = splits.split_exact(source, test_size)
    n = source.count()
    assert test.count() == math.ceil(round(test_size * n, 6))
    assert rows_of(train.unionByName(test)) == rows_of(source)


def test_exact_split_ignores_partitioning(source, rows_of):
    first = splits.split_exact(source.repartition(1), 0.3)[1]
    second = splits.split_exact(source.repartition(7), 0.3)[1]
    assert rows_of(first) == rows_of(second)


def test_exact_split_can_cut_through_exact_copies(ratings_of, monkeypatch):
    monkeypatch.setattr(splits, "COPIES_PER_TASK", 7)
    source = ratings_of([(1, 1, 4.0, 9)] * 100 + [(2, i, 1.0, i) for i in range(5)])
    train, test = splits.split_exact(source, 0.5)
    assert (train.count(), test.count()) == (52, 53)
    copies = F.count_if((F.col("userId") == 1) & (F.col("movieId") == 1))
    assert train.agg(copies).first()[0] + test.agg(copies).first()[0] == 100


def test_exact_split_of_nothing(ratings_of):
    train, test = splits.split_exact(ratings_of([]), 0.2)
    assert (train.count(), test.count()) == (0, 0)


def test_samples_are_nested_and_match_the_counts(source, rows_of):
    ladder = splits.sample_ladder(source, [0.1, 0.5, 1.0])
    counts = {r["fraction"]: r["sample_size"] for r in splits.sample_ladder_counts(source, [0.1, 0.5, 1.0]).collect()}
    assert {f: s.count() for f, s in ladder} == counts
    assert counts[1.0] == source.count()
    smaller, larger = ladder[0][1], ladder[1][1]
    assert smaller.exceptAll(larger).count() == 0


@pytest.mark.parametrize("fraction", [0.125, 0.25, 0.255, 1 / 3])
def test_samples_have_their_share_and_are_nested(source, fraction):
    sample = splits.sample_fraction(source, fraction)
    assert abs(sample.count() / source.count() - fraction) < 0.02
    assert splits.sample_fraction(source, fraction * 0.97).exceptAll(sample).count() == 0


def test_very_small_fractions_are_kept(spark):
    rows = spark.range(4_000_000).select(F.col("id").alias("userId"), F.lit(1).alias("movieId"))
    assert splits.sample_fraction(rows, 4e-6).count() > 0
    assert threshold(4e-7) > 0


def test_draws_of_one_seed_are_independent(source):
    sample = splits.sample_fraction(source, 0.25, 42)
    train, test = splits.split_bernoulli(sample, 0.8, 42)
    assert abs(test.count() / sample.count() - 0.2) < 0.05
    folds = splits.kfold_assign(sample, 4, 42).groupBy("fold").count().collect()
    assert len(folds) == 4 and min(r["count"] for r in folds) > sample.count() / 8


def test_folds_cover_all_rows(source):
    sizes = splits.kfold_assign(source, 4).groupBy("fold").count().collect()
    assert {r["fold"] for r in sizes} == {0, 1, 2, 3}
    assert sum(r["count"] for r in sizes) == source.count()


def test_known_pairs_needs_both_sides(ratings_of, rows_of):
    train = ratings_of([(1, 10, 1.0, 1), (2, 20, 1.0, 1)])
    test = ratings_of([(1, 20, 1.0, 1), (1, 30, 1.0, 1), (3, 10, 1.0, 1)])
    assert rows_of(splits.known_pairs(test, train)) == [(1, 20, 1.0, 1)]


def test_filter_of_an_absent_id_is_empty(source):
    assert splits.filter_by_id(source, "userId", -5).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.integers(-(2**31), 2**31 - 1), min_size=1, max_size=200))
def test_id_map_is_the_sorted_position(spark, values):
    frame = spark.createDataFrame([(v,) for v in values] * 2, "id INT").repartition(4)
    found = {r["id"]: r["idx"] for r in ids.id_map(frame, "id").collect()}
    assert found == {v: i for i, v in enumerate(sorted(values))}


def test_id_map_of_wide_ids_with_many_ranges(spark):
    frame = spark.range(5000).select((F.col("id") * 3_000_000_000).alias("id"))
    found = ids.id_map(frame, "id").where(F.col("id") / 3_000_000_000 != F.col("idx"))
    assert found.count() == 0


def test_decode_reverses_encode(source, rows_of):
    mapping = ids.id_map(source, "userId")
    back = ids.decode_ids(ids.encode_ids(source, "userId", mapping).drop("userId"), mapping, "userId")
    assert rows_of(back.select(source.columns)) == rows_of(source)
