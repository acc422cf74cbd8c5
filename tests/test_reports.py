import pytest
from pyspark.sql import functions as F

from starloom.operators import joins, layout, quality, reports, stats


@pytest.fixture
def recs(spark):
    rows = [(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1), (3, 10, 1)]
    return spark.createDataFrame(rows, "userId INT, movieId INT, rank INT")


@pytest.fixture
def test_pairs(spark):
    """User 3 has no test rows; a pair occurs twice."""
    return spark.createDataFrame([(1, 10), (1, 10), (1, 12), (1, 99), (2, 50)], "userId INT, movieId INT")


def test_precision_counts_short_lists_and_skips_untested_users(recs, test_pairs):
    curve = {r["k"]: r["precision"] for r in quality.precision_curve(recs, test_pairs, [1, 2, 3, 10]).collect()}
    assert curve[1] == pytest.approx((1 / 1 + 0) / 2)
    assert curve[2] == pytest.approx((1 / 2 + 0) / 2)
    assert curve[3] == curve[10] == pytest.approx((2 / 3 + 0) / 2)
    assert quality.precision_at_k(recs, test_pairs, 3).first()["precision"] == curve[3]


def test_precision_without_tested_users_is_zero(recs, test_pairs):
    assert quality.precision_at_k(recs.where("userId = 3"), test_pairs, 5).first()["precision"] == 0.0
    assert quality.precision_at_k(recs.where("userId = 77"), test_pairs, 5).first()["precision"] == 0.0


def test_hits(recs, test_pairs, rows_of):
    assert rows_of(joins.recommendation_hits(recs, test_pairs, 2)) == [(1, 10)]
    assert rows_of(joins.recommendation_hits(recs, test_pairs, 3)) == [(1, 10), (1, 12)]


def test_errors(spark):
    preds = spark.createDataFrame([(3.0, 1.0), (1.0, 2.0)], "rating DOUBLE, prediction DOUBLE")
    row = quality.prediction_errors(preds).first()
    assert row["rmse"] == pytest.approx(2.5**0.5) and row["mae"] == 1.5 and row["n_pairs"] == 2
    assert quality.mae(preds).first()["mae"] == 1.5


def test_title_join_left_keeps_and_inner_drops(spark, rows_of):
    recs = spark.createDataFrame([(1, 10, 2.0), (1, 11, 1.0)], "userId INT, movieId INT, prediction DOUBLE")
    movies = spark.createDataFrame([(10, "A", "Drama")], "movieId INT, title STRING, genres STRING")
    assert rows_of(joins.enrich_titles(recs, movies)) == [(1, 10, 2.0, "A", "Drama"), (1, 11, 1.0, None, None)]
    assert rows_of(joins.enrich_titles(recs, movies, "inner")) == [(1, 10, 2.0, "A", "Drama")]
    with pytest.raises(ValueError):
        joins.enrich_titles(recs, movies, "outer")


def test_popularity_lookup_ignores_items_without_count(ratings_of, spark):
    source = ratings_of([(1, 10, 1.0, 1), (2, 10, 1.0, 1), (1, 11, 1.0, 1)])
    counts = spark.createDataFrame([(10, 7), (12, 9)], "movieId INT, count BIGINT")
    assert tuple(joins.popularity_lookup(source, counts).first()) == (2, 14)
    assert tuple(joins.popularity_lookup(source.where("movieId = 11"), counts).first()) == (0, 0)


def test_candidate_counts_equal_the_real_product(ratings_of):
    source = ratings_of([(1, 10, 1.0, 1), (1, 10, 2.0, 2), (2, 11, 1.0, 1), (3, 12, 1.0, 1), (3, 10, 1.0, 1)])
    users, items = source.select("userId").distinct(), source.select("movieId").distinct()
    product = users.crossJoin(items)
    left = product.join(source, ["userId", "movieId"], "left_anti").groupBy("userId").count()
    expected = {r["userId"]: r["count"] for r in left.collect()}
    found = joins.candidate_counts(source).collect()
    assert {r["userId"]: r["unrated_pairs"] for r in found} == expected
    assert {r["all_pairs"] for r in found} == {3}


def test_partition_counts_show_empty_partitions(spark):
    frame = spark.range(3).repartition(1).repartition(8, "id")
    found = stats.partition_counts(frame)
    assert found.count() == 8 and found.agg(F.sum("records")).first()[0] == 3
    assert found.where("records = 0").count() >= 5


def test_partition_plan_rules(spark):
    plan = layout.partition_plan(spark.range(1_000_000), 9, 8, row_bytes=25, target_mb=1).first()
    assert plan["planned_partitions"] == 23 and plan["repartition"]
    near = layout.partition_plan(spark.range(1_000_000), 20, 8, row_bytes=25, target_mb=1).first()
    assert not near["repartition"]
    tiny = layout.partition_plan(spark.range(10), 1, 4).first()
    assert tiny["planned_partitions"] == 4 and tiny["repartition"]


def test_plan_partitions_leaves_a_good_layout_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    good = spark.range(100).repartition(cores)
    assert layout.plan_partitions(good) is good
    assert layout.plan_partitions(spark.range(100).repartition(1)).rdd.getNumPartitions() == cores


def test_scaling_report(spark):
    runs = spark.createDataFrame(
        [(0.1, 100, 2.0, 10.0, 15.0), (0.5, 500, 5.0, 15.0, 15.5), (1.0, 0, 4.0, 1.0, 1.0)],
        "fraction DOUBLE, sample_size BIGINT, training_time DOUBLE, memory_before_mb DOUBLE, memory_after_mb DOUBLE",
    )
    rows = reports.scaling_report(runs).orderBy("fraction").collect()
    assert [r["time_per_rating"] for r in rows] == [0.02, 0.01, 0.0]
    assert [r["linear_time"] for r in rows] == [2.0, 10.0, 0.0]
    assert [r["speedup"] for r in rows] == [1.0, 2.0, 0.0]
    assert [r["memory_increase_mb"] for r in rows] == [5.0, 0.5, 0.0]


def test_scaling_report_without_a_usable_base(spark):
    runs = spark.createDataFrame([(0.1, 0, 1.0), (1.0, 5, 2.0)], "fraction DOUBLE, sample_size BIGINT, training_time DOUBLE")
    assert {r["speedup"] for r in reports.scaling_report(runs).collect()} == {None}


@pytest.fixture
def run_log(spark):
    rows = [("1m", "a", 4.0, 0.9, 0.7), ("1m", "b", 2.0, 1.0, 0.6), ("10m", "a", 8.0, 0.8, 0.6), ("25m", "a", 1.0, 1.0, 1.0),
            ("25m", "b", 0.0, 1.0, 1.0)]
    return spark.createDataFrame(rows, "size STRING, implementation STRING, training_time DOUBLE, rmse DOUBLE, mae DOUBLE")


def test_speedup_needs_both_implementations(run_log, rows_of):
    assert rows_of(reports.speedup_report(run_log, "a", "b")) == [("1m", 2.0), ("25m", None)]


def test_repeated_runs_are_refused(run_log):
    with pytest.raises(Exception, match="several runs"):
        reports.speedup_report(run_log.union(run_log), "a", "b").collect()


def test_one_missing_metric_hides_no_other(run_log):
    half = run_log.withColumn("rmse", F.when(F.col("implementation") == "a", F.col("rmse")))
    row = reports.speedup_report(half, "a", "b", ["training_time", "rmse"]).where("size = '1m'").first()
    assert (row["training_time_speedup"], row["rmse_speedup"]) == (2.0, None)


def test_accuracy_differences(run_log):
    row = reports.accuracy_report(run_log, "a", "b").where("size = '1m'").first()
    assert row["rmse_difference"] == pytest.approx(0.1) and row["mae_difference"] == pytest.approx(0.1)


def test_melt(run_log):
    long = reports.melt_metrics(run_log, ["size", "implementation"], ["rmse", "mae"])
    assert long.count() == 10 and set(long.columns) == {"size", "implementation", "metric", "value"}


def test_summary_has_null_for_missing_metrics(spark):
    nested = spark.createDataFrame(
        [("1m", {"spark": {"rmse": 0.9, "training_time": 1.0}, "other": {"total_time": 2.0}})],
        "size STRING, implementations MAP<STRING, MAP<STRING, DOUBLE>>",
    )
    rows = {r["implementation"]: r for r in reports.summary_table(nested).collect()}
    assert rows["spark"]["rmse"] == 0.9 and rows["spark"]["total_time"] is None
    assert rows["other"]["total_time"] == 2.0 and rows["other"]["rmse"] is None


def test_popularity_of_very_hot_items(spark):
    counts = spark.createDataFrame([(1, 9_000_000_000_000_000_000)], "movieId INT, count BIGINT")
    ratings = spark.range(3).select(F.lit(1).alias("movieId"))
    assert int(joins.popularity_lookup(ratings, counts).first()["lookup_total"]) == 27 * 10**18


def test_precision_of_filtered_ranks(spark):
    recs = spark.createDataFrame([(1, 10, 4), (1, 11, 6), (2, 10, 9)], "userId INT, movieId INT, rank INT")
    test = spark.createDataFrame([(1, 11), (2, 10)], "userId INT, movieId INT")
    assert quality.precision_at_k(recs, test, 2).first()["precision"] == 0.75
