"""Physical plans: no cross products, pruned and filtered scans, limits before shuffles."""

import re
import time

import pytest
from pyspark.sql import functions as F

from starloom.operators import joins, ranking, splits, stats
from starloom.plans.model import FactorModel, predict
from starloom.session import FREE_SHUFFLES, cut_lineage
from workload import registry, views


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


LAZY = sorted(
    name for name in registry.QUERIES
    if name not in {"tune", "tune_stacked", "scaling_test", "train_als", "train_als_implicit", "save_load_mllib",
                    "train_plain_als", "train_plain_als_rank10", "train_rmse_history", "train_plain_implicit", "train_implicit_history", "recommend_wide_ids", "recommend_trained"}
)


@pytest.mark.parametrize("name", LAZY)
def test_no_query_has_a_cross_product(spark, sf_dir, name):
    plan = plan_of(registry.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["recommend_trained", "train_als"])
def test_trained_queries_join_their_ratings_once(spark, sf_dir, name):
    """Every step after the first reads the written ratings; before, each joined the two tables again."""
    assert "lineitem" not in plan_of(registry.QUERIES[name](spark, sf_dir))


def test_id_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_of(splits.filter_by_id(views.table(spark, sf_dir, "part"), "p_partkey", 5))
    assert re.search(r"PushedFilters: \[.*EqualTo\(p_partkey,5\)", plan)


def test_statistics_read_only_their_columns(spark, sf_dir):
    plan = plan_of(stats.item_popularity(views.ratings(spark, sf_dir)))
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan and "l_quantity" not in plan


def test_statistics_scan_once(spark, sf_dir):
    plan = plan_of(stats.dataset_stats(views.table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS userId", "l_partkey AS movieId")))
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("ties", ["rank", "row"])
def test_top_n_limits_each_group_before_the_shuffle(spark, ties):
    preds = spark.range(1000).selectExpr("CAST(id % 7 AS INT) userId", "CAST(id AS INT) movieId", "id / 3 prediction")
    plan = plan_of(ranking.top_n_per_user(preds, 3, ties))
    below_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_single_user_top_n_is_a_distributed_limit(spark):
    preds = spark.range(1000).selectExpr("CAST(id % 7 AS INT) userId", "CAST(id AS INT) movieId", "id / 3 prediction")
    assert "TakeOrderedAndProject" in plan_of(ranking.top_n_for_user(preds, 3, 5))


def test_splits_and_samples_do_not_shuffle(spark, sf_dir):
    table = views.table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS userId", "l_partkey AS movieId")
    for frame in (*splits.split_bernoulli(table), splits.sample_fraction(table, 0.3), splits.kfold_assign(table)):
        assert "Exchange" not in plan_of(frame)


def test_normal_equations_combine_before_the_shuffle(spark):
    rows = spark.range(100).select(
        (F.col("id") % 5).alias("userId"), F.lit(1.0).alias("rating"), F.array(F.lit(1.0), F.lit(2.0)).alias("features"))
    assert "partial_sum" in plan_of(stats.gram(rows, "userId", 2)).split("Exchange")[1]


def test_factor_tables_of_known_size_are_broadcast(spark, sf_dir):
    source = views.ratings(spark, sf_dir)
    given = registry.given_model(source)
    model = FactorModel(given.users, given.items, 2, n_users=150, n_items=200)
    assert "SortMergeJoin" in plan_of(predict(given, source))
    assert "SortMergeJoin" not in plan_of(predict(model, source))


def test_no_job_runs_while_a_join_is_planned(spark, sf_dir):
    source, movies = views.ratings(spark, sf_dir), views.movies(spark, sf_dir)
    model = registry.given_model(source)
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        predict(model, source)
        splits.known_pairs(source, source)
        joins.enrich_titles(source, movies)
        assert not status.getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_materialised_step_leaves_no_shuffle_files(spark):
    """Before, the files of every half step stayed until the driver collected garbage."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: disk.getAllFiles().mkString(" ").count("shuffle_")
    rows, before = spark.range(10_000).withColumn("k", F.col("id") % 100), held()
    sums = cut_lineage(rows.groupBy("k").agg(F.sum("id").alias("s")))
    until = time.monotonic() + 10
    while held() > before and time.monotonic() < until:
        time.sleep(0.2)
    assert held() <= before and sums.count() == 100
    assert spark.conf.get(FREE_SHUFFLES) == "false"
