"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the threads.
Every query is run to its last row by a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.plans import model as models
from starloom.plans.evaluate import evaluate
from starloom.plans.mllib_als import train_als
from starloom.plans.plain_als import train_plain_als
from starloom.plans.recommend import recommend_all_users, recommend_excluding_rated
from starloom.session import scratch_path
from workload import registry, views

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

REGISTERED = [
    "preprocess", "read_dataset_1m", "clean_ratings", "genres_from_flags", "dedupe_last",
    "split_bernoulli", "split_exact", "sample_ladder", "known_pairs", "encode_ids", "all_pairs",
    "score_pairs", "dataset_stats", "split_report", "profile_ratings", "popularity_lookup", "gram",
    "rmse_mae", "precision_curve", "top_n_per_user_rank", "recommend_excluding_rated_rank",
    "recommend_all_users", "similar_items", "predict_zero", "evaluate", "als_half_step_user",
    "als_half_step_item", "train_rmse_history", "scaling_report",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("starloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    seconds: dict[str, float] = {}

    def timed(name: str, run: Callable[[], object]) -> object:
        began = time.monotonic()
        result = run()
        if isinstance(result, DataFrame):
            drain(result)
        seconds[name] = round(time.monotonic() - began, 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
        return result

    drain(views.ratings(spark, SF_DIR))  # JVM and file cache warm-up
    drain(spark.range(8).mapInArrow(lambda batches: batches, "id long"))  # Python workers

    for name in REGISTERED:
        timed(name, lambda: registry.QUERIES[name](spark, SF_DIR))

    # The training pipeline on a stored split, at the default settings: rank 10, 10 iterations.
    folder = scratch_path(spark, "bench")
    train, test = views.train_test(views.ratings(spark, SF_DIR))
    train.write.parquet(f"{folder}/train")
    test.write.parquet(f"{folder}/test")
    train, test = (spark.read.parquet(f"{folder}/{part}") for part in ("train", "test"))
    model = models.from_mllib(timed("train_als_10x10", lambda: train_als(train)))
    timed("evaluate_trained", lambda: evaluate(model, test))
    timed("recommend_trained_unseen", lambda: recommend_excluding_rated(model, train, 10))
    timed("recommend_trained_all", lambda: recommend_all_users(model, 10))
    timed("train_als_implicit_10x10", lambda: train_als(train, implicit=True))
    timed("train_plain_als_10x5", lambda: train_plain_als(train, max_iter=5, track_rmse=False))

    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
