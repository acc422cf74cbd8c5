"""The preparation job: raw dump to cleaned, split and training-ready tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.cleaning import clean_movies, clean_ratings, clean_users
from ..operators.splits import split_exact
from ..operators.stats import split_report
from ..schemas import GENRE_NAMES
from ..sources.raw import DATASET_SIZES, dataset_folder, read_dataset
from ..sources.sinks import write_csv, write_id_mappings, write_parquet, write_training_triples


WRITERS = 4  # jobs submitted together


def together(spark: SparkSession, jobs: Sequence[Callable[[], None]]) -> None:
    """Run independent jobs; the first failure is raised after all have ended."""
    inherit = inheritable_thread_target(spark)
    with ThreadPool(WRITERS) as pool:
        running = [pool.apply_async(inherit(job)) for job in jobs]
        for result in running:
            result.wait()
        for result in running:
            result.get()


def preprocess(
    spark: SparkSession,
    root: str,
    size: str,
    out: str,
    test_size: float = 0.2,
    seed: int = 42,
    names: Sequence[str] = GENRE_NAMES,
) -> DataFrame:
    """Prepare one dataset below ``out/<size>`` and return its one-row report.

    The report counts the rating rows that were read, kept and dropped as unreadable; they are
    counted while the cleaned ratings are written. ``names`` are the genre names of a dump whose
    genres come as flags.

    The raw text is parsed once, into Parquet. The split and every other output read that Parquet.
    Outputs that don't depend on each other are jobs submitted together, so that the tail of one
    leaves no executor idle.
    """
    base = f"{out.rstrip('/')}/{size}"
    tables = f"{base}/tables"
    ratings, movies, users = read_dataset(spark, root, size)
    read = Observation()
    cleaned = {
        "ratings": clean_ratings(ratings.observe(read, F.count("*").alias("rows_read"))),
        "movies": clean_movies(movies, names),
        "users": clean_users(users),
    }
    stored: dict[str, DataFrame] = {}

    def store(name: str, table: DataFrame) -> None:
        write_parquet(table, f"{tables}/{name}.parquet")
        stored[name] = spark.read.parquet(f"{tables}/{name}.parquet")

    together(spark, [partial(store, name, table) for name, table in cleaned.items()])
    rows_read = read.get["rows_read"]
    train, test = split_exact(stored["ratings"], test_size, seed)
    together(spark, [partial(store, name, part) for name, part in {"train_ratings": train, "test_ratings": test}.items()])

    copies = {f"interim/cleaned_{name}": name for name in cleaned}
    copies |= {f"interim/{name}": name for name in ("train_ratings", "test_ratings")}
    copies |= {"processed/train": "train_ratings", "processed/test": "test_ratings"}
    copies |= {"processed/movies": "movies", "processed/users": "users"}
    together(
        spark,
        [partial(write_csv, stored[source], f"{base}/{path}.csv") for path, source in copies.items()]
        + [
            partial(write_training_triples, stored[name], f"{base}/triples/{name}.parquet")
            for name in ("ratings", "train_ratings", "test_ratings")
        ]
        + [partial(write_id_mappings, stored["movies"], stored["users"], f"{base}/mappings")]
    )
    report = split_report(
        stored["train_ratings"], stored["test_ratings"], stored["users"], stored["movies"]
    )
    rows_read = F.lit(rows_read).cast("bigint")
    return report.select(
        "*", rows_read.alias("rows_read"), F.col("total_ratings").alias("rows_kept"),
        (rows_read - F.col("total_ratings")).alias("rows_dropped"),
    )


def available_sizes(spark: SparkSession, root: str) -> list[str]:
    """Sizes whose raw folder exists, under any of its folder names."""

    def there(size: str) -> bool:
        try:
            return bool(dataset_folder(spark, root, size))
        except FileNotFoundError:
            return False

    return [size for size in DATASET_SIZES if there(size)]


def preprocess_all(
    spark: SparkSession,
    root: str,
    out: str,
    sizes: Iterable[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    names: Sequence[str] = GENRE_NAMES,
) -> DataFrame:
    """(size, succeeded, message) for each size; one failing size does not stop the others."""
    outcomes = []
    for size in available_sizes(spark, root) if sizes is None else sizes:
        try:
            preprocess(spark, root, size, out, test_size, seed, names)
            outcomes.append((size, True, None))
        except Exception as failure:  # the outcome of each size is part of the result
            outcomes.append((size, False, str(failure).split("\n")[0]))
    return spark.createDataFrame(outcomes, "size STRING, succeeded BOOLEAN, message STRING")
