"""Every query with, where SQL can express it, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.operators import (
    cleaning, ids, joins, layout, quality, ranking, reports, splits, stats,
)
from starloom.operators.skew import hot_keys, skew_join
from starloom.plans import evaluate as evaluation
from starloom.plans import model as models
from starloom.plans import plain_als, preparation, recommend, runs
from starloom.plans.mllib_als import fit_factors, train_als
from starloom.plans.model import FactorModel
from starloom.recommender import Recommender
from starloom.schemas import GENRE_NAMES
from starloom.session import scratch_path
from starloom import sources

from . import dumps, views
from .views import sql_bucket, sql_share, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RATING = '"userId", "movieId", rating, timestamp'


def query(name: str, sql: str | None = None, needs: str = "", extra: dict[str, str] | None = None):
    """Register a query and, when given, its SQL on top of the views it needs."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = with_views(needs, sql, extra)
        return function

    return register


def r6(c: Column | str, name: str | None = None) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column, 6).alias(name or c)


def given_model(source: DataFrame) -> FactorModel:
    """The rank-2 factor tables that both engines can compute."""
    return FactorModel(views.user_factors(source), views.item_factors(source), 2)


def flat(factors: DataFrame) -> DataFrame:
    features = F.col("features")
    return factors.select("id", r6(features[0], "f0"), r6(features[1], "f1"))


def rounded(preds: DataFrame) -> DataFrame:
    return preds.select("userId", "movieId", r6("prediction"))


PREDICTED = 'SELECT "userId", "movieId", round(prediction, 6) AS prediction FROM'


# ---- Sources -----------------------------------------------------------------------------------

def _ratings_reader(fmt: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = dumps.write_ratings(spark, sf_dir, fmt, scratch_path(spark, f"ratings-{fmt}"))
        return sources.read_ratings(spark, path, fmt)

    return run


for _fmt in ("tsv", "dat", "csv"):
    query(f"read_ratings_{_fmt}", f"SELECT {RATING} FROM ratings", "ratings")(_ratings_reader(_fmt))

GENRES_SQL = (
    "concat_ws('|', "
    + ", ".join(f"CASE WHEN genre_{i} = 1 THEN '{n}' END" for i, n in enumerate(GENRE_NAMES))
    + ")"
)
TITLE_CSV_SQL = "title || ', \"the ' || \"movieId\" || '\"'"


@query("read_movies_u_item", f'SELECT "movieId", title, {GENRES_SQL} AS genres FROM movies_flags', "movies_flags")
def read_movies_u_item(spark, sf_dir):
    path = dumps.write_movies(spark, sf_dir, "u_item", scratch_path(spark, "u.item"))
    return cleaning.clean_movies(sources.read_movies(spark, path, "u_item"))


@query("read_movies_dat", 'SELECT "movieId", title, genres FROM movies', "movies")
def read_movies_dat(spark, sf_dir):
    path = dumps.write_movies(spark, sf_dir, "dat", scratch_path(spark, "movies.dat"))
    return sources.read_movies(spark, path, "dat")


@query("read_movies_csv", f'SELECT "movieId", {TITLE_CSV_SQL} AS title, genres FROM movies', "movies")
def read_movies_csv(spark, sf_dir):
    path = dumps.write_movies(spark, sf_dir, "csv", scratch_path(spark, "movies.csv"))
    return sources.read_movies(spark, path, "csv")


@query("read_users_u_user", 'SELECT "userId", age, gender, occupation, zip_code FROM users', "users")
def read_users_u_user(spark, sf_dir):
    path = dumps.write_users(spark, sf_dir, "u_user", scratch_path(spark, "u.user"))
    return sources.read_users(spark, path, "u_user")


@query(
    "read_users_dat",
    'SELECT "userId", age, gender, length(occupation)::INT AS occupation, zip_code FROM users',
    "users",
)
def read_users_dat(spark, sf_dir):
    path = dumps.write_users(spark, sf_dir, "dat", scratch_path(spark, "users.dat"))
    return sources.read_users(spark, path, "dat")


def _dataset(size: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = dumps.write_dump(spark, sf_dir, size)
        ratings, movies, users = sources.read_dataset(spark, root, size)
        movies, users = cleaning.clean_movies(movies), cleaning.clean_users(users)
        return ratings.join(movies, "movieId").join(users, "userId").select(
            "userId", "movieId", "rating", "timestamp", "title", "genres", "gender", "age"
        )

    return run


def _dataset_sql(size: str) -> str:
    title = TITLE_CSV_SQL if size == "25m" else "title"
    genres = GENRES_SQL if size == "100k" else "genres"
    details = "gender, age" if size in ("100k", "1m") else "'unknown' AS gender, -1 AS age"
    movies = "movies_flags" if size == "100k" else "movies"
    return (
        f"SELECT {RATING}, {title} AS title, {genres} AS genres, {details} FROM ratings "
        f'JOIN {movies} USING ("movieId") JOIN users USING ("userId")'
    )


for _size in sources.DATASET_SIZES:
    query(f"read_dataset_{_size}", _dataset_sql(_size), "ratings movies_flags users")(_dataset(_size))

PARTS_SQL = (
    f"SELECT 'train' AS part, {RATING} FROM train UNION ALL SELECT 'test', {RATING} FROM test"
)


def _parts(train: DataFrame, test: DataFrame) -> DataFrame:
    train = train.withColumn("part", F.lit("train"))
    return train.unionByName(test.withColumn("part", F.lit("test")))


def _split_reader(fmt: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_path(spark, "split")
        write = sources.write_parquet if fmt == "parquet" else sources.write_csv
        train, test = views.train_test(views.ratings(spark, sf_dir))
        write(train, f"{folder}/train_ratings.{fmt}")
        write(test, f"{folder}/test_ratings.{fmt}")
        return _parts(*sources.read_split(spark, folder, fmt))

    return run


for _fmt in ("parquet", "csv"):
    query(f"read_split_{_fmt}", PARTS_SQL, "train test")(_split_reader(_fmt))

RUN_COLUMNS = "size, implementation, sample_size, training_time, total_time, rmse, mae"


@query("read_metrics", f"SELECT {RUN_COLUMNS} FROM run_metrics", "run_metrics")
def read_metrics(spark, sf_dir):
    """One pretty-printed JSON object per run folder, plus a path that does not exist."""
    runs_table = views.run_metrics(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    text = F.to_json(F.struct(*runs_table.columns), {"pretty": "true"})
    runs_table.select(
        text.alias("value"), F.col("size").alias("p_size"), F.col("implementation").alias("p_impl")
    ).write.partitionBy("p_size", "p_impl").text(path)
    missing = scratch_path(spark, "absent")
    return sources.read_metrics(spark, [path, missing], runs_table.schema).select(
        runs_table.columns
    )


@query("read_recommendations", f"{PREDICTED} recs", "recs")
def read_recommendations(spark, sf_dir):
    path = scratch_path(spark, "recommendations")
    sources.write_csv(_unseen(spark, sf_dir, "row"), path)
    return rounded(sources.read_recommendations(spark, path))


@query("ids_frame", f'SELECT {RATING} FROM ratings WHERE "userId" IN (7, 42, 100)', "ratings")
def ids_frame(spark, sf_dir):
    """Ratings of chosen users."""
    wanted = sources.ids_frame(spark, [7, 42, 100], "userId")
    return views.ratings(spark, sf_dir).join(wanted, "userId", "left_semi")


# ---- Sinks -------------------------------------------------------------------------------------

@query("write_csv", f"SELECT {RATING} FROM ratings", "ratings")
def write_csv(spark, sf_dir):
    table = views.ratings(spark, sf_dir)
    path = scratch_path(spark, "csv")
    sources.write_csv(table, path)
    return spark.read.csv(path, schema=table.schema, header=True)


@query("write_parquet", f"SELECT {RATING} FROM ratings", "ratings")
def write_parquet(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    sources.write_parquet(views.ratings(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("write_metrics", f"SELECT {RUN_COLUMNS} FROM run_metrics", "run_metrics")
def write_metrics(spark, sf_dir):
    table = views.run_metrics(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    sources.write_metrics(table, path)
    return sources.read_metrics(spark, [path], table.schema, lines=True)


@query("write_training_triples", 'SELECT "userId", "movieId", rating FROM ratings', "ratings")
def write_training_triples(spark, sf_dir):
    path = scratch_path(spark, "triples")
    sources.write_training_triples(views.ratings(spark, sf_dir), path)
    return spark.read.parquet(path)


@query(
    "write_id_mappings",
    "SELECT 'movie' AS kind, \"movieId\" AS id, title FROM movies"
    " UNION ALL SELECT 'user', \"userId\", NULL FROM users",
    "movies users",
)
def write_id_mappings(spark, sf_dir):
    folder = scratch_path(spark, "mappings")
    sources.write_id_mappings(views.movies(spark, sf_dir), views.users(spark, sf_dir), folder)
    movies = spark.read.csv(f"{folder}/movie_mapping", header=True, schema="id BIGINT, title STRING")
    users = spark.read.csv(f"{folder}/user_mapping", header=True, schema="id BIGINT")
    return movies.select(F.lit("movie").alias("kind"), "id", "title").unionByName(
        users.select(F.lit("user").alias("kind"), "id", F.lit(None).cast("string").alias("title"))
    )


@query(
    "save_load_factors",
    "SELECT 'user' AS side, id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM uf"
    " UNION ALL SELECT 'item', id, round(f0, 6), round(f1, 6) FROM vf",
    "uf vf",
)
def save_load_factors(spark, sf_dir):
    path = scratch_path(spark, "factors")
    models.save_factors(given_model(views.ratings(spark, sf_dir)), path)
    loaded = models.load_factors(spark, path)
    users = flat(loaded.users).select(F.lit("user").alias("side"), "id", "f0", "f1")
    return users.unionByName(flat(loaded.items).select(F.lit("item").alias("side"), "id", "f0", "f1"))


EXACT_PARTS = {
    "ordered": f"""SELECT {RATING}, row_number() OVER (ORDER BY md5('42:' || "userId" || ':' || "movieId"
        || ':' || rating || ':' || timestamp), {RATING}) AS pos, count(*) OVER () AS total FROM ratings""",
    "parted": f"""SELECT {RATING}, CASE WHEN pos <= ceil(0.2 * total) THEN 'test' ELSE 'train' END AS part
        FROM ordered""",
}
REPORT_SQL = """SELECT (SELECT count(DISTINCT "userId") FROM users) AS total_users,
    (SELECT count(DISTINCT "movieId") FROM movies) AS total_movies,
    (SELECT count(*) FROM {train}) + (SELECT count(*) FROM {test}) AS total_ratings,
    (SELECT count(*) FROM {train}) AS train_count, (SELECT count(*) FROM {test}) AS test_count,
    round((SELECT avg(rating) FROM {train}), 6) AS mean_rating"""
REPORT_COLUMNS = ["total_users", "total_movies", "total_ratings", "train_count", "test_count"]
EXACT_TRAIN, EXACT_TEST = (f"(SELECT * FROM parted WHERE part = '{p}')" for p in ("train", "test"))


@query(
    "preprocess",
    REPORT_SQL.format(train=EXACT_TRAIN, test=EXACT_TEST)
    + ", (SELECT count(*) FROM ratings) AS rows_read, (SELECT count(*) FROM parted) AS rows_kept,"
    " (SELECT count(*) FROM ratings) - (SELECT count(*) FROM parted) AS rows_dropped",
    "ratings movies users",
    EXACT_PARTS,
)
def preprocess(spark, sf_dir):
    root = dumps.write_dump(spark, sf_dir, "1m")
    report = preparation.preprocess(spark, root, "1m", scratch_path(spark, "prepared"))
    counts = ["rows_read", "rows_kept", "rows_dropped"]
    return report.select(*REPORT_COLUMNS, r6("mean_rating"), *counts)


# ---- Cleaning, splits, samples -----------------------------------------------------------------

@query("clean_movies", 'SELECT "movieId", title, genres FROM movies', "movies")
def clean_movies(spark, sf_dir):
    return cleaning.clean_movies(views.movies(spark, sf_dir).withColumn("extra", F.lit(1)))


@query("genres_from_flags", f'SELECT "movieId", title, {GENRES_SQL} AS genres FROM movies_flags', "movies_flags")
def genres_from_flags(spark, sf_dir):
    return cleaning.genres_from_flags(views.movies_flags(spark, sf_dir))


@query("clean_users", 'SELECT "userId", gender, age FROM users', "users")
def clean_users(spark, sf_dir):
    return cleaning.clean_users(views.users(spark, sf_dir))


@query(
    "synthesize_users",
    "SELECT DISTINCT \"userId\", 'unknown' AS gender, -1 AS age FROM ratings",
    "ratings",
)
def synthesize_users(spark, sf_dir):
    return cleaning.synthesize_users(views.ratings(spark, sf_dir))


DIRTY = {
    "dirty": """SELECT CASE WHEN timestamp % 11 = 0 THEN 'user ' ELSE '' END || "userId" AS "userId",
        "movieId"::VARCHAR AS "movieId",
        CASE WHEN rating = 2.5 THEN 'n/a' WHEN rating = 3.5 THEN NULL ELSE rating::VARCHAR END AS rating,
        timestamp::VARCHAR AS timestamp FROM ratings""",
    "typed": """SELECT try_cast("userId" AS BIGINT) AS "userId", try_cast("movieId" AS BIGINT) AS "movieId",
        try_cast(rating AS DOUBLE) AS rating, try_cast(timestamp AS BIGINT) AS timestamp FROM dirty""",
}
USABLE = '"userId" IS NOT NULL AND "movieId" IS NOT NULL AND rating IS NOT NULL'


def _dirty(spark, sf_dir):
    """Ratings as text, some of it unreadable."""
    prefix = F.when(F.col("timestamp") % 11 == 0, F.lit("user ")).otherwise(F.lit(""))
    rating = (
        F.when(F.col("rating") == 2.5, F.lit("n/a"))
        .when(F.col("rating") == 3.5, F.lit(None))
        .otherwise(F.col("rating").cast("string"))
    )
    return views.ratings(spark, sf_dir).select(
        F.concat(prefix, F.col("userId")).alias("userId"),
        F.col("movieId").cast("string"),
        rating.alias("rating"),
        F.col("timestamp").cast("string"),
    )


@query("clean_ratings", f"SELECT {RATING} FROM typed WHERE {USABLE}", "ratings", DIRTY)
def clean_ratings(spark, sf_dir):
    return cleaning.clean_ratings(_dirty(spark, sf_dir))


@query(
    "cleaning_report",
    f"SELECT count(*) AS rows_read, count(*) FILTER (WHERE {USABLE}) AS rows_kept,"
    f" count(*) FILTER (WHERE NOT ({USABLE})) AS rows_dropped FROM typed",
    "ratings",
    DIRTY,
)
def cleaning_report(spark, sf_dir):
    return cleaning.cleaning_report(_dirty(spark, sf_dir))


@query(
    "observed_only",
    'SELECT "userId", "movieId", rating - 1 AS rating FROM ratings WHERE rating - 1 > 0',
    "ratings",
)
def observed_only(spark, sf_dir):
    """Ratings shifted by one star, so that some stand for "not rated"."""
    shifted = views.ratings(spark, sf_dir).select(
        "userId", "movieId", (F.col("rating") - 1).alias("rating")
    )
    return cleaning.observed_only(shifted)


LAST = {
    "last_rating": f"""SELECT {RATING} FROM (SELECT *, row_number() OVER (PARTITION BY "userId", "movieId"
        ORDER BY timestamp DESC, rating DESC) AS pos FROM ratings) WHERE pos = 1"""
}


@query("dedupe_last", f"SELECT {RATING} FROM last_rating", "ratings", LAST)
def dedupe_last(spark, sf_dir):
    return cleaning.dedupe_last(views.ratings(spark, sf_dir))


@query("split_bernoulli", PARTS_SQL, "train test")
def split_bernoulli(spark, sf_dir):
    return _parts(*splits.split_bernoulli(views.ratings(spark, sf_dir), 0.8))


@query("split_exact", f"SELECT part, {RATING} FROM parted", "ratings", EXACT_PARTS)
def split_exact(spark, sf_dir):
    return _parts(*splits.split_exact(views.ratings(spark, sf_dir), 0.2, seed=42))


@query(
    "sample_fraction", f"SELECT {RATING} FROM ratings WHERE {sql_share(0.25, 'sample', 42)}", "ratings"
)
def sample_fraction(spark, sf_dir):
    return splits.sample_fraction(views.ratings(spark, sf_dir), 0.25)


@query(
    "sample_ladder",
    " UNION ALL ".join(
        f"SELECT {f}::DOUBLE AS fraction, count(*) AS sample_size FROM ratings"
        f" WHERE {sql_share(min(f, 1.0), 'sample', 42)}"
        for f in splits.DEFAULT_FRACTIONS
    ),
    "ratings",
)
def sample_ladder(spark, sf_dir):
    return splits.sample_ladder_counts(views.ratings(spark, sf_dir))


@query(
    "sample_n",
    'SELECT "movieId", title, genres FROM movies ORDER BY md5("movieId"::VARCHAR), "movieId" LIMIT 10',
    "movies",
)
def sample_n(spark, sf_dir):
    return splits.sample_n(views.movies(spark, sf_dir), 10, "movieId")


@query("filter_by_id", 'SELECT "movieId", title, genres FROM movies WHERE "movieId" = 50', "movies")
def filter_by_id(spark, sf_dir):
    return splits.filter_by_id(views.movies(spark, sf_dir), "movieId", 50)


@query(
    "known_pairs",
    f"""SELECT {RATING} FROM held WHERE "userId" IN (SELECT "userId" FROM early)
        AND "movieId" IN (SELECT "movieId" FROM early)""",
    "ratings",
    {
        "early": "SELECT * FROM ratings WHERE rating >= 4.5",
        "held": "SELECT * FROM ratings WHERE rating < 4.5",
    },
)
def known_pairs(spark, sf_dir):
    """Train on the high ratings only, so that some users and items are unknown."""
    source = views.ratings(spark, sf_dir)
    high = F.col("rating") >= 4.5
    return splits.known_pairs(source.where(~high), source.where(high))


WIDE = 5_000_000_000


@query(
    "clean_wide_ids",
    f'SELECT "userId" + {WIDE} AS "userId", "movieId" + {WIDE} AS "movieId", rating, timestamp FROM ratings',
    "ratings",
)
def clean_wide_ids(spark, sf_dir):
    """Ids beyond 32 bits survive cleaning, given as numbers or as text."""
    source = views.ratings(spark, sf_dir)
    wide = source.withColumns({c: F.col(c) + F.lit(WIDE) for c in ("userId", "movieId")})
    return cleaning.clean_ratings(wide.withColumn("userId", F.col("userId").cast("string")))


@query(
    "sample_then_fold",
    f"SELECT ({sql_bucket('fold', 42)} % 5)::INT AS fold, count(*) AS n FROM ratings"
    f" WHERE {sql_share(0.01, 'sample', 42)} GROUP BY 1",
    "ratings",
)
def sample_then_fold(spark, sf_dir):
    """Folds of a 1 % sample drawn with the same seed."""
    sample = splits.sample_fraction(views.ratings(spark, sf_dir), 0.01, 42)
    return splits.kfold_assign(sample, 5, 42).groupBy("fold").agg(F.count("*").alias("n"))


@query(
    "sample_then_split",
    f"SELECT CASE WHEN {sql_share(0.8, 'split', 42)} THEN 'train' ELSE 'test' END AS part, count(*) AS n"
    f" FROM ratings WHERE {sql_share(0.25, 'sample', 42)} GROUP BY 1",
    "ratings",
)
def sample_then_split(spark, sf_dir):
    """Sizes of a split of a sample drawn with the same seed."""
    sample = splits.sample_fraction(views.ratings(spark, sf_dir), 0.25, 42)
    train, test = splits.split_bernoulli(sample, 0.8, 42)
    return _parts(train, test).groupBy("part").agg(F.count("*").alias("n"))


@query(
    "sample_nested",
    f"SELECT count(*) AS pairs, count(*) FILTER (WHERE NOT {sql_share(0.255, 'sample', 42)}) AS missing"
    f" FROM ratings WHERE {sql_share(0.25, 'sample', 42)}",
    "ratings",
)
def sample_nested(spark, sf_dir):
    """Rows of a 25 % sample, and those of them that a 25.5 % sample lacks."""
    source = views.ratings(spark, sf_dir)
    larger = splits.sample_fraction(source, 0.255).select("userId", "movieId").distinct()
    found = splits.sample_fraction(source, 0.25).join(larger.withColumn("_in", F.lit(1)), ["userId", "movieId"], "left")
    return found.agg(F.count("*").alias("pairs"), F.count_if(F.col("_in").isNull()).alias("missing"))


@query(
    "kfold_assign",
    f"SELECT {RATING}, ({sql_bucket('fold', 42)} % 3)::INT AS fold FROM ratings",
    "ratings",
)
def kfold_assign(spark, sf_dir):
    return splits.kfold_assign(views.ratings(spark, sf_dir), 3, seed=42)


ENCODED = {
    "umap": 'SELECT "userId", row_number() OVER (ORDER BY "userId") - 1 AS uidx FROM (SELECT DISTINCT "userId" FROM ratings)',
    "imap": 'SELECT "movieId", row_number() OVER (ORDER BY "movieId") - 1 AS iidx FROM (SELECT DISTINCT "movieId" FROM ratings)',
}


@query(
    "encode_ids",
    f'SELECT {RATING}, uidx, iidx FROM ratings JOIN umap USING ("userId") JOIN imap USING ("movieId")',
    "ratings",
    ENCODED,
)
def encode_ids(spark, sf_dir):
    source = views.ratings(spark, sf_dir)
    return ids.encode_pairs(source, {"userId": "uidx", "movieId": "iidx"})


@query(
    "encode_string_ids",
    "SELECT 'u' || \"userId\" AS name, rating, row_number() OVER (ORDER BY name) - 1 AS uidx FROM"
    " (SELECT \"userId\", max(rating) AS rating FROM ratings GROUP BY 1)",
    "ratings",
)
def encode_string_ids(spark, sf_dir):
    named = views.ratings(spark, sf_dir).groupBy(F.concat(F.lit("u"), F.col("userId")).alias("name"))
    return ids.encode_ids(named.agg(F.max("rating").alias("rating")), "name", index="uidx")


@query("decode_ids", 'SELECT "movieId", rating FROM ratings', "ratings")
def decode_ids(spark, sf_dir):
    source = views.ratings(spark, sf_dir)
    mapping = ids.id_map(source, "movieId")
    encoded = ids.encode_ids(source, "movieId", mapping).select("idx", "rating")
    return ids.decode_ids(encoded, mapping, "movieId")


# ---- Joins -------------------------------------------------------------------------------------

@query(
    "all_pairs",
    'SELECT "userId", n AS all_pairs, rated_pairs, n - rated_pairs AS unrated_pairs FROM rated, items',
    "ratings",
    {
        "items": 'SELECT count(DISTINCT "movieId") AS n FROM ratings',
        "rated": 'SELECT "userId", count(DISTINCT "movieId") AS rated_pairs FROM ratings GROUP BY 1',
    },
)
def all_pairs(spark, sf_dir):
    return joins.candidate_counts(views.ratings(spark, sf_dir))


@query(
    "exclude_rated",
    f"""{PREDICTED} recs_all WHERE NOT EXISTS (SELECT 1 FROM train WHERE train."userId" = recs_all."userId"
        AND train."movieId" = recs_all."movieId")""",
    "recs_all train",
)
def exclude_rated(spark, sf_dir):
    """Top-10 lists over all items, without the items the user has rated."""
    source = views.ratings(spark, sf_dir)
    train, _ = views.train_test(source)
    return rounded(joins.exclude_rated(recommend.recommend_all_users(given_model(source), 10), train))


TITLED = {"moved": 'SELECT "userId", CASE WHEN "movieId" % 7 = 0 THEN -"movieId" ELSE "movieId" END AS "movieId", prediction FROM recs'}
TITLED_SQL = """SELECT "userId", "movieId", round(prediction, 6) AS prediction, title, genres
    FROM moved {how} JOIN movies USING ("movieId")"""


def _titled(how: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        unknown = F.when(F.col("movieId") % 7 == 0, -F.col("movieId")).otherwise(F.col("movieId"))
        moved = _unseen(spark, sf_dir, "row").withColumn("movieId", unknown)
        recs = joins.enrich_titles(moved, views.movies(spark, sf_dir), how)
        return recs.withColumn("prediction", r6("prediction"))

    return run


for _how in ("left", "inner"):
    query(f"enrich_titles_{_how}", TITLED_SQL.format(how=_how), "recs movies", TITLED)(_titled(_how))


@query(
    "score_pairs",
    """SELECT "userId", "movieId", rating, round(uf.f0 * vf.f0 + uf.f1 * vf.f1, 6) AS prediction
        FROM ratings JOIN uf ON uf.id = "userId" JOIN vf ON vf.id = "movieId" """,
    "ratings uf vf",
)
def score_pairs(spark, sf_dir):
    source = views.ratings(spark, sf_dir)
    pairs = source.select("userId", "movieId", "rating")
    scored = joins.score_pairs(
        pairs, views.user_factors(source), views.item_factors(source), rank=2
    )
    return scored.withColumn("prediction", r6("prediction"))


@query(
    "recommendation_hits",
    """SELECT DISTINCT recs."userId", recs."movieId" FROM recs JOIN test
        ON recs."userId" = test."userId" AND recs."movieId" = test."movieId" WHERE rank <= 5""",
    "recs test",
)
def recommendation_hits(spark, sf_dir):
    _, test = views.train_test(views.ratings(spark, sf_dir))
    return joins.recommendation_hits(ranking.with_rank(_unseen(spark, sf_dir, "row")), test, 5)


@query(
    "popularity_lookup",
    'SELECT count(*)::BIGINT AS hit_rows, sum(n)::DECIMAL(38,0) AS lookup_total FROM test JOIN'
    ' (SELECT "movieId", count(*) AS n FROM train GROUP BY 1) USING ("movieId")',
    "train test",
)
def popularity_lookup(spark, sf_dir):
    train, test = views.train_test(views.ratings(spark, sf_dir))
    return joins.popularity_lookup(test, stats.item_popularity(train))


# ---- Aggregates --------------------------------------------------------------------------------

@query(
    "dataset_stats",
    'SELECT count(*) AS num_ratings, count(DISTINCT "userId") AS num_users,'
    ' count(DISTINCT "movieId") AS num_items FROM ratings',
    "ratings",
)
def dataset_stats(spark, sf_dir):
    return stats.dataset_stats(views.ratings(spark, sf_dir))


@query("item_popularity", 'SELECT "movieId", count(*) AS count FROM ratings GROUP BY 1', "ratings")
def item_popularity(spark, sf_dir):
    return stats.item_popularity(views.ratings(spark, sf_dir))


@query("split_report", REPORT_SQL.format(train="train", test="test"), "train test users movies")
def split_report(spark, sf_dir):
    train, test = views.train_test(views.ratings(spark, sf_dir))
    report = stats.split_report(train, test, views.users(spark, sf_dir), views.movies(spark, sf_dir))
    return report.select(*REPORT_COLUMNS, r6("mean_rating"))


@query(
    "profile_ratings",
    'SELECT count(*) AS num_ratings, round(avg(rating), 6) AS mean_rating,'
    ' count(DISTINCT "userId") AS num_users FROM ratings',
    "ratings",
)
def profile_ratings(spark, sf_dir):
    profile = stats.profile_ratings(views.ratings(spark, sf_dir))
    return profile.select("num_ratings", r6("mean_rating"), "num_users")


@query(
    "partition_counts",
    "SELECT 16 AS partitions, count(*)::BIGINT AS records FROM ratings",
    "ratings",
)
def partition_counts(spark, sf_dir):
    """Partitions reported for 16 of them, empty ones included, and the rows that they hold."""
    counts = stats.partition_counts(views.ratings(spark, sf_dir).repartition(16, "userId"), 16)
    return counts.agg(F.count("*").cast("int").alias("partitions"), F.sum("records").alias("records"))


def _gram_sql(entity: str, other: str, rated: str, factors: str) -> str:
    return f"""SELECT "{entity}" AS id, count(*) AS n, sum(f0 * f0) AS a_0_0, sum(f0 * f1) AS a_0_1,
        sum(f1 * f1) AS a_1_1, sum(rating * f0) AS b_0, sum(rating * f1) AS b_1
        FROM {rated} JOIN {factors} ON id = "{other}" GROUP BY 1"""


def _solve_sql(sums: str, reg: float, scaled: bool) -> str:
    """Cramer's rule for the 2 x 2 systems."""
    ridge = f"({reg}::DOUBLE * n)" if scaled else f"{reg}::DOUBLE"
    a, c = f"(a_0_0 + {ridge})", f"(a_1_1 + {ridge})"
    det = f"({a} * {c} - a_0_1 * a_0_1)"
    return (
        f"SELECT id, (b_0 * {c} - a_0_1 * b_1) / {det} AS f0,"
        f" (b_1 * {a} - a_0_1 * b_0) / {det} AS f1 FROM ({sums})"
    )


FLAT_SQL = "SELECT id, round(f0, 6) + 0.0 AS f0, round(f1, 6) + 0.0 AS f1 FROM"


@query(
    "gram",
    'SELECT id AS "userId", n, '
    + ", ".join(f"round({c}, 6) AS {c}" for c in ("a_0_0", "a_0_1", "a_1_1", "b_0", "b_1"))
    + f" FROM ({_gram_sql('userId', 'movieId', 'ratings', 'vf')})",
    "ratings vf",
)
def gram(spark, sf_dir):
    source = views.ratings(spark, sf_dir)
    factors = views.item_factors(source).withColumnRenamed("id", "movieId")
    hot = hot_keys(source, "movieId")["movieId"]
    sums = stats.gram(skew_join(source, factors, "movieId", hot=hot), "userId", 2)
    return sums.select("userId", "n", *[r6(c) for c in ("a_0_0", "a_0_1", "a_1_1", "b_0", "b_1")])


SCORED_RATINGS = {
    "preds": """SELECT test."userId", test."movieId", rating, uf.f0 * vf.f0 + uf.f1 * vf.f1 AS prediction
        FROM test JOIN uf ON uf.id = "userId" JOIN vf ON vf.id = "movieId" """
}
ERRORS_SQL = """round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) AS rmse,
    round(avg(abs(prediction - rating)), 6) AS mae"""


def _rounded_errors(errors: DataFrame) -> DataFrame:
    return errors.select(r6("rmse"), r6("mae"), "n_pairs")


@query("rmse_mae", f"SELECT {ERRORS_SQL}, count(*) AS n_pairs FROM preds", "uf vf test", SCORED_RATINGS)
def rmse_mae(spark, sf_dir):
    source = views.ratings(spark, sf_dir)
    _, test = views.train_test(source)
    return _rounded_errors(
        quality.prediction_errors(models.predict(given_model(source), test))
    )


PRECISION = {
    "both_recs": "SELECT 'unseen' AS model, * FROM recs UNION ALL SELECT 'all' AS model, * FROM recs_all",
    "ks": "SELECT unnest([1, 3, 5, 10])::INT AS k",
    "hits": """SELECT model, k, "userId", count(*) AS n, count(*) FILTER (WHERE ("userId", "movieId") IN
        (SELECT ("userId", "movieId") FROM test)) AS h
        FROM both_recs JOIN ks ON rank <= k GROUP BY 1, 2, 3""",
    "curve": """SELECT model, k, round(coalesce(avg(h / least(k, n)), 0), 6) AS precision FROM hits
        WHERE "userId" IN (SELECT "userId" FROM test) GROUP BY 1, 2""",
}


@query("precision_curve", "SELECT model, k, precision FROM curve", "recs recs_all test", PRECISION)
def precision_curve(spark, sf_dir):
    source = _written(views.ratings(spark, sf_dir), "ratings")
    test = _written(views.train_test(source)[1], "test")
    unseen = _unseen(spark, sf_dir, "row", source).withColumn("model", F.lit("unseen"))
    every = recommend.recommend_all_users(given_model(source), 10).withColumn("model", F.lit("all"))
    recs = ranking.with_rank(unseen).unionByName(ranking.with_rank(every))
    curve = quality.precision_curve(recs, test, groups=["model"])
    return curve.select("model", "k", r6("precision"))


@query(
    "precision_curve_gaps",
    """SELECT k, round(coalesce(avg(hits / least(k, n)), 0), 6) AS precision FROM (
        SELECT k, "userId", count(*) AS n, count(*) FILTER (WHERE hit) AS hits FROM (SELECT unnest([1, 3, 5]) AS k)
        JOIN (SELECT "userId", EXISTS (SELECT 1 FROM test WHERE test."userId" = recs."userId"
            AND test."movieId" = recs."movieId") AS hit,
            row_number() OVER (PARTITION BY "userId" ORDER BY rank, "movieId") AS place
            FROM recs WHERE rank > 3) ON place <= k
        WHERE "userId" IN (SELECT "userId" FROM test) GROUP BY 1, 2) GROUP BY k""",
    "recs test",
)
def precision_curve_gaps(spark, sf_dir):
    """Precision of ranked lists whose first three rows were filtered away."""
    _, test = views.train_test(views.ratings(spark, sf_dir))
    recs = ranking.with_rank(_unseen(spark, sf_dir, "row")).where("rank > 3")
    return quality.precision_curve(recs, test, [1, 3, 5]).select("k", r6("precision"))


@query(
    "precision_at_k",
    "SELECT k, precision FROM curve WHERE model = 'unseen' AND k = 10",
    "recs recs_all test",
    PRECISION,
)
def precision_at_k(spark, sf_dir):
    _, test = views.train_test(views.ratings(spark, sf_dir))
    recs = ranking.with_rank(_unseen(spark, sf_dir, "row"))
    return quality.precision_at_k(recs, test, 10).select("k", r6("precision"))


# ---- Ranking -----------------------------------------------------------------------------------

PAIR_SCORES = {
    "pair_scores": """SELECT "userId", "movieId", uf.f0 * vf.f0 + uf.f1 * vf.f1 AS prediction
        FROM (SELECT DISTINCT "userId", "movieId" FROM ratings)
        JOIN uf ON uf.id = "userId" JOIN vf ON vf.id = "movieId" """
}
BY_ROW = 'row_number() OVER (PARTITION BY "userId" ORDER BY prediction DESC, "movieId")'
BY_RANK = 'rank() OVER (PARTITION BY "userId" ORDER BY prediction DESC)'


def _pair_scores(spark, sf_dir):
    source = views.ratings(spark, sf_dir)
    pairs = source.select("userId", "movieId").distinct()
    return models.predict(given_model(source), pairs)


@query("top_n_per_user_rank", f"{PREDICTED} pair_scores QUALIFY {BY_RANK} <= 10", "ratings uf vf", PAIR_SCORES)
def top_n_per_user_rank(spark, sf_dir):
    return rounded(ranking.top_n_per_user(_pair_scores(spark, sf_dir), 10, "rank"))


@query("top_n_per_user_row", f"{PREDICTED} pair_scores QUALIFY {BY_ROW} <= 10", "ratings uf vf", PAIR_SCORES)
def top_n_per_user_row(spark, sf_dir):
    return rounded(ranking.top_n_per_user(_pair_scores(spark, sf_dir), 10, "row"))


@query(
    "top_n_for_user",
    f'{PREDICTED} (SELECT * FROM pair_scores WHERE "userId" = 7 ORDER BY prediction DESC, "movieId" LIMIT 10)',
    "ratings uf vf",
    PAIR_SCORES,
)
def top_n_for_user(spark, sf_dir):
    return rounded(ranking.top_n_for_user(_pair_scores(spark, sf_dir), 7, 10))


@query(
    "first_k",
    'SELECT "userId", "movieId", round(prediction, 6) AS prediction, rank::INT AS rank FROM recs WHERE rank <= 3',
    "recs",
)
def first_k(spark, sf_dir):
    recs = ranking.first_k(_unseen(spark, sf_dir, "row"), 3)
    return recs.select("userId", "movieId", r6("prediction"), "rank")


# ---- Models on given factors -------------------------------------------------------------------

def _unseen(spark: SparkSession, sf_dir: str, ties: str, source: DataFrame | None = None) -> DataFrame:
    """Top 10 unseen items per user, from the given factors and the training pairs."""
    if source is None:
        source = _written(views.ratings(spark, sf_dir), "ratings")
    train = _written(views.train_test(source)[0], "train")
    return recommend.recommend_excluding_rated(given_model(source), train, 10, ties)


@query("recommend_excluding_rated_rank", f"{PREDICTED} unseen QUALIFY {BY_RANK} <= 10", "unseen")
def recommend_excluding_rated_rank(spark, sf_dir):
    return rounded(_unseen(spark, sf_dir, "rank"))


@query("recommend_excluding_rated_row", f"{PREDICTED} recs", "recs")
def recommend_excluding_rated_row(spark, sf_dir):
    return rounded(_unseen(spark, sf_dir, "row"))


@query("recommend_all_users", f"{PREDICTED} recs_all", "recs_all")
def recommend_all_users(spark, sf_dir):
    model = given_model(views.ratings(spark, sf_dir))
    nested = recommend.nest_recommendations(recommend.recommend_all_users(model, 10))
    return rounded(recommend.flatten_recommendations(nested))


BUILDERS = "SELECT \"userId\" FROM users WHERE occupation = 'BUILDING'"


@query(
    "recommend_for_users",
    f"""SELECT "userId", "movieId", round(prediction, 6) AS prediction, title, genres FROM recs_all
        LEFT JOIN movies USING ("movieId") WHERE "userId" IN ({BUILDERS})""",
    "recs_all users movies",
)
def recommend_for_users(spark, sf_dir):
    """Titled recommendations for the users of one occupation."""
    chosen = views.users(spark, sf_dir).where(F.col("occupation") == "BUILDING").select("userId")
    recs = recommend.recommend_for_users(given_model(views.ratings(spark, sf_dir)), chosen, 10)
    titled = joins.enrich_titles(recs, views.movies(spark, sf_dir))
    return titled.withColumn("prediction", r6("prediction"))


@query(
    "recommend_users_for_items",
    f"""{PREDICTED} scored WHERE "movieId" IN (SELECT "movieId" FROM movies WHERE title LIKE 'small%')
        QUALIFY row_number() OVER (PARTITION BY "movieId" ORDER BY prediction DESC, "userId") <= 10""",
    "scored movies",
)
def recommend_users_for_items(spark, sf_dir):
    """The ten best users for every item whose title starts with "small"."""
    chosen = views.movies(spark, sf_dir).where(F.col("title").startswith("small")).select("movieId")
    model = given_model(views.ratings(spark, sf_dir))
    return rounded(recommend.recommend_users_for_items(model, chosen, 10))


@query(
    "similar_items",
    """SELECT "movieId", "similar_movieId", round(c, 6) + 0.0 AS similarity FROM (
        SELECT a.vec_id AS "movieId", b.vec_id AS "similar_movieId",
        list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
        QUALIFY row_number() OVER (PARTITION BY "movieId" ORDER BY c DESC, "similar_movieId") <= 10""",
)
def similar_items(spark, sf_dir):
    vectors = views.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features")
    )
    every = vectors.select(F.col("id").alias("movieId"))
    found = recommend.similar_items(vectors, every, 10)
    return found.withColumn("similarity", r6("similarity"))


COLD = {
    "cold_pairs": 'SELECT l_orderkey::BIGINT AS "userId", l_partkey::BIGINT AS "movieId" FROM lineitem',
    "cold_scores": """SELECT "userId", "movieId", uf.f0 * vf.f0 + uf.f1 * vf.f1 AS prediction
        FROM cold_pairs LEFT JOIN uf ON uf.id = "userId" LEFT JOIN vf ON vf.id = "movieId" """,
}
COLD_SQL = {
    "drop": f"{PREDICTED} cold_scores WHERE prediction IS NOT NULL",
    "zero": 'SELECT "userId", "movieId", round(coalesce(prediction, 0), 6) AS prediction FROM cold_scores',
    "nan": 'SELECT "userId", "movieId", round(prediction, 6) AS prediction,'
    " prediction IS NULL AS is_nan FROM cold_scores",
}


def _cold(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Pairs of order number and item: most order numbers are no known user."""
        pairs = views.table(spark, sf_dir, "lineitem").selectExpr(
            "CAST(l_orderkey AS BIGINT) AS userId", "CAST(l_partkey AS BIGINT) AS movieId"
        )
        scored = rounded(
            models.predict(given_model(views.ratings(spark, sf_dir)), pairs, mode)
        )
        if mode != "nan":
            return scored
        is_nan = F.isnan("prediction")
        return scored.withColumn("is_nan", is_nan).withColumn(
            "prediction", F.when(~is_nan, F.col("prediction"))
        )

    return run


for _mode, _sql in COLD_SQL.items():
    query(f"predict_{_mode}", _sql, "uf vf", COLD)(_cold(_mode))

KNOWN = {
    "known": """SELECT test.* FROM test WHERE "userId" IN (SELECT "userId" FROM train)
        AND "movieId" IN (SELECT "movieId" FROM train)""",
    "preds": """SELECT known."userId", known."movieId", rating, uf.f0 * vf.f0 + uf.f1 * vf.f1 AS prediction
        FROM known JOIN uf ON uf.id = "userId" JOIN vf ON vf.id = "movieId" """,
}


@query("evaluate", f"SELECT {ERRORS_SQL}, count(*) AS n_pairs FROM preds", "uf vf train test", KNOWN)
def evaluate(spark, sf_dir):
    train, test = views.train_test(views.ratings(spark, sf_dir))
    return _rounded_errors(evaluation.evaluate(given_model(train), test))


@query(
    "run_metrics_row",
    f"""SELECT 12.5::DOUBLE AS training_time, 1.25::DOUBLE AS per_iteration_time,
        NULL::DOUBLE AS tuning_time, 13.75::DOUBLE AS total_time,
        (SELECT count(*) FROM train) AS num_ratings,
        (SELECT count(DISTINCT "userId") FROM train) AS num_users,
        (SELECT count(DISTINCT "movieId") FROM train) AS num_items, {ERRORS_SQL} FROM preds""",
    "uf vf train test",
    KNOWN,
)
def run_metrics_row(spark, sf_dir):
    """The metrics row of a run with given timings."""
    train, test = views.train_test(views.ratings(spark, sf_dir))
    row = runs.run_metrics_row(
        stats.dataset_stats(train),
        evaluation.evaluate(given_model(train), test),
        training_time=12.5,
        per_iteration_time=1.25,
        total_time=13.75,
    )
    return row.withColumns({"rmse": r6("rmse"), "mae": r6("mae")})


# ---- Solvers -----------------------------------------------------------------------------------

def _half_step(solve_for: str, scaled: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = views.ratings(spark, sf_dir)
        fixed = views.item_factors(source) if solve_for == "user" else views.user_factors(source)
        return flat(plain_als.als_half_step(source, fixed, 2, 0.1, scaled, solve_for))

    return run


for _side, _entity, _other, _fixed in (
    ("user", "userId", "movieId", "vf"), ("item", "movieId", "userId", "uf"),
):
    for _scaled in (False, True):
        query(
            f"als_half_step_{_side}{'_scaled' if _scaled else ''}",
            f"{FLAT_SQL} ({_solve_sql(_gram_sql(_entity, _other, 'ratings', _fixed), 0.1, _scaled)})",
            f"ratings {_fixed}",
        )(_half_step(_side, _scaled))


def _init_sql(column: str, side: str) -> str:
    def entry(position: int) -> str:
        text = f"md5('42:{side}:' || id || ':{position}')"
        u1 = f"((('0x' || substr({text}, 1, 8))::BIGINT + 1) / 4294967296::DOUBLE)"
        u2 = f"(('0x' || substr({text}, 9, 8))::BIGINT / 4294967296::DOUBLE)"
        return f"0.1::DOUBLE * sqrt(-2::DOUBLE * ln({u1})) * cos(2::DOUBLE * pi() * {u2})"

    return (
        f"SELECT id, {entry(0)} AS f0, {entry(1)} AS f1 FROM"
        f' (SELECT DISTINCT "{column}" AS id FROM ratings)'
    )


def _step_sql(entity: str, other: str, fixed: str) -> str:
    return _solve_sql(_gram_sql(entity, other, "last_rating", fixed), 0.1, False)


# Two iterations of the plain solver at rank 2. Every rating of the table is above zero.
PLAIN = LAST | {
    "items0": _init_sql("movieId", "item"),
    "users1": _step_sql("userId", "movieId", "items0"),
    "items1": _step_sql("movieId", "userId", "users1"),
    "users2": _step_sql("userId", "movieId", "items1"),
    "items2": _step_sql("movieId", "userId", "users2"),
}


def _plain_rmse_sql(iteration: int) -> str:
    return f"""SELECT {iteration}::INT AS iteration,
        round(sqrt(avg((u.f0 * v.f0 + u.f1 * v.f1 - rating) ** 2)), 6) AS rmse FROM last_rating
        JOIN users{iteration} u ON u.id = "userId" JOIN items{iteration} v ON v.id = "movieId" """


@query(
    "train_plain_als",
    "SELECT 'user' AS side, id, round(f0, 6) + 0.0 AS f0, round(f1, 6) + 0.0 AS f1 FROM users2"
    " UNION ALL SELECT 'item', id, round(f0, 6) + 0.0, round(f1, 6) + 0.0 FROM items2",
    "ratings",
    PLAIN,
)
def train_plain_als(spark, sf_dir):
    source = views.ratings(spark, sf_dir)
    model = plain_als.train_plain_als(source, rank=2, max_iter=2, reg=0.1, track_rmse=False).model
    users = flat(model.users).select(F.lit("user").alias("side"), "id", "f0", "f1")
    return users.unionByName(flat(model.items).select(F.lit("item").alias("side"), "id", "f0", "f1"))


@query(
    "train_rmse_history", f"{_plain_rmse_sql(1)} UNION ALL {_plain_rmse_sql(2)}", "ratings", PLAIN
)
def train_rmse_history(spark, sf_dir):
    run = plain_als.train_plain_als(views.ratings(spark, sf_dir), rank=2, max_iter=2, reg=0.1)
    return run.history.select("iteration", r6("rmse"))


def _implicit_step_sql(entity: str, other: str, fixed: str) -> str:
    """Confidence 1 + 2 rating of preference 1 for every rating, 1 of preference 0 for all other pairs."""
    shared = ", ".join(f"sum({a} * {b}) AS g_{a[1]}_{b[1]}" for a, b in (("f0", "f0"), ("f0", "f1"), ("f1", "f1")))
    sums = f"""SELECT "{entity}" AS id, count(*) AS n, g_0_0 + sum(2 * rating * f0 * f0) AS a_0_0,
        g_0_1 + sum(2 * rating * f0 * f1) AS a_0_1, g_1_1 + sum(2 * rating * f1 * f1) AS a_1_1,
        sum((1 + 2 * rating) * f0) AS b_0, sum((1 + 2 * rating) * f1) AS b_1
        FROM last_rating JOIN {fixed} ON id = "{other}", (SELECT {shared} FROM {fixed})
        GROUP BY 1, g_0_0, g_0_1, g_1_1"""
    return _solve_sql(sums, 0.1, True)


IMPLICIT = LAST | {
    "items0": _init_sql("movieId", "item"),
    "users1": _implicit_step_sql("userId", "movieId", "items0"),
    "items1": _implicit_step_sql("movieId", "userId", "users1"),
    "users2": _implicit_step_sql("userId", "movieId", "items1"),
    "items2": _implicit_step_sql("movieId", "userId", "users2"),
}


def _implicit_loss_sql(iteration: int) -> str:
    """All pairs at preference 0, and what the rated ones change."""
    return f"""SELECT {iteration}::INT AS iteration, round(sqrt(
        ((SELECT sum((u.f0 * v.f0 + u.f1 * v.f1) ** 2) FROM users{iteration} u, items{iteration} v)
          + sum((1 + 2 * rating) * (1 - p) ** 2 - p ** 2))
        / ((SELECT count(*) FROM users{iteration}) * (SELECT count(*) FROM items{iteration}) + sum(2 * rating))), 6) AS rmse
      FROM (SELECT rating, u.f0 * v.f0 + u.f1 * v.f1 AS p FROM last_rating
        JOIN users{iteration} u ON u.id = "userId" JOIN items{iteration} v ON v.id = "movieId")"""


def _plain_implicit(spark: SparkSession, sf_dir: str) -> plain_als.PlainAlsRun:
    source = views.ratings(spark, sf_dir)
    return plain_als.train_plain_als(source, 2, 2, 0.1, scaled=True, implicit=True, alpha=2.0)


@query(
    "train_plain_implicit",
    "SELECT 'user' AS side, id, round(f0, 6) + 0.0 AS f0, round(f1, 6) + 0.0 AS f1 FROM users2"
    " UNION ALL SELECT 'item', id, round(f0, 6) + 0.0, round(f1, 6) + 0.0 FROM items2",
    "ratings",
    IMPLICIT,
)
def train_plain_implicit(spark, sf_dir):
    model = _plain_implicit(spark, sf_dir).model
    users = flat(model.users).select(F.lit("user").alias("side"), "id", "f0", "f1")
    return users.unionByName(flat(model.items).select(F.lit("item").alias("side"), "id", "f0", "f1"))


@query(
    "train_implicit_history", f"{_implicit_loss_sql(1)} UNION ALL {_implicit_loss_sql(2)}", "ratings", IMPLICIT
)
def train_implicit_history(spark, sf_dir):
    """The weighted error over all pairs of a user and an item, from the sums of the item steps."""
    return _plain_implicit(spark, sf_dir).history.select("iteration", r6("rmse"))


@query(
    "recommend_wide_ids",
    """SELECT "userId" + 8589934592 AS "userId", "movieId", round(prediction, 6) AS prediction FROM (
        SELECT u.id::BIGINT AS "userId", v.id AS "movieId", u.f0 * v.f0 + u.f1 * v.f1 AS prediction
        FROM users2 u, items2 v WHERE u.id = 7)
      QUALIFY row_number() OVER (ORDER BY prediction DESC, "movieId") <= 10""",
    "ratings",
    PLAIN,
)
def recommend_wide_ids(spark, sf_dir):
    """Train on user ids above 2^32 and look one of them up."""
    source = views.ratings(spark, sf_dir).withColumn("userId", F.col("userId").cast("bigint") + F.lit(1 << 33))
    rec = Recommender(spark, "plain").train(source, rank=2, max_iter=2, reg=0.1)
    return rounded(rec.recommend_for_user((1 << 33) + 7, 10))


def _written(source: DataFrame, name: str, *more: str) -> DataFrame:
    """The (user, item, rating) rows, joined and drawn once and read by every later step from the shared folder."""
    path = scratch_path(source.sparkSession, name)
    sources.write_parquet(source.select("userId", "movieId", "rating", *more), path)
    return source.sparkSession.read.parquet(path)


def _distance(found: DataFrame, wanted: DataFrame, digits: int) -> DataFrame:
    """(id, difference): the largest difference of two vectors per id, rounded; null if one is missing."""
    pairs = found.join(wanted.withColumnRenamed("features", "_wanted"), "id", "full")
    gaps = F.zip_with("features", "_wanted", lambda a, b: F.abs(a - b))
    return pairs.select("id", F.round(F.array_max(gaps), digits).alias("difference"))


@query(
    "train_plain_als_rank10",
    'SELECT DISTINCT "movieId" AS id, 0.0::DOUBLE AS difference FROM ratings WHERE rating > 0',
    "ratings",
)
def train_plain_als_rank10(spark, sf_dir):
    """Trained item vectors against a fresh solution of their normal equations."""
    source = _written(views.ratings(spark, sf_dir), "ratings", "timestamp")
    model = plain_als.train_plain_als(source, rank=10, max_iter=3, track_rmse=False).model
    last = cleaning.observed_only(cleaning.dedupe_last(source))
    return _distance(model.items, plain_als.als_half_step(last, model.users, 10, 0.1, solve_for="item"), 6)


@query("train_als", 'SELECT DISTINCT "userId" AS id, 0.0::DOUBLE AS difference FROM ratings', "ratings")
def train_als_explicit(spark, sf_dir):
    """Trained user vectors against a fresh solution of their normal equations."""
    source = _written(views.ratings(spark, sf_dir), "ratings")
    model = fit_factors(source, rank=10, max_iter=5)
    items = model.items.withColumn("features", F.col("features").cast("array<float>"))  # as trained
    return _distance(model.users, plain_als.als_half_step(source, items, 10, 0.1, scaled=True), 2)


@query("train_als_implicit", 'SELECT DISTINCT "userId" AS id, 0.0::DOUBLE AS residual FROM ratings', "ratings")
def train_als_implicit(spark, sf_dir):
    """The largest residual of each user's implicit normal equations, alpha 1, ridge 0.1 per rating."""
    source = _written(views.ratings(spark, sf_dir), "ratings")
    rank = 5
    model = fit_factors(source, rank=rank, max_iter=3, implicit=True, alpha=1.0)
    pairs = [(i, j) for i in range(rank) for j in range(i, rank)]
    y = [F.col("features")[i] for i in range(rank)]
    gram = model.items.agg(*(F.sum(y[i] * y[j]).alias(f"g_{i}_{j}") for i, j in pairs)).first()
    rated = source.join(model.items.withColumnRenamed("id", "movieId"), "movieId")
    sums = rated.groupBy(F.col("userId").alias("id")).agg(
        F.count("*").alias("n"),
        *(F.sum(F.col("rating") * y[i] * y[j]).alias(f"a_{i}_{j}") for i, j in pairs),
        *(F.sum((1 + F.col("rating")) * y[i]).alias(f"b_{i}") for i in range(rank)),
    )

    def cell(i: int, j: int) -> Column:
        i, j = min(i, j), max(i, j)
        ridge = 0.1 * F.col("n") if i == j else F.lit(0.0)
        return F.col(f"a_{i}_{j}") + F.lit(gram[f"g_{i}_{j}"]) + ridge

    solved = sums.join(model.users, "id", "full")
    rows = [sum(cell(i, j) * y[j] for j in range(rank)) - F.col(f"b_{i}") for i in range(rank)]
    # Vectors are stored in single precision, so the residual is measured against the right side.
    scale = F.greatest(*(F.abs(F.col(f"b_{i}")) for i in range(rank)), F.lit(1.0))
    return solved.select("id", F.round(F.greatest(*map(F.abs, rows)) / scale, 3).alias("residual"))


@query(
    "save_load_mllib",
    'SELECT count(*) AS pairs, 0::BIGINT AS changed FROM test WHERE "userId" IN (SELECT "userId" FROM train)'
    ' AND "movieId" IN (SELECT "movieId" FROM train)',
    "train test",
)
def save_load_mllib(spark, sf_dir):
    """Test pairs scored by a model read back from MLlib's format, and those scored differently."""
    train, test = views.train_test(views.ratings(spark, sf_dir))
    path = scratch_path(spark, "mllib-model")
    fitted = train_als(train, rank=5, max_iter=3)
    models.save_mllib(fitted, path)
    before = models.predict(models.from_mllib(fitted), test)
    both = models.predict(models.from_mllib(models.load_mllib(path)), before.withColumnRenamed("prediction", "_before"))
    return both.agg(
        F.count("*").alias("pairs"), F.count_if(F.col("prediction") != F.col("_before")).alias("changed")
    )


def recommended(spark: SparkSession, sf_dir: str, train: DataFrame | None = None) -> DataFrame:
    """Split, train, top 10 unseen items per user, titles: the whole pipeline."""
    if train is None:
        train = _written(views.train_test(views.ratings(spark, sf_dir))[0], "train")
    model = fit_factors(train, rank=10, max_iter=5, seed=42)
    recs = recommend.recommend_excluding_rated(model, train, 10, "row")
    return joins.enrich_titles(recs, views.movies(spark, sf_dir))


@query(
    "recommend_trained",
    'SELECT "userId", least(10, (SELECT count(DISTINCT "movieId") FROM train) - count(DISTINCT "movieId"))::BIGINT AS n,'
    ' 0::BIGINT AS rated, 0::BIGINT AS untitled FROM train GROUP BY 1',
    "train",
)
def recommend_trained(spark, sf_dir):
    """Per user: recommended items, those of them already rated, and those without a title."""
    train = _written(views.train_test(views.ratings(spark, sf_dir))[0], "train")
    rated = train.select("userId", "movieId").distinct().withColumn("_rated", F.lit(1))
    found = recommended(spark, sf_dir, train).join(rated, ["userId", "movieId"], "left")
    return found.groupBy("userId").agg(
        F.count_distinct("movieId").alias("n"),
        F.count("_rated").alias("rated"),
        F.count_if(F.col("title").isNull()).alias("untitled"),
    )


@query(
    "tune",
    """SELECT g.rank, g.reg, g.max_iter, g.reg = 0.01 AS chosen, (SELECT count(*) FROM
        (SELECT DISTINCT "userId", "movieId" FROM train)) AS ratings
        FROM (VALUES (4, 0.01::DOUBLE, 10), (4, 1.0::DOUBLE, 10)) g(rank, reg, max_iter)""",
    "train",
)
def tune(spark, sf_dir):
    """The parameters chosen on ratings that follow given factors; the weaker ridge fits them."""
    pairs = views.ratings(spark, sf_dir).select("userId", "movieId").distinct()
    scored = models.predict(given_model(pairs), pairs)
    planted = scored.select("userId", "movieId", (1 + 2 * F.col("prediction")).alias("rating"))
    train, test = (_written(part, name) for part, name in zip(views.train_test(planted), ("train", "test")))
    grid = {"rank": [4], "reg": [0.01, 1.0], "max_iter": [10]}
    found = evaluation.tune(train, test, grid, folds=2).grid
    return found.select("rank", "reg", "max_iter", "chosen").withColumn("ratings", F.lit(train.count()).cast("bigint"))


def _fold_step_sql(entity: str, other: str, fixed: str, keys: str) -> str:
    """All entities of every model, a fold and a ridge term, from the ratings outside the fold."""
    return f"""SELECT m.held, m.reg, "{entity}" AS id,
        sum(rating * v.f0) / (sum(v.f0 * v.f0) + m.reg * count(*)) AS f0
        FROM folded JOIN models m ON fold <> held JOIN {fixed} v ON v.id = "{other}" {keys} GROUP BY 1, 2, 3"""


def _fold_rmse_sql(iteration: int) -> str:
    return f"""SELECT u.reg, {iteration}::INT AS max_iter, u.held, sqrt(avg((u.f0 * v.f0 - rating) ** 2)) AS rmse
        FROM folded JOIN users{iteration} u ON u.id = "userId" AND u.held = fold
        JOIN items{iteration} v ON v.id = "movieId" AND v.held = fold AND v.reg = u.reg GROUP BY 1, 2, 3"""


_SAME_MODEL = "AND v.held = m.held AND v.reg = m.reg"
FOLDS = LAST | {
    "folded": f"SELECT *, ({sql_bucket('fold', 42)} % 3)::INT AS fold FROM last_rating WHERE rating > 0",
    "models": "SELECT held, reg FROM (SELECT unnest([0, 1, 2]) AS held), (SELECT unnest([0.01::DOUBLE, 1]) AS reg)",
    "items0": _init_sql("movieId", "item"),
    "users1": _fold_step_sql("userId", "movieId", "items0", ""),
    "items1": _fold_step_sql("movieId", "userId", "users1", _SAME_MODEL),
    "users2": _fold_step_sql("userId", "movieId", "items1", _SAME_MODEL),
    "items2": _fold_step_sql("movieId", "userId", "users2", _SAME_MODEL),
    "errors": f"""SELECT reg, max_iter, avg(rmse) AS mean_rmse FROM
        ({_fold_rmse_sql(1)} UNION ALL {_fold_rmse_sql(2)}) GROUP BY 1, 2""",
}


@query(
    "tune_stacked",
    """SELECT 1::INT AS rank, reg, max_iter, round(mean_rmse, 6) AS mean_rmse,
        mean_rmse = (SELECT min(mean_rmse) FROM errors) AS chosen FROM errors""",
    "ratings",
    FOLDS,
)
def tune_stacked(spark, sf_dir):
    """Fold errors of the plain solver at rank 1, all folds and ridge terms advancing together."""
    source = _written(views.ratings(spark, sf_dir), "ratings", "timestamp")
    grid = {"rank": [1], "reg": [0.01, 1.0], "max_iter": [1, 2]}
    found = evaluation.tune_stacked(source, source, grid, folds=3).grid
    return found.withColumn("mean_rmse", r6("mean_rmse"))


@query(
    "scaling_test",
    " UNION ALL ".join(
        f"SELECT {f}::DOUBLE AS fraction, count(*) AS sample_size, true AS timed FROM ratings"
        f" WHERE {sql_share(f, 'sample', 42)}"
        for f in (0.25, 0.5, 1.0)
    ),
    "ratings",
)
def scaling_test(spark, sf_dir):
    """Sample sizes of a scaling test, and whether every step took time."""
    source = views.ratings(spark, sf_dir)
    found = runs.scaling_test(source, [0.25, 0.5, 1.0], rank=5, max_iter=2)
    return found.select("fraction", "sample_size", (F.col("training_time") > 0).alias("timed"))


# ---- Layout and reports ------------------------------------------------------------------------

@query(
    "plan_partitions",
    """SELECT count(*) AS num_rows, round(count(*) * 25 / (1024 * 1024), 6) AS estimated_mb,
        4 AS current_partitions,
        greatest(1, floor(count(*) * 25 / (1024 * 1024) / 1)::INT, 8) AS planned_partitions,
        abs(planned_partitions - 4) > 4 * 0.2 AS repartition FROM ratings""",
    "ratings",
)
def plan_partitions(spark, sf_dir):
    """The plan for 4 current partitions, 8 cores and 1 MB per partition."""
    plan = layout.partition_plan(views.ratings(spark, sf_dir), 4, 8, target_mb=1)
    return plan.withColumn("estimated_mb", r6("estimated_mb"))


@query("repartition", f"SELECT {RATING} FROM ratings", "ratings")
def repartition(spark, sf_dir):
    return layout.repartition(views.ratings(spark, sf_dir), 12, "userId")


@query(
    "scaling_report",
    """SELECT size, implementation, sample_size, round(training_time / sample_size, 6) AS time_per_rating,
        round(t0 * (sample_size / n0), 6) AS linear_time,
        round(t0 * (sample_size / n0) / training_time, 6) AS speedup
        FROM (SELECT *, first_value(training_time) OVER w AS t0, first_value(sample_size) OVER w AS n0
        FROM run_metrics WINDOW w AS (PARTITION BY implementation ORDER BY size))""",
    "run_metrics",
)
def scaling_report(spark, sf_dir):
    report = reports.scaling_report(views.run_metrics(spark, sf_dir), "size", ["implementation"])
    return report.select(
        "size", "implementation", "sample_size", r6("time_per_rating"), r6("linear_time"), r6("speedup")
    )


PIVOT = {
    "paired": """SELECT size, max(training_time) FILTER (WHERE implementation = 'view') AS t1,
        max(training_time) FILTER (WHERE implementation = 'click') AS t2,
        max(total_time) FILTER (WHERE implementation = 'view') AS a1,
        max(total_time) FILTER (WHERE implementation = 'click') AS a2,
        max(rmse) FILTER (WHERE implementation = 'view') AS r1,
        max(rmse) FILTER (WHERE implementation = 'click') AS r2,
        max(mae) FILTER (WHERE implementation = 'view') AS m1,
        max(mae) FILTER (WHERE implementation = 'click') AS m2 FROM run_metrics GROUP BY size"""
}


@query(
    "speedup_report",
    """SELECT size, round(t1 / nullif(t2, 0), 6) AS training_time_speedup,
        round(a1 / nullif(a2, 0), 6) AS total_time_speedup FROM paired
        WHERE t1 IS NOT NULL AND t2 IS NOT NULL AND a1 IS NOT NULL AND a2 IS NOT NULL""",
    "run_metrics",
    PIVOT,
)
def speedup_report(spark, sf_dir):
    report = reports.speedup_report(
        views.run_metrics(spark, sf_dir), "view", "click", ["training_time", "total_time"]
    )
    return report.select("size", r6("training_time_speedup"), r6("total_time_speedup"))


@query(
    "accuracy_report",
    "SELECT size, round(abs(r1 - r2), 6) AS rmse_difference, round(abs(m1 - m2), 6) AS mae_difference FROM paired",
    "run_metrics",
    PIVOT,
)
def accuracy_report(spark, sf_dir):
    report = reports.accuracy_report(views.run_metrics(spark, sf_dir), "view", "click")
    return report.select("size", r6("rmse_difference"), r6("mae_difference"))


@query(
    "melt_metrics",
    " UNION ALL ".join(
        f"SELECT size, implementation, '{m}' AS metric, {m} AS value FROM run_metrics"
        for m in ("rmse", "mae", "training_time", "total_time")
    ),
    "run_metrics",
)
def melt_metrics(spark, sf_dir):
    return reports.melt_metrics(
        views.run_metrics(spark, sf_dir),
        ["size", "implementation"],
        ["rmse", "mae", "training_time", "total_time"],
    )


@query(
    "summary_table",
    "SELECT size, implementation, training_time, rmse,"
    " CASE WHEN sample_size % 2 = 0 THEN total_time END AS total_time FROM run_metrics",
    "run_metrics",
)
def summary_table(spark, sf_dir):
    """Nested results per size, where some runs did not record their total time."""
    metrics = F.map_filter(
        F.create_map(
            F.lit("training_time"), F.col("training_time"),
            F.lit("rmse"), F.col("rmse"),
            F.lit("total_time"), F.when(F.col("sample_size") % 2 == 0, F.col("total_time")),
        ),
        lambda _, value: value.isNotNull(),
    )
    nested = (
        views.run_metrics(spark, sf_dir)
        .groupBy("size")
        .agg(F.map_from_entries(F.collect_list(F.struct("implementation", metrics))).alias("implementations"))
    )
    return reports.summary_table(nested)
