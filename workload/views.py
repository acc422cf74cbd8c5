"""Rating tables derived from the driver tables, in Spark and as DuckDB common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.operators.splits import split_bernoulli
from starloom.schemas import GENRE_FLAG_COLUMNS, N_GENRE_FLAGS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        "CAST(o_custkey AS BIGINT) AS userId",
        "CAST(l_partkey AS BIGINT) AS movieId",
        "0.5D * (1 + pmod(CAST(l_quantity AS INT) - 1, 10)) AS rating",
        "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(l_shipdate AS TIMESTAMP_NTZ))"
        " AS timestamp",
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS BIGINT) AS movieId",
        "p_name AS title",
        "concat_ws('|', p_type, p_brand) AS genres",
    )


def movies_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [
        (F.pmod("movieId", F.lit(i + 2)) == 0).cast("int").alias(name)
        for i, name in enumerate(GENRE_FLAG_COLUMNS)
    ]
    return movies(spark, sf_dir).select("movieId", "title", *flags)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS BIGINT) AS userId",
        "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
        "CAST(18 + c_custkey % 50 AS INT) AS age",
        "c_mktsegment AS occupation",
        "CAST(c_nationkey AS STRING) AS zip_code",
    )


def _factors(source: DataFrame, column: str, first: tuple[int, int], second: tuple[int, int]):
    (a, m), (b, n) = first, second
    return source.select(F.col(column).alias("id")).distinct().select(
        "id",
        F.array(
            F.pmod(F.col("id") * a, F.lit(m)).cast("double") / m,
            F.pmod(F.col("id") * b, F.lit(n)).cast("double") / n,
        ).alias("features"),
    )


def user_factors(source: DataFrame) -> DataFrame:
    """Given rank-2 user vectors; integer arithmetic, so every engine has the same bits."""
    return _factors(source, "userId", (37, 101), (53, 97))


def item_factors(source: DataFrame) -> DataFrame:
    return _factors(source, "movieId", (41, 103), (59, 89))


def train_test(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_bernoulli(source, 0.8)


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per day and event type, as a stand-in for a log of training runs."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.date_format("ts", "yyyy-MM-dd").alias("size"), F.col("event_type").alias("implementation")
        )
        .agg(
            F.count("*").alias("sample_size"),
            F.round(F.sum("value"), 6).alias("training_time"),
            F.round(F.sum("value") + F.max("value"), 6).alias("total_time"),
            F.round(F.avg("value"), 6).alias("rmse"),
            F.round(F.avg(F.sqrt(F.abs("value"))), 6).alias("mae"),
        )
    )


_BUCKET = "('0x' || substr(md5({key}), 1, 13))::BIGINT"
PAIR = "userId || ':' || movieId"


def sql_bucket(domain: str, seed: int | None = None, pair: str = PAIR) -> str:
    prefix = domain if seed is None else f"{domain}:{seed}"
    return _BUCKET.format(key=f"'{prefix}:' || {pair}")


def sql_share(fraction: float, domain: str, seed: int | None = None) -> str:
    """Whether a pair falls into the first ``fraction`` of the draws."""
    return f"{sql_bucket(domain, seed)} < {round(fraction * 2**52)}"


CTES = {
    "ratings": """SELECT o_custkey::BIGINT AS "userId", l_partkey::BIGINT AS "movieId",
        0.5::DOUBLE * (1 + ((l_quantity::INT - 1) % 10)) AS rating,
        epoch(l_shipdate)::BIGINT AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "movies": """SELECT p_partkey::BIGINT AS "movieId", p_name AS title,
        p_type || '|' || p_brand AS genres FROM part""",
    "movies_flags": "SELECT \"movieId\", title, "
    + ", ".join(f'(("movieId" % {i + 2}) = 0)::INT AS genre_{i}' for i in range(N_GENRE_FLAGS))
    + " FROM movies",
    "users": """SELECT c_custkey::BIGINT AS "userId",
        CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
        (18 + c_custkey % 50)::INT AS age, c_mktsegment AS occupation,
        c_nationkey::VARCHAR AS zip_code FROM customer""",
    "uf": """SELECT DISTINCT "userId" AS id, (("userId" * 37) % 101)::DOUBLE / 101 AS f0,
        (("userId" * 53) % 97)::DOUBLE / 97 AS f1 FROM ratings""",
    "vf": """SELECT DISTINCT "movieId" AS id, (("movieId" * 41) % 103)::DOUBLE / 103 AS f0,
        (("movieId" * 59) % 89)::DOUBLE / 89 AS f1 FROM ratings""",
    "train": f"SELECT * FROM ratings WHERE {sql_share(0.8, 'split')}",
    "test": f"SELECT * FROM ratings WHERE NOT {sql_share(0.8, 'split')}",
    "scored": """SELECT uf.id AS "userId", vf.id AS "movieId", uf.f0 * vf.f0 + uf.f1 * vf.f1 AS prediction
        FROM uf CROSS JOIN vf""",
    "unseen": """SELECT * FROM scored WHERE NOT EXISTS (SELECT 1 FROM train
        WHERE train."userId" = scored."userId" AND train."movieId" = scored."movieId")""",
    "recs": """SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY prediction DESC, "movieId") AS rank
        FROM unseen QUALIFY rank <= 10""",
    "recs_all": """SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY prediction DESC, "movieId") AS rank
        FROM scored QUALIFY rank <= 10""",
    "run_metrics": """SELECT strftime(ts, '%Y-%m-%d') AS size, event_type AS implementation,
        count(*) AS sample_size, round(sum(value), 6) AS training_time,
        round(sum(value) + max(value), 6) AS total_time, round(avg(value), 6) AS rmse,
        round(avg(sqrt(abs(value))), 6) AS mae FROM events GROUP BY 1, 2""",
}

_NEEDS = {
    "movies_flags": ["movies"], "uf": ["ratings"], "vf": ["ratings"], "train": ["ratings"],
    "test": ["ratings"], "scored": ["uf", "vf"], "unseen": ["scored", "train"],
    "recs": ["unseen"], "recs_all": ["scored"],
}


def with_views(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the named CTEs and all they need, in dependency order."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        visit(name)
    parts = [f"{n} AS ({CTES[n]})" for n in wanted]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
