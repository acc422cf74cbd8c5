"""Hot keys, exact copies and null keys take the salted path and change no result."""

import pytest
from pyspark.sql import functions as F

from starloom.operators import joins, splits
from starloom.operators.skew import SALT, add_salt, hot_keys, replicate, skew_join, skew_joins


@pytest.fixture
def hot_ratings(spark):
    """A third of the rows belong to user 7, half of those are exact copies; some users are null."""
    ids = spark.range(6000)
    user = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None).otherwise(
        F.col("id") % 400
    )
    item = F.when(F.col("id") % 6 == 0, F.lit(1)).otherwise(F.col("id") % 90)
    return ids.select(
        user.cast("int").alias("userId"), item.cast("int").alias("movieId"),
        F.when(F.col("id") % 6 == 0, F.lit(3.0)).otherwise(F.col("id") % 5 + 1.0).alias("rating"),
    ).repartition(5)


@pytest.fixture
def users(spark):
    return spark.range(300).select(F.col("id").cast("int").alias("userId"), (F.col("id") * 2).alias("w"))


def test_hot_keys_are_bounded_and_contain_the_hot_one(hot_ratings):
    found = hot_keys(hot_ratings, "userId", "movieId", share=1 / 20)
    assert 7 in found["userId"] and 1 in found["movieId"]
    assert all(len(values) <= 20 and None not in values for values in found.values())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(hot_ratings, users, rows_of, how):
    salted = skew_join(hot_ratings, users, "userId", how, broadcast_bytes=0, salts=6)
    plain = hot_ratings.join(users, "userId", how)
    assert rows_of(salted.select(plain.columns)) == rows_of(plain)


def test_salt_spreads_the_hot_key_and_its_copies(hot_ratings):
    salted = add_salt(hot_ratings, "userId", [7], 5).where("userId = 7")
    sizes = [r["count"] for r in salted.groupBy(SALT).count().collect()]
    assert len(sizes) == 5 and max(sizes) < 0.5 * sum(sizes)
    copies = salted.where("movieId = 1 AND rating = 3.0").groupBy(SALT).count().collect()
    assert len(copies) > 1


def test_only_hot_keys_are_replicated(users):
    copies = replicate(users, "userId", [7, 9], 5).groupBy("userId").count()
    assert {r["userId"] for r in copies.where("count > 1").collect()} == {7, 9}


def test_salted_score_pairs_equals_direct_product(spark, hot_ratings, rows_of, monkeypatch):
    factors = spark.range(300).select(
        F.col("id").cast("int").alias("id"),
        F.array(F.col("id") / 7.0, F.col("id") / 11.0).alias("features"),
    )
    broadcast = joins.score_pairs(hot_ratings, factors, factors, rank=2)
    monkeypatch.setitem(skew_joins.__kwdefaults__, "broadcast_bytes", 0)
    salted = joins.score_pairs(hot_ratings, factors, factors, rank=2)
    general = joins.score_pairs(hot_ratings, factors, factors)
    assert rows_of(salted) == rows_of(broadcast) == rows_of(general)


def test_known_pairs_with_a_hot_user(hot_ratings, rows_of):
    train = hot_ratings.where("rating >= 4")
    test = hot_ratings.where("rating < 4")
    users = {r[0] for r in train.select("userId").collect()} - {None}
    items = {r[0] for r in train.select("movieId").collect()}
    expected = [r for r in rows_of(test) if r[0] in users and r[1] in items]
    assert rows_of(splits.known_pairs(test, train)) == expected
