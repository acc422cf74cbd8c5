import pytest

from starloom.operators import cleaning
from starloom.schemas import GENRE_FLAG_COLUMNS


def test_genres_follow_flag_order_and_may_be_empty(spark):
    rows = [(1, "A", *[int(i in (0, 4, 18)) for i in range(19)]), (2, "B", *[0] * 19)]
    wide = spark.createDataFrame(rows, ["movieId", "title", *GENRE_FLAG_COLUMNS])
    found = {r["movieId"]: r["genres"] for r in cleaning.clean_movies(wide).collect()}
    assert found == {1: "Action|Comedy|Unknown", 2: ""}


def test_genre_names_are_a_parameter(spark):
    wide = spark.createDataFrame([(1, "A", 1, 1)], "movieId INT, title STRING, x INT, y INT")
    named = cleaning.genres_from_flags(wide, ["First", "Second"], ["x", "y"])
    assert named.first()["genres"] == "First|Second"
    with pytest.raises(ValueError):
        cleaning.genres_from_flags(wide, ["First"], ["x", "y"])


def test_users_without_details_stay_unchanged(spark):
    bare = spark.createDataFrame([(1,)], "userId INT")
    assert cleaning.clean_users(bare).columns == ["userId"]


def test_unreadable_ratings_are_dropped_and_counted(spark, rows_of):
    raw = spark.createDataFrame(
        [("1", "2", "3.5", "10"), ("x", "2", "3", "1"), ("1", None, "3", "1"), ("1", "3", "n/a", "1"),
         ("1", "4", "2", "late")],
        "userId STRING, movieId STRING, rating STRING, timestamp STRING",
    )
    assert rows_of(cleaning.clean_ratings(raw)) == [(1, 2, 3.5, 10), (1, 4, 2.0, None)]
    assert tuple(cleaning.cleaning_report(raw).first()) == (5, 2, 3)


def test_clean_ratings_is_the_identity_on_clean_data(ratings_of, rows_of):
    clean = ratings_of([(1, 2, 3.0, 4), (1, 2, 3.0, 4), (5, 6, 0.5, 7)])
    assert rows_of(cleaning.clean_ratings(clean)) == rows_of(clean)


def test_dedupe_takes_the_latest_then_the_highest(ratings_of, rows_of):
    source = ratings_of([(1, 1, 5.0, 10), (1, 1, 2.0, 20), (1, 1, 3.0, 20), (1, 2, 1.0, 5)])
    expected = [(1, 1, 3.0, 20), (1, 2, 1.0, 5)]
    for partitions in (1, 7):
        assert rows_of(cleaning.dedupe_last(source.repartition(partitions))) == expected
    without_time = cleaning.dedupe_last(source.drop("timestamp"))
    assert rows_of(without_time) == [(1, 1, 5.0), (1, 2, 1.0)]


def test_observed_only_drops_zero_and_below(ratings_of):
    source = ratings_of([(1, 1, 0.0, 1), (1, 2, -1.0, 1), (1, 3, 0.5, 1)])
    assert [r["movieId"] for r in cleaning.observed_only(source).collect()] == [3]


def test_synthesized_users(ratings_of, rows_of):
    source = ratings_of([(1, 1, 1.0, 1), (1, 2, 1.0, 1), (2, 1, 1.0, 1)])
    assert rows_of(cleaning.synthesize_users(source)) == [(1, "unknown", -1), (2, "unknown", -1)]
