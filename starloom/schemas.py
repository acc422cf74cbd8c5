"""Explicit schemas of every table the library reads or writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Columns:
    """Column names of a rating table and of the predictions made for it."""

    user: str = "userId"
    item: str = "movieId"
    rating: str = "rating"
    timestamp: str = "timestamp"
    prediction: str = "prediction"


INT, LONG, DOUBLE, STRING = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RATINGS = _struct(userId=LONG, movieId=LONG, rating=DOUBLE, timestamp=LONG)
TRIPLES = _struct(userId=LONG, movieId=LONG, rating=DOUBLE)
MOVIES = _struct(movieId=LONG, title=STRING, genres=STRING)
USERS = _struct(userId=LONG, gender=STRING, age=INT)
RECOMMENDATIONS = _struct(userId=LONG, movieId=LONG, prediction=DOUBLE)

N_GENRE_FLAGS = 19
GENRE_FLAG_COLUMNS = [f"genre_{i}" for i in range(N_GENRE_FLAGS)]

# Raw layouts. The two user files carry the same columns in different orders.
MOVIES_WIDE = _struct(
    movieId=LONG, title=STRING, release_date=STRING, video_release_date=STRING, IMDb_URL=STRING,
    **dict.fromkeys(GENRE_FLAG_COLUMNS, INT),
)
USERS_PIPE = _struct(userId=LONG, age=INT, gender=STRING, occupation=STRING, zip_code=STRING)
USERS_DAT = _struct(userId=LONG, gender=STRING, age=INT, occupation=INT, zip_code=STRING)
USER_DETAIL_COLUMNS = ["userId", "age", "gender", "occupation", "zip_code"]

# Names of the recorded run metrics.
RUN_METRICS = _struct(
    training_time=DOUBLE, per_iteration_time=DOUBLE, tuning_time=DOUBLE, total_time=DOUBLE,
    num_ratings=LONG, num_users=LONG, num_items=LONG, rmse=DOUBLE, mae=DOUBLE,
)

# Genre names in the order of the 0/1 flags. Pass other names to
# ``genres_from_flags`` when a dump's own genre file lists them differently.
GENRE_NAMES = [
    "Action", "Adventure", "Animation", "Children", "Comedy", "Crime", "Documentary",
    "Drama", "Fantasy", "Film-Noir", "Horror", "Musical", "Mystery", "Romance", "Sci-Fi",
    "Thriller", "War", "Western", "Unknown",
]
