"""A trained factor model: two factor tables, whichever solver produced them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.vectors import as_double_vector
from ..operators.joins import score_pairs
from ..schemas import Columns


@dataclass(frozen=True)
class FactorModel:
    """``users`` and ``items`` are (id, features array<double>) with one row per id."""

    users: DataFrame
    items: DataFrame
    rank: int
    cols: Columns = Columns()
    n_users: int | None = None  # row counts, where known; they decide what may be broadcast
    n_items: int | None = None

    def side_bytes(self) -> dict[str, int | None]:
        """Estimated bytes of both tables, by key column; None where the count isn't known."""
        row = 8 * self.rank + 64
        counts = {self.cols.user: self.n_users, self.cols.item: self.n_items}
        return {key: None if n is None else n * row for key, n in counts.items()}


def from_mllib(model: ALSModel, cols: Columns = Columns()) -> FactorModel:
    def factors(table: DataFrame) -> DataFrame:
        return table.select(F.col("id").cast("bigint").alias("id"), as_double_vector(F.col("features")).alias("features"))

    users, items = factors(model.userFactors), factors(model.itemFactors)
    return FactorModel(users, items, model.rank, cols, users.count(), items.count())


def require_model(model: FactorModel | None) -> FactorModel:
    if model is None:
        raise ValueError("the model has not been trained yet")
    return model


def predict(model: FactorModel, pairs: DataFrame, cold_start: str = "drop") -> DataFrame:
    """Score (user, item) rows. Rows with an unknown user or item are dropped, or scored 0 or NaN."""
    require_model(model)
    fill = {"drop": None, "zero": 0.0, "nan": float("nan")}
    if cold_start not in fill:
        raise ValueError("cold_start must be 'drop', 'zero' or 'nan'")
    how = "inner" if cold_start == "drop" else "left"
    scored = score_pairs(
        pairs, model.users, model.items, how=how, rank=model.rank, cols=model.cols,
        dim_bytes=model.side_bytes(),
    )
    if cold_start == "drop":
        return scored
    name = model.cols.prediction
    return scored.withColumn(name, F.coalesce(F.col(name), F.lit(fill[cold_start])))


def save_factors(model: FactorModel, path: str) -> None:
    """Write both factor tables as Parquet and the rank as JSON, replacing an older model."""
    require_model(model)
    model.users.write.mode("overwrite").parquet(f"{path}/user_factors")
    model.items.write.mode("overwrite").parquet(f"{path}/item_factors")
    spark = model.users.sparkSession
    spark.range(1).select(F.lit(model.rank).alias("rank")).write.mode("overwrite").json(f"{path}/meta")


def load_factors(spark: SparkSession, path: str, cols: Columns = Columns()) -> FactorModel:
    rank = spark.read.schema("rank INT").json(f"{path}/meta").first()["rank"]
    return FactorModel(
        spark.read.parquet(f"{path}/user_factors"),
        spark.read.parquet(f"{path}/item_factors"),
        rank,
        cols,
    )


def save_mllib(model: ALSModel | None, path: str) -> None:
    """MLlib's own model format, overwriting."""
    require_model(model)
    model.write().overwrite().save(path)


def load_mllib(path: str) -> ALSModel:
    """A saved model is read with the model class, not with the estimator's."""
    return ALSModel.load(path)
