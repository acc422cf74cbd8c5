"""The stacked search gives the errors of fits on one fold after another."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starloom import Recommender
from starloom.operators.cleaning import dedupe_last, observed_only
from starloom.operators.splits import kfold_assign
from starloom.plans import evaluate as evaluation
from starloom.plans import rating_blocks
from starloom.plans.fold_search import fold_errors
from starloom.plans.plain_als import train_plain_als

GRID = {"rank": [2, 3], "reg": [0.05, 0.5], "max_iter": [1, 3]}


@pytest.fixture
def uneven(ratings_of):
    """A hot item, users of one rating, a repeated pair and an unobserved rating."""
    rows = [(u, 1, float(1 + u % 5), u) for u in range(300)]
    rows += [(u, 2 + (u * 7 + j) % 23, float(1 + (u * j) % 5), u) for u in range(120) for j in range(4)]
    rows += [(3, 1, 5.0, 900), (400, 90, 4.0, 1), (401, 1, 0.0, 1)]
    return ratings_of(rows)


def one_by_one(ratings, combo, folds, scaled):
    observed = observed_only(dedupe_last(ratings)).select("userId", "movieId", "rating")
    folded = kfold_assign(observed, folds, 42)
    out = []
    for fold in range(folds):
        run = train_plain_als(folded.where(F.col("fold") != fold), **combo, scaled=scaled, seed=42, track_rmse=False)
        out.append(evaluation.evaluate(run.model, folded.where(F.col("fold") == fold)).first()["rmse"])
    return out


@pytest.mark.parametrize("scaled", [True, False])
def test_errors_equal_those_of_single_fits(uneven, scaled):
    found = fold_errors(uneven, GRID, folds=2, scaled=scaled)
    assert [c for c, _ in found][:3] == [
        {"rank": 2, "reg": 0.05, "max_iter": 1}, {"rank": 2, "reg": 0.05, "max_iter": 3},
        {"rank": 2, "reg": 0.5, "max_iter": 1},
    ]
    for combo, errors in (found[1], found[6]):
        assert errors == pytest.approx(one_by_one(uneven, combo, 2, scaled), rel=1e-7)


def test_hot_items_split_over_blocks(uneven, monkeypatch):
    grid = {"rank": [2], "reg": [0.1], "max_iter": [2]}
    whole = fold_errors(uneven, grid, folds=3)
    monkeypatch.setattr(rating_blocks, "PART_RATINGS", 40)
    assert fold_errors(uneven, grid, folds=3)[0][1] == pytest.approx(whole[0][1], rel=1e-9)


def test_folds_without_known_pairs_and_empty_tables(ratings_of, uneven):
    grid = {"rank": [1], "reg": [0.1], "max_iter": [1]}
    alone = ratings_of([(i, i, 3.0, 1) for i in range(6)])
    assert fold_errors(alone, grid, folds=2)[0][1] == [None, None]
    assert fold_errors(alone.limit(0), grid, folds=2)[0][1] == [None, None]
    with pytest.raises(ValueError, match="fold"):
        evaluation.tune_stacked(alone, alone, grid, folds=2)
    with pytest.raises(ValueError, match="reg"):
        fold_errors(uneven, {"reg": [0.0]})
    with pytest.raises(ValueError, match="alpha"):
        fold_errors(uneven, {"alpha": [1.0]})


def test_the_recommender_keeps_the_best_model(spark, uneven):
    tuned = Recommender(spark, "plain")
    result = tuned.tune_stacked(uneven, uneven, grid={"rank": [2], "reg": [0.1, 50.0], "max_iter": [2]}, folds=2)
    assert result.best_params["reg"] == 0.1 and tuned.metrics.first()["tuning_time"] > 0
    assert tuned.predict(uneven.limit(5)).count() > 0
    with pytest.raises(ValueError):
        Recommender(spark).tune_stacked(uneven, uneven)
