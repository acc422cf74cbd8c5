"""Both solvers: against dense linear algebra, and on ratings with a planted structure."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from starloom import Recommender
from starloom.operators.quality import rmse
from starloom.plans import evaluate as evaluation
from starloom.plans import model as models
from starloom.plans import plain_als, rating_blocks, runs
from starloom.plans.mllib_als import fit_factors, train_als
from starloom.sources import read_metrics, write_metrics
from workload import views


def vectors(factors):
    return {r["id"]: np.array(r["features"]) for r in factors.collect()}


def dense_half_step(triples, fixed, rank, reg, scaled):
    """Solve each entity on its own with a dense system; triples are (entity, other, rating)."""
    solved = {}
    for entity in {t[0] for t in triples}:
        rated = [(fixed[o], r) for e, o, r in triples if e == entity]
        v, r = np.array([x for x, _ in rated]), np.array([y for _, y in rated])
        ridge = reg * (len(rated) if scaled else 1) * np.eye(rank)
        solved[entity] = np.linalg.solve(v.T @ v + ridge, v.T @ r)
    return solved


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        np.testing.assert_allclose(found[key], value, rtol=1e-8, atol=1e-10)


@pytest.fixture
def small(ratings_of):
    """Repeated pairs, a zero rating, and user 9 and item 99 without any observed rating."""
    rng = np.random.default_rng(1)
    rows = [(int(u), int(i), float(r), t) for t, (u, i, r) in enumerate(
        zip(rng.integers(0, 8, 60), rng.integers(20, 30, 60), rng.integers(1, 6, 60)))]
    rows += [(9, 20, 0.0, 100), (1, 99, 0.0, 101), (2, 21, 5.0, 102), (2, 21, 0.0, 103)]
    return ratings_of(rows), rows


@pytest.mark.parametrize("scaled", [False, True])
@pytest.mark.parametrize("rank", [1, 3])
def test_half_step_equals_dense_solution(spark, small, scaled, rank):
    ratings, rows = small
    ids = ratings.select(F.col("movieId").alias("id")).distinct()
    fixed = plain_als.initial_factors(ids, rank, 7, "item", scale=1.0)
    found = plain_als.als_half_step(ratings, fixed, rank, 0.3, scaled, "user")
    expected = dense_half_step([r[:3] for r in rows], vectors(fixed), rank, 0.3, scaled)
    assert_same(vectors(found), expected)


@pytest.mark.parametrize("hot", [[], [3], [3, 5, 99]])
def test_half_step_moves_each_row_once(spark, small, monkeypatch, hot):
    """Single-precision factors as such, sums in double and of hot entities only; before, all sums were shuffled."""
    ratings, rows = small
    rng = np.random.default_rng(4)
    fixed = {i: [float(x) for x in rng.normal(size=3).astype(np.float32)] for i in sorted({r[1] for r in rows})}
    factors = spark.createDataFrame(list(fixed.items()), "id INT, features ARRAY<FLOAT>")
    monkeypatch.setattr(plain_als, "hot_keys", lambda df, *keys: dict.fromkeys(keys, hot))
    found = plain_als.als_half_step(ratings, factors, 3, 0.3, True, "user")
    assert_same(vectors(found), dense_half_step([r[:3] for r in rows], fixed, 3, 0.3, True))
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(id") == (2 if hot else 1)
    assert "_salt" not in plan


@pytest.mark.parametrize("broadcast_bytes,part", [(10_000_000, 1 << 16), (0, 1 << 16), (0, 3)])
def test_plain_als_equals_dense_iterations(small, monkeypatch, broadcast_bytes, part):
    """With and without broadcast; entities whole and in parts of few ratings."""
    monkeypatch.setattr(rating_blocks, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(rating_blocks, "PART_RATINGS", part)
    monkeypatch.setattr(rating_blocks, "CHUNK", 10)
    ratings, rows = small
    rank, reg = 3, 0.1
    run = plain_als.train_plain_als(ratings, rank, 3, reg, seed=5)
    last = {}
    for u, i, r, t in sorted(rows, key=lambda x: (x[3], x[2])):
        last[u, i] = r
    seen = [(u, i, r) for (u, i), r in last.items() if r > 0]
    users = vectors(plain_als.initial_factors(
        ratings.select(F.col("userId").alias("id")).distinct(), rank, 5, "user"))
    items = vectors(plain_als.initial_factors(
        ratings.select(F.col("movieId").alias("id")).distinct(), rank, 5, "item"))
    history = []
    for _ in range(3):
        users = users | dense_half_step(seen, items, rank, reg, False)
        items = items | dense_half_step([(i, u, r) for u, i, r in seen], users, rank, reg, False)
        errors = [users[u] @ items[i] - r for u, i, r in seen]
        history.append(float(np.sqrt(np.mean(np.square(errors)))))
    assert_same(vectors(run.model.users), users)
    assert_same(vectors(run.model.items), items)
    np.testing.assert_allclose([r["rmse"] for r in run.history.orderBy("iteration").collect()], history)


@pytest.mark.parametrize("scaled", [False, True])
@pytest.mark.parametrize("part", [1 << 16, 4])
def test_implicit_plain_als_equals_dense_iterations(ratings_of, monkeypatch, scaled, part):
    """A hot item in parts, a disliked pair, and an item without any rating but zero."""
    monkeypatch.setattr(rating_blocks, "PART_RATINGS", part)
    rng = np.random.default_rng(2)
    rows = [(u, 20, float(1 + u % 3), u) for u in range(12)]
    rows += [(int(u), int(i), 2.0, 50) for u, i in {(a, b) for a, b in rng.integers(0, 8, (25, 2))}]
    rows += [(3, 30, -2.0, 60), (4, 40, 0.0, 61)]
    rank, reg, alpha = 3, 0.2, 1.5
    ratings = ratings_of(rows)
    run = plain_als.train_plain_als(ratings, rank, 2, reg, scaled, seed=5, implicit=True, alpha=alpha)
    seen = [(u, i, r) for u, i, r, _ in rows if r]
    sides = [vectors(plain_als.initial_factors(ratings.select(F.col(c).alias("id")).distinct(), rank, 5, side))
             for c, side in (("userId", "user"), ("movieId", "item"))]

    def solve(triples, fixed):
        gram = sum(np.outer(v, v) for v in fixed.values())
        solved = {}
        for entity in {t[0] for t in triples}:
            own = [(fixed[o], r) for e, o, r in triples if e == entity]
            a = gram + sum(alpha * abs(r) * np.outer(v, v) for v, r in own)
            b = sum((1 + alpha * r) * v * (r > 0) for v, r in own)
            solved[entity] = np.linalg.solve(a + reg * (sum(r > 0 for _, r in own) if scaled else 1) * np.eye(rank), b)
        return solved

    history = []
    for _ in range(2):
        sides[0] = sides[0] | solve(seen, sides[1])
        sides[1] = sides[1] | solve([(i, u, r) for u, i, r in seen], sides[0])
        given = {(u, i): r for u, i, r in seen}
        weights = {(u, i): 1 + alpha * abs(given.get((u, i), 0.0)) for u in sides[0] for i in sides[1] if i != 40}
        loss = sum(w * ((given.get(p, 0.0) > 0) - sides[0][p[0]] @ sides[1][p[1]]) ** 2 for p, w in weights.items())
        history.append(float(np.sqrt(loss / sum(weights.values()))))
    assert_same(vectors(run.model.users), sides[0])
    assert_same(vectors(run.model.items), sides[1])
    np.testing.assert_allclose([r["rmse"] for r in run.history.orderBy("iteration").collect()], history, rtol=1e-6)


def test_initial_factors_look_normal(spark):
    ids = spark.range(4000).select(F.col("id").cast("int").alias("id"))
    values = np.array([r["features"] for r in plain_als.initial_factors(ids, 3, 1, "user").collect()])
    assert abs(values.mean()) < 0.005 and abs(values.std() - 0.1) < 0.005


@pytest.fixture(scope="module")
def planted(spark):
    """Ratings that follow the given rank-2 factors exactly, split by key hash."""
    source = views.ratings(spark, "/root/testdata/sf0.01").select("userId", "movieId").distinct()
    truth = models.FactorModel(views.user_factors(source), views.item_factors(source), 2)
    scored = models.predict(truth, source)
    rated = scored.select("userId", "movieId", (1 + 2 * F.col("prediction")).alias("rating")).cache()
    return views.train_test(rated)


def test_mllib_recovers_planted_structure(planted):
    train, test = planted
    model = models.from_mllib(train_als(train, rank=4, max_iter=10, reg=0.01))
    errors = evaluation.evaluate(model, test).first()
    assert errors["mae"] <= errors["rmse"] < 0.05


def test_plain_als_recovers_planted_structure(planted):
    train, test = planted
    run = plain_als.train_plain_als(train, rank=4, max_iter=10, reg=0.01)
    history = [r["rmse"] for r in run.history.orderBy("iteration").collect()]
    assert history == sorted(history, reverse=True)
    assert evaluation.evaluate(run.model, test).first()["rmse"] < 0.05


def test_same_seed_gives_the_same_model(spark, sf_dir):
    train, _ = views.train_test(views.ratings(spark, sf_dir))
    first = vectors(models.from_mllib(train_als(train, rank=3, max_iter=2)).users)
    second = vectors(models.from_mllib(train_als(train, rank=3, max_iter=2)).users)
    assert_same(first, second)


def test_implicit_predictions_are_preferences(spark, sf_dir):
    train, _ = views.train_test(views.ratings(spark, sf_dir))
    model = models.from_mllib(train_als(train, rank=3, max_iter=2, implicit=True))
    assert models.predict(model, train).agg(F.max("prediction")).first()[0] < 2.0


def test_cold_start_modes(spark):
    factors = spark.createDataFrame([(1, [2.0])], "id INT, features ARRAY<DOUBLE>")
    model = models.FactorModel(factors, factors, 1)
    pairs = spark.createDataFrame([(1, 1), (1, 5), (5, 1)], "userId INT, movieId INT")
    assert [r["prediction"] for r in models.predict(model, pairs).collect()] == [4.0]
    zero = models.predict(model, pairs, "zero").orderBy(F.desc("prediction")).collect()
    assert [r["prediction"] for r in zero] == [4.0, 0.0, 0.0]
    assert models.predict(model, pairs, "nan").where(F.isnan("prediction")).count() == 2
    with pytest.raises(ValueError):
        models.predict(model, pairs, "guess")


def test_evaluate_without_known_pairs(spark):
    factors = spark.createDataFrame([(1, [2.0])], "id INT, features ARRAY<DOUBLE>")
    test = spark.createDataFrame([(8, 9, 3.0)], "userId INT, movieId INT, rating DOUBLE")
    row = evaluation.evaluate(models.FactorModel(factors, factors, 1), test).first()
    assert (row["rmse"], row["mae"], row["n_pairs"]) == (None, None, 0)


def test_tune_finds_the_small_ridge(planted):
    train, test = planted
    result = evaluation.tune(train, test, {"rank": [4], "reg": [0.01, 1.0], "max_iter": [10]}, folds=2, parallelism=2)
    assert result.best_params == {"rank": 4, "reg": 0.01, "max_iter": 10}
    assert result.grid.where("chosen").count() == 1 and result.grid.count() == 2
    assert result.metrics.first()["rmse"] < 0.05
    assert result.seconds["tuning_time"] > 0


def test_tuning_reports_its_time(planted, spark):
    train, test = planted
    tuned = Recommender(spark)
    tuned.tune(train, test, grid={"rank": [2], "reg": [0.1], "max_iter": [2]}, folds=2)
    row = tuned.metrics.first()
    assert row["tuning_time"] > 0 and row["training_time"] > 0 and row["rmse"] > 0
    with pytest.raises(ValueError):
        Recommender(spark, "plain").tune(train, test)


def test_a_fold_without_error_is_an_error(ratings_of):
    alone = ratings_of([(i, i, 3.0, 1) for i in range(6)])  # no user of a fold is in the others
    with pytest.raises(ValueError, match="fold"):
        evaluation.tune(alone, alone, {"rank": [1], "reg": [0.1], "max_iter": [1]}, folds=2)


def test_models_do_not_depend_on_the_layout(planted, rows_of):
    train, _ = planted
    wide = rows_of(models.from_mllib(train_als(train.repartition(9), rank=2, max_iter=2)).users.select("id", F.round(F.col("features")[0], 3)))
    narrow = rows_of(models.from_mllib(train_als(train.coalesce(1), rank=2, max_iter=2)).users.select("id", F.round(F.col("features")[0], 3)))
    assert wide == narrow


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_any_ids_can_be_trained(planted, kind, rows_of):
    train, _ = planted
    coded = train.select(
        (F.col("userId") + 5_000_000_000).cast(kind).alias("userId"), (F.col("movieId") + 5_000_000_000).cast(kind).alias("movieId"), "rating"
    )
    model = fit_factors(coded, rank=2, max_iter=2)
    assert dict(model.users.dtypes)["id"] == kind
    assert {r[0] for r in rows_of(model.users.select("id"))} == {r[0] for r in rows_of(coded.select("userId"))}
    assert evaluation.evaluate(model, coded).first()["n_pairs"] == coded.count()


def test_solvers_refuse_what_they_cannot_do(ratings_of):
    some = ratings_of([(1, 1, 3.0, 1)])
    with pytest.raises(ValueError):
        runs.training_run(some, solver="mllib", scaled=True)
    with pytest.raises(ValueError):
        plain_als.als_half_step(some, some, 2, reg=0)
    with pytest.raises(ValueError):
        plain_als.train_plain_als(some, 2, reg=0, implicit=True)


def test_half_step_skips_null_ratings(spark, ratings_of):
    factors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id INT, features ARRAY<DOUBLE>")
    full = ratings_of([(1, 1, 3.0, 1), (1, 2, None, 1), (2, 2, 4.0, 1)])
    solved = {r["id"]: r["features"] for r in plain_als.als_half_step(full, factors, 2, 0.5).collect()}
    assert solved[1] == pytest.approx([2.0, 0.0]) and solved[2] == pytest.approx([0.0, 4 / 1.5])


def test_saved_models_predict_the_same(spark, sf_dir, tmp_path, rows_of):
    train, test = views.train_test(views.ratings(spark, sf_dir))
    fitted = train_als(train, rank=3, max_iter=2)
    before = rows_of(models.predict(models.from_mllib(fitted), test))
    for _ in range(2):  # a second save replaces the first
        models.save_mllib(fitted, f"{tmp_path}/mllib")
        models.save_factors(models.from_mllib(fitted), f"{tmp_path}/factors")
    loaded = models.from_mllib(models.load_mllib(f"{tmp_path}/mllib"))
    assert rows_of(models.predict(loaded, test)) == before
    assert rows_of(models.predict(models.load_factors(spark, f"{tmp_path}/factors"), test)) == before


@pytest.mark.parametrize("solver", ["mllib", "plain"])
def test_recommender_end_to_end(spark, sf_dir, tmp_path, solver):
    train, test = views.train_test(views.ratings(spark, sf_dir))
    rec = Recommender(spark, solver).train(train, test, rank=3, max_iter=2, num_partitions=4)
    metrics = rec.metrics.first()
    assert metrics["num_ratings"] == train.count() and metrics["rmse"] >= metrics["mae"] > 0
    assert metrics["total_time"] >= metrics["training_time"] > metrics["per_iteration_time"] > 0
    write_metrics(rec.metrics, f"{tmp_path}/metrics")
    assert read_metrics(spark, [f"{tmp_path}/metrics"], lines=True).first()["rmse"] == metrics["rmse"]
    movies = views.movies(spark, sf_dir)
    assert rec.recommend_for_user(7, 4, movies).columns[-2:] == ["title", "genres"]
    assert rec.recommend_for_user(7, 4).count() == 4
    assert rec.recommend_users_for_item(3, 4).count() == 4
    assert rec.similar_items(3, 4).count() == 4
    assert rec.recommend_for_all_users(2).count() == 300
    unseen = rec.recommend_excluding_rated(train, 2, "row")
    assert unseen.join(train, ["userId", "movieId"], "left_semi").count() == 0
    rec.save(f"{tmp_path}/model")
    again = Recommender(spark, solver).load(f"{tmp_path}/model")
    assert tuple(again.evaluate(test).first()) == pytest.approx(tuple(rec.evaluate(test).first()))
    assert rmse(rec.predict(test)).first()["rmse"] == pytest.approx(metrics["rmse"])


def test_untrained_recommender_raises(spark, sf_dir):
    rec = Recommender(spark)
    pairs = views.ratings(spark, sf_dir)
    for call in (
        lambda: rec.predict(pairs), lambda: rec.evaluate(pairs), lambda: rec.recommend_for_all_users(),
        lambda: rec.recommend_for_user(1), lambda: rec.recommend_excluding_rated(pairs),
        lambda: rec.save("/tmp/never-written"),
    ):
        with pytest.raises(ValueError, match="not been trained"):
            call()
    with pytest.raises(ValueError):
        Recommender(spark, "other")


def test_scaling_test_has_one_row_per_fraction(spark, sf_dir):
    report = runs.scaling_test(views.ratings(spark, sf_dir), [0.5, 1.0], rank=2, max_iter=1)
    rows = report.orderBy("fraction").collect()
    assert [r["fraction"] for r in rows] == [0.5, 1.0] and rows[0]["speedup"] == 1.0


def test_factors_of_a_batch_travel_as_one_row_per_block(spark):
    """Every factor reaches each of its blocks once, in a row per batch and block at most."""
    from starloom.plans.rating_blocks import arrived, by_block, gathered

    pairs = sorted({(i, (i * k) % 7) for i in range(400) for k in range(1, 6)})
    cuts = [0, 3, 4, 500, 501, len(pairs)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array([p[c] for p in pairs[a:b]], t) for c, t in ((0, pa.int64()), (1, pa.int32()))], ["id", "block"])
        for a, b in zip(cuts, cuts[1:])
    ]
    lists = list(gathered(pa.int64())(iter(batches)))
    routes = {r["id"]: r["blocks"] for batch in lists for r in batch.to_pylist()}
    assert sum(batch.num_rows for batch in lists) == 400
    assert routes == {i: [b for j, b in pairs if j == i] for i in range(400)}

    rows = pa.table({"id": list(routes), "blocks": pa.array(list(routes.values()), pa.list_(pa.int32())),
                     "features": [[float(i), -float(i)] for i in routes]})
    sent = pa.Table.from_batches(by_block(2)(iter(rows.to_batches(max_chunksize=150))))
    assert sent.num_rows <= 3 * 7
    for block in range(7):
        ids, vectors = arrived(sent.filter(pc.equal(sent["block"], block)), 2)
        assert sorted(ids.to_pylist()) == [i for i, b in pairs if b == block]
        assert vectors.tolist() == [[float(i), -float(i)] for i in ids.to_pylist()]
