"""Top-n matching against brute force, over several blocks and shards."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.operators import ranking
from starloom.plans import recommend
from starloom.plans.mllib_als import train_als
from starloom.plans.model import FactorModel, from_mllib
from starloom.schemas import Columns
from workload import views


def factor_table(spark, ids, matrix):
    rows = [(int(i), [float(x) for x in row]) for i, row in zip(ids, matrix)]
    return spark.createDataFrame(rows, "id INT, features ARRAY<DOUBLE>")


def brute_force(u, v, n, excluded=(), ties="row"):
    """{(user, item, score)} by scoring every pair one at a time."""
    best = set()
    for user, x in u.items():
        scored = []
        for item, y in v.items():
            if (user, item) not in excluded:
                total = 0.0
                for a, b in zip(x, y):
                    total += a * b
                scored.append((-total, item))
        scored.sort()
        if ties == "rank" and len(scored) > n:
            chosen = [s for s in scored if s[0] <= scored[n - 1][0]]
        else:
            chosen = scored[:n]
        best |= {(user, item, -s) for s, item in chosen}
    return best


@pytest.fixture(scope="module")
def data():
    """Small integer vectors, so that ties are common."""
    rng = np.random.default_rng(3)
    u = {int(i): list(map(float, row)) for i, row in zip(range(5, 65), rng.integers(-2, 3, (60, 3)))}
    v = {int(i): list(map(float, row)) for i, row in zip(range(100, 180), rng.integers(-2, 3, (80, 3)))}
    # User 5 has rated nearly everything; item 100 is rated by everyone.
    excluded = {(5, i) for i in list(v)[:-4]} | {(user, 100) for user in u}
    excluded |= {(int(a), int(b)) for a, b in zip(rng.integers(5, 65, 300), rng.integers(100, 180, 300))}
    return u, v, excluded


@pytest.mark.parametrize("ties", ["row", "rank"])
@pytest.mark.parametrize("sizes", [{}, {"block_rows": 7, "shard_rows": 11}])
@pytest.mark.parametrize("exclude", [False, True])
def test_top_matches_equals_brute_force(spark, data, ties, sizes, exclude):
    u, v, excluded = data
    pairs = spark.createDataFrame(sorted(excluded) * 2 + [(5, 999), (999, 100)], "left_id INT, right_id INT")
    found = recommend.top_matches(
        factor_table(spark, u, u.values()),
        factor_table(spark, v, v.values()),
        5,
        exclude=pairs if exclude else None,
        ties=ties,
        **sizes,
    )
    expected = brute_force(u, v, 5, excluded if exclude else (), ties)
    assert {tuple(r) for r in found.collect()} == expected
    assert found.count() == len(expected)


def test_scores_do_not_depend_on_block_sizes(spark, rows_of):
    rng = np.random.default_rng(0)
    u = factor_table(spark, range(90), rng.normal(size=(90, 10)))
    v = factor_table(spark, range(120), rng.normal(size=(120, 10)))
    whole = recommend.top_matches(u, v, 7)
    split = recommend.top_matches(u, v, 7, block_rows=13, shard_rows=17)
    assert rows_of(whole) == rows_of(split)


def test_fewer_unrated_items_than_n(spark, ratings_of):
    model = FactorModel(
        factor_table(spark, [1, 2], [[1.0], [2.0]]), factor_table(spark, [10, 11, 12], [[1.0], [2.0], [3.0]]), 1
    )
    train = ratings_of([(1, 10, 5.0, 1), (1, 11, 4.0, 1), (2, 10, 3.0, 1), (2, 11, 1.0, 1), (2, 12, 1.0, 1)])
    recs = recommend.recommend_excluding_rated(model, train, 10)
    assert [tuple(r) for r in recs.collect()] == [(1, 12, 3.0)]


def test_unknown_users_give_no_rows(spark):
    model = FactorModel(factor_table(spark, [1], [[1.0]]), factor_table(spark, [10], [[1.0]]), 1)
    ids = spark.createDataFrame([(1,), (99,)], "userId INT")
    assert [r["userId"] for r in recommend.recommend_for_users(model, ids, 5).collect()] == [1]


def test_item_lookup_returns_users(spark):
    model = FactorModel(
        factor_table(spark, [1, 2, 3], [[1.0], [5.0], [3.0]]), factor_table(spark, [10, 11], [[1.0], [2.0]]), 1
    )
    found = recommend.recommend_users_for_items(model, spark.createDataFrame([(11,)], "movieId INT"), 2)
    assert found.columns == ["movieId", "userId", "prediction"]
    assert {tuple(r) for r in found.collect()} == {(11, 2, 10.0), (11, 3, 6.0)}


def test_similar_items_excludes_itself_and_zero_vectors(spark):
    factors = factor_table(spark, [1, 2, 3, 4], [[1, 0], [2, 0.1], [0, 1], [0, 0]])
    found = recommend.similar_items(factors, factors.select(F.col("id").alias("movieId")), 1)
    assert {(r[0], r[1]) for r in found.collect()} == {(1, 2), (2, 1), (3, 2)}


def test_nested_form_round_trip(spark, rows_of):
    rows = [(1, 10, 2.0), (1, 11, 3.0), (1, 9, 2.0), (2, 10, 1.0)]
    flat = spark.createDataFrame(rows, "userId INT, movieId INT, prediction DOUBLE")
    nested = recommend.nest_recommendations(flat)
    first = nested.where("userId = 1").first()["recommendations"]
    assert [r["movieId"] for r in first] == [11, 9, 10]
    assert rows_of(recommend.flatten_recommendations(nested)) == sorted(rows, key=repr)


def test_mllib_agrees_on_a_trained_model(spark, sf_dir):
    """The library's own top-n gives the items MLlib's recommender gives."""
    train, _ = views.train_test(views.ratings(spark, sf_dir))
    fitted = train_als(train, rank=4, max_iter=2)
    model = from_mllib(fitted)
    own = recommend.recommend_all_users(model, 5)
    theirs = recommend.flatten_recommendations(fitted.recommendForAllUsers(5))
    joined = own.join(theirs.withColumnRenamed("prediction", "p"), ["userId", "movieId"])
    assert joined.count() >= 0.99 * own.count()
    assert joined.where("abs(prediction - p) > 1e-4").count() == 0
    unseen = recommend.recommend_excluding_rated(model, train, 5, "row")
    assert unseen.join(train, ["userId", "movieId"], "left_semi").count() == 0
    assert unseen.groupBy("userId").count().where("count > 5").count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_rank_keeps_ties_and_row_does_not(spark, partitions):
    rows = [(1, i, s) for i, s in ((1, 3.0), (2, 2.0), (3, 2.0), (4, 2.0), (5, 1.0))]
    preds = spark.createDataFrame(rows, "userId INT, movieId INT, prediction DOUBLE").repartition(partitions)
    by_rank = ranking.top_n_per_user(preds, 2, "rank")
    by_row = ranking.top_n_per_user(preds, 2, "row")
    assert {r["movieId"] for r in by_rank.collect()} == {1, 2, 3, 4}
    assert {r["movieId"] for r in by_row.collect()} == {1, 2}
    assert [r["movieId"] for r in ranking.top_n_for_user(preds, 1, 3).collect()] == [1, 2, 3]
    with pytest.raises(ValueError):
        ranking.top_n_per_user(preds, 2, "dense")


def test_other_column_names(spark):
    cols = Columns("u", "i", "r", "t", "score")
    model = FactorModel(factor_table(spark, [1], [[2.0]]), factor_table(spark, [7], [[3.0]]), 1, cols)
    assert recommend.recommend_all_users(model, 1).columns == ["u", "i", "score"]


def clustered(spark, n, rank, seed, base):
    """Vectors of very different lengths, some of them equal and some zero."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, rank)) * rng.lognormal(0, 1.5, size=(n, 1))
    rows[: n // 20] = rows[0]
    rows[n // 20 : n // 15] = 0.0
    table = [(base + i, [float(x) for x in row]) for i, row in enumerate(rows)]
    return spark.createDataFrame(table, "id INT, features ARRAY<DOUBLE>"), rows


@pytest.mark.parametrize("ties", ["row", "rank"])
@pytest.mark.parametrize("shard_rows", [100_000, 150])
def test_pruning_by_length_changes_no_row(spark, monkeypatch, ties, shard_rows):
    monkeypatch.setattr(recommend, "BUCKET_ROWS", 32)
    queries, u = clustered(spark, 90, 4, 1, 0)
    targets, v = clustered(spark, 700, 4, 2, 1000)
    seen = [(i, 1000 + j) for i in range(90) for j in range(i % 3, 700, 5)]
    exclude = spark.createDataFrame(seen, "left_id INT, right_id INT")
    found = recommend.top_matches(queries, targets, 7, exclude=exclude, ties=ties, shard_rows=shard_rows)
    found = {(r["left_id"], r["right_id"]): r["score"] for r in found.collect()}
    scores = np.zeros((90, 700))
    for k in range(4):
        scores += u[:, [k]] * v[:, k]
    left_out = set(seen)
    wanted = {}
    for i in range(90):
        order = [j for j in np.lexsort((np.arange(700), -scores[i])) if (i, 1000 + j) not in left_out]
        last = scores[i, order[6]]
        best = order[:7] if ties == "row" else [j for j in order if scores[i, j] >= last]
        wanted |= {(i, 1000 + j): scores[i, j] for j in best}
    assert found == wanted


def test_pruning_saves_products(spark):
    queries, _ = clustered(spark, 500, 4, 1, 0)
    targets, _ = clustered(spark, 20_000, 4, 2, 1000)
    work = recommend.matching_work(queries, targets, 5).first()
    assert work["possible"] == 500 * 20_000 and work["computed"] < 0.6 * work["possible"]
    assert recommend.matching_work(queries.limit(0), targets, 5).first()["possible"] == 0


@pytest.mark.parametrize("ties", ["row", "rank"])
def test_ties_leave_a_task_a_few_at_a_time(spark, monkeypatch, ties):
    """A third of the users tie with every item; their candidates are cut before the next ones come."""
    rng = np.random.default_rng(5)
    u = {i: [0.0, 0.0] if i % 3 == 0 else list(map(float, rng.integers(0, 3, 2))) for i in range(60)}
    v = {i: list(map(float, rng.integers(0, 3, 2))) for i in range(400)}
    plain, seen = np.lexsort, []
    monkeypatch.setattr(recommend, "HELD_CANDIDATES", 500)
    monkeypatch.setattr(recommend, "BUCKET_ROWS", 50)
    monkeypatch.setattr(recommend.np, "lexsort", lambda keys: seen.append(len(keys[0])) or plain(keys))

    def rows(side, ids, vectors):
        left, right = (ids, [None] * len(ids)) if side == recommend.QUERY else ([None] * len(ids), ids)
        columns = [left, vectors, [-np.inf] * len(ids), [None] * len(ids), right, [side] * len(ids)]
        names = ["left_id", "features", "floor", "excluded", "right_id", "side"]
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.list_(pa.int64()), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    step = recommend._block_matcher(5, ties == "rank", False)
    batches = [rows(recommend.QUERY, list(u), list(u.values())), rows(recommend.TARGET, list(v), list(v.values()))]
    found = [tuple(r.values()) for batch in step(iter(batches)) for r in batch.to_pylist()]
    assert sorted(found) == sorted(brute_force(u, v, 5, ties=ties))
    assert max(seen) <= 500 + 60 * 50  # before: all candidates of the block at once
    assert len(seen) > 1


def test_scores_in_single_precision_only_choose_candidates(spark):
    """Vectors of any size, and targets that differ beyond single precision, come in their exact order."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(1, 5))
    v = np.concatenate([base + 1e-11 * rng.normal(size=(300, 5)), 1e-150 * rng.normal(size=(50, 5)), np.zeros((3, 5))])
    u = np.concatenate([base * s + rng.normal(size=(6, 5)) * s * 1e-3 for s in (1.0, 1e140, 1e-140)] + [np.zeros((2, 5))])
    users, items = dict(enumerate(u.tolist())), dict(enumerate(v.tolist()))
    found = recommend.top_matches(factor_table(spark, users, u), factor_table(spark, items, v), 5)
    assert {tuple(r) for r in found.collect()} == brute_force(users, items, 5)


def test_excluded_pairs_are_listed_once_and_only_for_the_targets_at_hand(spark, monkeypatch):
    """Copies of a pair leave as one entry; the search of the longest targets gets their pairs alone, before: all."""
    rows = spark.createDataFrame([(1, 7)] * 500 + [(1, 8), (2, 7), (2, 9)], "left_id BIGINT, right_id BIGINT")
    rows = rows.withColumn("shard", F.lit(0)).coalesce(1).sortWithinPartitions("left_id", "shard", "right_id")
    lists = rows.mapInArrow(recommend._listed, "left_id bigint, shard int, excluded array<bigint>").collect()
    assert [tuple(r) for r in lists] == [(1, 0, [7, 8]), (2, 0, [7, 9])]
    seen, best = [], recommend._Tiles.best
    monkeypatch.setattr(
        recommend._Tiles, "best", lambda self, *rest: seen.append(self.exclude.count()) or best(self, *rest)
    )
    lengths = np.arange(1.0, 101.0)[:, None]
    pairs = spark.createDataFrame([(i, j) for i in range(4) for j in range(100)], "left_id INT, right_id INT")
    queries, targets = factor_table(spark, range(4), np.ones((4, 1))), factor_table(spark, range(100), lengths)
    assert recommend.top_matches(queries, targets, 3, exclude=pairs, shard_rows=20).count() == 0
    assert seen[0] < 100 and seen[1] == 400


@pytest.mark.parametrize("rank", [1, 2, 10])
def test_a_tile_is_bounded_in_whole_rows(rank):
    """The rows of a block, with their keys, take no more than a tile's bytes; short vectors did, times six."""
    n = recommend.tile_rows(rank)
    keys, ids = pa.array(np.zeros(n, np.int32)), pa.array(np.arange(n))
    features = pa.ListArray.from_arrays(pa.array(np.arange(0, rank * n + 1, rank, dtype=np.int32)), pa.array(np.zeros(rank * n)))
    excluded = pa.nulls(n, pa.list_(pa.int64()))
    rows = pa.table([keys, ids, features, pa.array(np.zeros(n)), excluded, keys, keys], ["b", "i", "f", "l", "e", "s", "k"])
    assert n > 1024 and rows.nbytes <= recommend.TILE_BYTES


def test_tied_rows_leave_their_task_without_being_stored(spark, monkeypatch):
    """The n-th best scores are found first, n rows per query; before, all tied rows were stored and a task held its own."""
    u, v = {i: [1.0, i / 7] for i in range(20)}, {i: [1.0, float(i % 3 == 0)] for i in range(90)}
    stored, cut = [], recommend.cut_lineage
    monkeypatch.setattr(recommend, "cut_lineage", lambda rows: stored.append(rows.count()) or cut(rows))
    users, items = factor_table(spark, u, u.values()), factor_table(spark, v, v.values())
    found = recommend.top_matches(users, items, 4, ties="rank", shard_rows=10)
    assert {tuple(r) for r in found.collect()} == brute_force(u, v, 4, ties="rank") and found.count() == 30 * 19 + 90
    assert max(stored) <= 4 * len(u)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "CoGroups" not in plan


def test_excluded_pairs_of_an_id_are_one_list_over_batches():
    """Rows of an id that go on in the next batch, with a copy at the edge; before, a list per batch."""
    rows = [(1, 0, 7), (1, 0, 7), (1, 0, 7), (1, 0, 8), (1, 1, 9), (2, 0, 7)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(["left_id", "shard", "right_id"], r)) for r in some]) for some in (rows[:2], [], rows[2:])[::2]]
    lists = [tuple(r.values()) for batch in recommend._listed(iter(batches)) for r in batch.to_pylist()]
    assert lists == [(1, 0, [7, 8]), (1, 1, [9]), (2, 0, [7])]


def test_a_query_meets_only_buckets_and_ranges_near_its_direction(spark, monkeypatch):
    """Targets near a line across the queries' directions; before, a query met every bucket and shard that one length allowed."""
    rng = np.random.default_rng(8)
    share = rng.random(4000)
    v = np.c_[share, 1 - share] + 0.05 * rng.random((4000, 2))
    turn = rng.uniform(0, np.pi / 2, 600)
    u = np.c_[np.cos(turn), np.sin(turn)]
    users, items = factor_table(spark, range(600), u), factor_table(spark, range(4000), v)
    monkeypatch.setattr(recommend, "BUCKET_ROWS", 64)
    monkeypatch.setattr(recommend, "SCORES_AT_ONCE", 64 * 64)
    work = recommend.matching_work(users, items, 3, block_rows=600).first()
    assert work["computed"] < 0.12 * work["possible"]  # before: 0.17
    met, best = [], recommend._Tiles.best
    monkeypatch.setattr(recommend._Tiles, "best", lambda self, *rest: met.append(rest[2]) or best(self, *rest))
    found = recommend.top_matches(users, items, 3, shard_rows=400).collect()
    exact = brute_force(dict(enumerate(u.tolist())), dict(enumerate(v.tolist())), 3)
    assert {tuple(r) for r in found} == exact
    assert met[0] == [600] and len(met[1]) == 9 and sum(met[1]) < 0.5 * 9 * 600  # before: all nine for every open query
