"""Hard negatives and approximate nearest neighbours against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import hard_negatives, stable_search
from starloom.llm.oracles import SQL
from starloom.llm.queries import QUERIES

FIELDS = "id BIGINT, label INT, vector ARRAY<DOUBLE>"


def plain_negatives(rows, anchor, n_positives=5, n_negatives=3, percent=(50, 95)):
    """rows: (id, label, whole vector), ids once."""
    out = set()
    for a, label, u in rows:
        if not anchor(a):
            continue
        scored = sorted(
            ((-sum(int(x) * int(y) for x, y in zip(u, v)), i, other) for i, other, v in rows if i != a)
        )
        for s, p, _ in [t for t in scored if t[2] == label][:n_positives]:
            fits = [t for t in scored if t[2] != label and percent[0] * -s <= 100 * -t[0] <= percent[1] * -s]
            for rank, (t, i, _) in enumerate(fits[:n_negatives], 1):
                out.add((a, p, rank, i, -s, -t))
    return out


def plain_nearest(rows, asked, k):
    out = {}
    for q, u in rows:
        if asked(q):
            scored = []
            for i, v in rows:
                if i != q:
                    score = 0.0
                    for x, y in zip(u, v):
                        score += x * y
                    scored.append((-score, i))
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def recall(found, wanted):
    hits = sum(len({i for i, _ in wanted[q]} & {i for i, _ in found.get(q, [])}) for q in wanted)
    return hits / max(1, sum(map(len, wanted.values())))


def answers(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_negatives_query_equals_sql(spark, size):
    sf_dir = f"/root/testdata/{size}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    wanted = set(con.execute(SQL["op12_hard_negatives"]).fetchall())
    assert {tuple(r) for r in QUERIES["op12_hard_negatives"](spark, sf_dir).collect()} == wanted


def test_negatives_of_clustered_rows_in_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHARD_CELLS", 8 * 60)
    monkeypatch.setattr(hard_negatives, "SLOT_CELLS", 8 * 24)
    monkeypatch.setattr(hard_negatives, "BLOCK", 6)
    rng = np.random.default_rng(3)
    middle = rng.integers(-300, 300, (5, 8))
    vectors = (middle[rng.integers(0, 5, 400)] + rng.integers(-9, 9, (400, 8))).tolist()
    vectors[40:90] = [vectors[40]] * 50  # a group of copies, ties by id
    rows = [(i, int(rng.integers(0, 3)), v) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "id BIGINT, label INT, vector ARRAY<BIGINT>").repartition(4)
    found = {tuple(r) for r in hard_negatives.mine(frame, F.col("id") % 5 == 0).collect()}
    assert found == plain_negatives(rows, lambda i: i % 5 == 0)


def test_a_walk_ends_early_and_misses_nothing():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-40, 40, (20_000, 6))
    vectors[:, 0] += np.where(np.arange(20_000) % 4 == 0, 1000, -1000)
    shard = hard_negatives.Shard(np.arange(20_000), np.zeros(20_000, int), vectors, True)
    anchors = vectors[:80:4].astype(float)
    order, bounds = shard.listed(hard_negatives.directions(anchors))
    low = np.full((len(anchors), 1), shard.low + 1)
    best, scored = shard.walk(anchors, order, bounds, None, low, -low, 3)
    exact = np.sort(anchors @ vectors.T, axis=1)[:, ::-1][:, :3]
    assert (best[:, 0] // 20_000 == exact).all()
    assert scored < len(anchors) * 20_000 / 2


def test_negatives_edges(spark):
    rows = [
        (0, 1, [3, 4]), (0, 1, [3, 4]), (0, 2, [9, 9]), (1, 1, [3, 3]), (2, 2, [2, 2]), (3, 2, [1, 1, 7]), (4, 2, []),
        (5, None, [1, 1]), (6, 1, None), (7, 1, [1, None]), (None, 1, [5, 5]), (8, 1, [0, 0]), (9, 2, [-1, -1]), (10, 2, [2, 2]),
    ]
    frame = spark.createDataFrame(rows, "id BIGINT, label INT, vector ARRAY<BIGINT>")
    frame = frame.withColumns({name: F.lit(1) for name in ("slot", "shard", "cand_id", "anchor_id", "block")})
    kept = [(0, 1, [3, 4]), (1, 1, [3, 3]), (2, 2, [2, 2]), (3, 2, [1, 1, 7]), (4, 2, []), (8, 1, [0, 0]), (9, 2, [-1, -1]), (10, 2, [2, 2])]
    found = {tuple(r) for r in hard_negatives.mine(frame, F.col("id") % 2 == 0).collect()}
    assert found == plain_negatives(kept, lambda i: i % 2 == 0)
    assert hard_negatives.mine(frame.limit(0), F.col("id") % 2 == 0).collect() == []
    assert hard_negatives.mine(frame, F.lit(False)).collect() == []


def test_negatives_of_huge_components_are_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, i % 2, [int(x) * 10**8 + int(x) for x in rng.integers(-9, 9, 4)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "id BIGINT, label INT, vector ARRAY<BIGINT>")
    found = {tuple(r) for r in hard_negatives.mine(frame, F.col("id") % 6 == 0).collect()}
    assert found == plain_negatives(rows, lambda i: i % 6 == 0)


def test_whole_components(spark):
    frame = spark.createDataFrame([([0.5, -0.001, 1e300, 0.00390625],)], "v ARRAY<DOUBLE>")
    assert frame.select(hard_negatives.whole_components(F.col("v"))).first()[0] == [128, -1, 2**63 - 1, 1]


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_search_query_has_recall_and_exact_scores(spark, size):
    sf_dir = f"/root/testdata/{size}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    wanted = plain_nearest(rows, lambda i: i % 20 == 0, 20)
    found = answers(QUERIES["op13_stable_search"](spark, sf_dir))
    assert recall(found, wanted) >= 0.9
    score = {q: dict(own) for q, own in plain_nearest(rows, lambda i: i % 200 == 0, len(rows)).items()}
    assert all(score[q][i] == s for q in score for i, s in found[q])
    assert all(own == sorted(own, key=lambda t: (-t[1], t[0])) and len(own) == 20 for own in found.values())


def test_search_of_unequal_lengths_in_many_cells_and_parts(spark, monkeypatch):
    for name, value in (("BUCKET", 64), ("LEAST_SAMPLED", 8), ("SLOT", 20), ("LEAF", 4)):
        monkeypatch.setattr(stable_search, name, value)
    rng = np.random.default_rng(11)
    vectors = rng.standard_normal((1500, 12)) * rng.uniform(0.2, 3, (1500, 1))
    vectors[100:500] = vectors[100]  # a group of copies
    vectors[500:700] = vectors[500] + rng.standard_normal((200, 12)) * 1e-6
    rows = list(enumerate(vectors.tolist()))
    frame = spark.createDataFrame(rows, "id BIGINT, vector ARRAY<DOUBLE>").repartition(4)
    found = answers(stable_search.nearest(frame, F.col("id") % 10 == 0, k=8))
    wanted = plain_nearest(rows, lambda i: i % 10 == 0, 8)
    assert set(found) == set(wanted) and recall(found, wanted) >= 0.9
    inside = [q for q in wanted if wanted[q][0][0] == 100 or q == 100]
    assert inside and all(found[q] == wanted[q] for q in inside if all(100 <= i < 500 for i, _ in wanted[q]))


def test_a_search_skips_leaves_where_rows_cluster():
    rng = np.random.default_rng(4)
    middle = rng.standard_normal((40, 16))
    vectors = middle[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 16)) * 0.03
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    projection = stable_search.Projection(16, 1.0, 1.0)
    bucket = stable_search.Bucket(np.arange(4000), vectors, projection)
    queries = vectors[::40]
    limit = stable_search.chi_square_quantile(0.95)
    scores, ids, verified = bucket.search(queries, np.full(100, -np.inf), 10, limit)
    wanted = np.argsort(-(queries @ vectors.T), axis=1)[:, :10]
    assert np.mean([len({*a} & {*b}) for a, b in zip(ids.tolist(), wanted.tolist())]) >= 9
    assert verified < 100 * 4000 / 4


def test_chi_square_quantile():
    assert stable_search.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert stable_search.chi_square_quantile(0.5, 2) == pytest.approx(2 * np.log(2))


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]),
        (6, [1.0, None]), (7, [inf, 1.0]), (8, []), (None, [1.0, 1.0]), (20, [-1.0, -1.0]), (40, [3.0, 0.0, 1.0]),
    ]
    frame = spark.createDataFrame(rows, "id BIGINT, vector ARRAY<DOUBLE>")
    frame = frame.withColumns({name: F.lit(1) for name in ("cell", "part", "slot", "query", "known", "rank", "asked")})
    kept = [(0, [1.0, 2.0, 0.0]), (1, [1.0, 2.0, 0.0]), (2, [2.0, 0.0, 0.0]), (20, [-1.0, -1.0, 0.0]), (40, [3.0, 0.0, 1.0])]
    found = answers(stable_search.nearest(frame, F.col("id") % 20 == 0))
    assert found == plain_nearest(kept, lambda i: i % 20 == 0, 20)
    assert stable_search.nearest(frame.limit(0), F.col("id") % 20 == 0).collect() == []
    assert stable_search.nearest(frame.filter("id = 3"), F.lit(True)).collect() == []
    assert stable_search.nearest(frame.filter("id = 1"), F.lit(True)).collect() == []
