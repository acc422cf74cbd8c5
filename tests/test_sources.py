"""Raw files as they come: separators, latin-1, quotes, missing files; and the preparation job."""

import os

import pytest

from starloom import sources
from starloom.plans import preparation
from starloom.schemas import MOVIES, RATINGS, RUN_METRICS


def put(path, text, encoding="latin-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as out:
        out.write(text)
    return str(path)


RATING_ROWS = [(1, 10, 3.5, 100), (1, 11, 5.0, 101), (2, 10, 0.5, 102), (3, 12, 4.0, 103), (2, 12, 1.0, 104)]


def rating_lines(sep):
    return "".join(sep.join(map(str, r)) + "\n" for r in RATING_ROWS)


def make_dump(root, size):
    flags = ["0"] * 19
    flags[0] = flags[5] = "1"
    if size == "100k":
        put(f"{root}/ml-100k/u.data", rating_lines("\t"))
        put(f"{root}/ml-100k/u.item", "".join(
            f"{i}|Café {i}|01-Jan-1995||http://x/{i}|{'|'.join(flags)}\n" for i in (10, 11, 12)))
        put(f"{root}/ml-100k/u.user", "1|24|M|technician|85711\n2|53|F|other|T8H1N\n3|30|M|writer|00501\n")
        return
    if size == "25m":
        put(f"{root}/ml-25m/ratings.csv", "userId,movieId,rating,timestamp\n" + rating_lines(","), "utf-8")
        put(f"{root}/ml-25m/movies.csv", 'movieId,title,genres\n10,"Usual, The ""Real"" One (1995)",Crime|Drama\n'
            "11,Amélie,Comedy\n12,Plain,Drama\n", "utf-8")
        return
    folder = {"1m": "ml-1m", "10m": "ml-10M100K"}[size]
    put(f"{root}/{folder}/ratings.dat", rating_lines("::"))
    put(f"{root}/{folder}/movies.dat", '10::Café: "Noir" (1995)::Crime|Drama\n11::B::Comedy\n12::C::Drama\n')
    if size == "1m":
        put(f"{root}/{folder}/users.dat", "1::M::24::7::85711\n2::F::53::0::T8H1N\n3::M::30::1::00501\n")


@pytest.mark.parametrize("fmt,sep,header", [("tsv", "\t", ""), ("dat", "::", ""), ("csv", ",", "userId,movieId,rating,timestamp\n")])
def test_rating_formats(spark, tmp_path, rows_of, fmt, sep, header):
    path = put(f"{tmp_path}/ratings.{fmt}", header + rating_lines(sep))
    found = sources.read_ratings(spark, path, fmt)
    assert found.schema == RATINGS and rows_of(found) == sorted(RATING_ROWS, key=repr)


def test_unreadable_fields_become_null(spark, tmp_path):
    path = put(f"{tmp_path}/r.dat", "1::2::bad::4\n1::2::3.0::4\n")
    assert sources.read_ratings(spark, path, "dat").where("rating IS NULL").count() == 1


def test_titles_keep_accents_commas_and_quotes(spark, tmp_path):
    for size in ("1m", "25m"):
        make_dump(tmp_path, size)
    _, movies, _ = sources.read_dataset(spark, str(tmp_path), "1m")
    assert movies.schema == MOVIES
    assert movies.where("movieId = 10").first()["title"] == 'Café: "Noir" (1995)'
    _, movies, _ = sources.read_dataset(spark, str(tmp_path), "25m")
    titles = {r["movieId"]: r["title"] for r in movies.collect()}
    assert titles[10] == 'Usual, The "Real" One (1995)' and titles[11] == "Amélie"


def test_user_formats_come_in_one_column_order(spark, tmp_path):
    for size in ("100k", "1m"):
        make_dump(tmp_path, size)
    for size in ("100k", "1m"):
        _, _, users = sources.read_dataset(spark, str(tmp_path), size)
        assert users.columns == ["userId", "age", "gender", "occupation", "zip_code"]
        second = users.where("userId = 2").first()
        assert (second["age"], second["gender"], second["zip_code"]) == (53, "F", "T8H1N")


@pytest.mark.parametrize("size", ["10m", "25m"])
def test_sizes_without_user_file(spark, tmp_path, rows_of, size):
    make_dump(tmp_path, size)
    _, _, users = sources.read_dataset(spark, str(tmp_path), size)
    assert rows_of(users) == [(i, "unknown", -1) for i in (1, 2, 3)]


def test_missing_and_unknown_datasets(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown dataset size"):
        sources.read_dataset(spark, str(tmp_path), "5m")
    with pytest.raises(FileNotFoundError):
        sources.read_dataset(spark, str(tmp_path), "1m")
    os.makedirs(f"{tmp_path}/ml-1m")
    with pytest.raises(FileNotFoundError, match="ratings.dat"):
        sources.read_dataset(spark, str(tmp_path), "1m")
    with pytest.raises(ValueError, match="unknown format"):
        sources.read_ratings(spark, str(tmp_path), "xml")


def test_metrics_files_pretty_or_in_lines_and_missing(spark, tmp_path):
    pretty = put(f"{tmp_path}/a/metrics.json", '{\n  "rmse": 0.9,\n  "num_ratings": 5\n}\n')
    found = sources.read_metrics(spark, [pretty, f"{tmp_path}/none.json"])
    assert found.schema == RUN_METRICS
    assert (found.first()["rmse"], found.first()["num_ratings"], found.first()["mae"]) == (0.9, 5, None)
    empty = sources.read_metrics(spark, [f"{tmp_path}/none.json"])
    assert empty.schema == RUN_METRICS and empty.count() == 0


def test_metrics_written_in_lines_are_all_read(spark, tmp_path):
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "rmse DOUBLE").coalesce(1)
    sources.write_metrics(rows, f"{tmp_path}/lines")
    found = sources.read_metrics(spark, [f"{tmp_path}/lines", f"{tmp_path}/none"], lines=True)
    assert sorted(r["rmse"] for r in found.collect()) == [1.0, 2.0, 3.0]


def test_writers_replace_older_output(spark, tmp_path):
    for n in (5, 2):
        frame = spark.range(n)
        sources.write_csv(frame, f"{tmp_path}/csv")
        sources.write_parquet(frame, f"{tmp_path}/parquet")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).count() == 2
    assert spark.read.parquet(f"{tmp_path}/parquet").count() == 2


@pytest.mark.parametrize("size", sources.DATASET_SIZES)
def test_preprocess_writes_every_table(spark, tmp_path, rows_of, size):
    make_dump(tmp_path / "raw", size)
    report = preparation.preprocess(spark, f"{tmp_path}/raw", size, f"{tmp_path}/out", test_size=0.4)
    assert tuple(report.first())[:5] == (3, 3, 5, 3, 2)
    base = f"{tmp_path}/out/{size}"
    train, test = sources.read_split(spark, f"{base}/tables")
    assert rows_of(train.unionByName(test)) == sorted(RATING_ROWS, key=repr)
    for part in ("train_ratings", "test_ratings"):
        parquet, csv = (spark.read.parquet(f"{base}/tables/{part}.parquet"),
                        spark.read.csv(f"{base}/interim/{part}.csv", header=True, schema=RATINGS))
        assert rows_of(parquet) == rows_of(csv)
        assert spark.read.parquet(f"{base}/triples/{part}.parquet").columns == ["userId", "movieId", "rating"]
    movies = spark.read.csv(f"{base}/processed/movies.csv", header=True, schema=MOVIES, escape='"')
    assert rows_of(movies) == rows_of(spark.read.parquet(f"{base}/tables/movies.parquet"))
    for name in ("train.csv", "test.csv", "users.csv"):
        assert os.path.isdir(f"{base}/processed/{name}")
    assert sorted(os.listdir(f"{base}/mappings")) == ["movie_mapping", "user_mapping"]


def test_one_failing_size_does_not_stop_the_others(spark, tmp_path):
    make_dump(tmp_path / "raw", "1m")
    make_dump(tmp_path / "raw", "10m")
    assert preparation.available_sizes(spark, f"{tmp_path}/raw") == ["1m", "10m"]
    outcomes = preparation.preprocess_all(spark, f"{tmp_path}/raw", f"{tmp_path}/out", ["25m", "1m", "9m"])
    found = {r["size"]: (r["succeeded"], r["message"]) for r in outcomes.collect()}
    assert found["1m"] == (True, None)
    assert not found["25m"][0] and "no raw data" in found["25m"][1]
    assert not found["9m"][0] and "unknown dataset size" in found["9m"][1]
