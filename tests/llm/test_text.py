"""Quality rules, language identification, BPE and the pipeline."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from check import TYPE_NAMES, canonical, oracle_rows
from starloom.llm import byte_bpe, language_id, quality_rules, queries, secret_scan, simhash

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_rows_equal_sql(spark, sf_dir, name):
    frame = queries.QUERIES[name](spark, sf_dir)
    columns, types, rows = oracle_rows(sf_dir, queries.SQL[name])
    assert canonical(frame.columns, [tuple(r) for r in frame.collect()]) == canonical(columns, rows)
    assert {c: TYPE_NAMES.get(t, t) for c, t in frame.dtypes} == dict(zip(columns, types))


@pytest.mark.parametrize(
    "text, repeated",
    [("a b c", 0), ("a b c a b c", 6), ("a a a a", 4), ("a b c d a b c", 6), ("x a b c y a b c z", 6), ("a b", 0)],
)
def test_repeated_words(docs_of, text, repeated):
    assert quality_rules.ledger(docs_of([(1, text)])).first().n_repeat_words == repeated


def test_ledger_of_edge_cases(edge_docs, no_docs):
    rows = quality_rules.ledger(edge_docs)
    assert rows.count() == edge_docs.count() and quality_rules.ledger(no_docs).collect() == []
    empty = rows.filter("doc_id = 1").first()
    assert (empty.n_words, empty.word_chars, empty.n_dup_lines, empty.failed & 1) == (0, 0, 0, 1)
    assert rows.filter("doc_id = 9").first().n_dup_lines == 2


def test_policies_and_ablation(spark):
    masks = [0, 1, 1, 3, 4, 6]
    rows = spark.createDataFrame([(i, m) for i, m in enumerate(masks)], "doc_id BIGINT, failed BIGINT")
    assert rows.filter(quality_rules.passes(quality_rules.BASE)).count() == 2
    found = {r.rule: (r.n_failed, r.n_only_this) for r in quality_rules.ablation(rows, quality_rules.BASE).collect()}
    assert found == {"too_few_words": (3, 2), "repeated_words": (2, 1)}


def test_language_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = queries.QUERIES["op9_language_id"](spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found) and len(held) > 100
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_ignores_other_columns_and_backs_off(docs_of, edge_docs, no_docs):
    words = {"en": "the house and the garden were there", "de": "das haus und der garten waren dort"}
    train = docs_of([(i, words["en" if i % 2 else "de"]) for i in range(8)])
    train = train.withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").when(F.col("doc_id") > 1, "de"))
    model = language_id.learn(train)
    assert model.languages == ("de", "en")
    scorer = language_id.Scorer(model)
    assert scorer.predict("GARDENS there")[0] == "en" and scorer.predict("dasgarten")[0] == "de"  # unseen words
    assert scorer.predict("123 !?") == ("und", 0.0)
    found = {r.doc_id: r.lang_pred for r in language_id.identify(edge_docs, model).collect()}
    assert found[1] == found[2] == found[3] == "und" and found[4] != "und"
    assert language_id.identify(no_docs, model).collect() == []
    assert language_id.learn(no_docs).languages == ()
    assert {r.lang_pred for r in language_id.identify(edge_docs, language_id.learn(no_docs)).collect()} == {"und"}
    kept = language_id.accepted(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.filter("text IS NULL OR trim(text) = ''").count() == 0


def test_many_unseen_words_stay_in_bounds(monkeypatch, docs_of):
    monkeypatch.setattr(language_id, "KEEP", 3)
    scorer = language_id.Scorer(language_id.learn(docs_of([(1, "aa bb")])))
    text = " ".join("w" + chr(97 + i % 26) * (1 + i // 26) for i in range(60))
    assert scorer.predict(text) == scorer.predict(text) and len(scorer.place) <= len(scorer.rows)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


HARD = ["", "a" * 700, " " * 300 + "x", "the" * 200, "日本語" * 60, "!?" * 200 + "\n\n  x", "\0a\0", "🙂" * 50, "don't we'll I'm", "ab" * 900]


def test_bpe_equals_the_library_and_round_trips(docs_of, edge_docs, no_docs, reference):
    texts = {i: t for i, t in enumerate(HARD)}
    coded = byte_bpe.encode(docs_of(list(texts.items())), RANKS, PATTERN)
    for r in coded.collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    decoded = {r.doc_id: bytes(r.decoded).decode() for r in byte_bpe.decode(coded, RANKS, PATTERN).collect()}
    assert decoded == texts
    assert byte_bpe.encode(edge_docs, RANKS, PATTERN).count() == edge_docs.count()
    assert byte_bpe.encode(no_docs, RANKS, PATTERN).collect() == []
    only_empty = byte_bpe.encode(docs_of([(1, None), (2, "")]), RANKS, PATTERN).collect()
    assert [(r.n_tokens, r.ids) for r in only_empty] == [(0, []), (0, [])]


def test_cached_pieces_serve_later_tasks():
    texts = ["hello wonderfulness", "hello qqzxv"]
    codec = byte_bpe.Codec(RANKS, PATTERN)
    codec.use(False, 1)
    codec.encode(texts)
    codec.use(True, 1)
    library = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for text in texts * 2:
        pieces = codec.encode([text])[0]
        ids = np.frombuffer(b"".join(codec.cache[p][3] for p in pieces), np.int32).tolist()
        assert ids == library.encode_ordinary(text)


def test_vocabularies_beyond_the_key_are_refused(tmp_path):
    lines = [f"{base64.b64encode(bytes([i])).decode()} {i + byte_bpe.IDS - 255}" for i in range(256)]
    (tmp_path / "wide.tiktoken").write_text("\n".join(lines) + "\n")
    with pytest.raises(ValueError):
        byte_bpe.Codec(str(tmp_path / "wide.tiktoken"), PATTERN)


def test_bpe_query_equals_the_library(spark, sf_dir, reference):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in queries.QUERIES["op10_byte_bpe"](spark, sf_dir).collect():
        ids = " ".join(map(str, reference.encode_ordinary(texts[r.doc_id])))
        assert r.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()


def test_pipeline_stages_against_brute_force(spark, sf_dir, reference):
    from test_near_copies import plain_kept
    from test_scans import secret_spans

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language_id"](spark, docs, sf_dir)
    assert first.columns == docs.columns and first.count() == docs.count()
    rows = sorted(tuple(r) for r in first.select("doc_id", "text").collect())
    second = stages["simhash"](spark, first, sf_dir)
    assert sorted(r.doc_id for r in second.collect()) == sorted(plain_kept(rows))
    third = stages["decontaminate"](spark, second, sf_dir)
    left = {r.doc_id: r.text for r in second.collect()}
    clean = {i for i, t in left.items() if not any(item in t for item in items)}
    assert {r.doc_id for r in third.collect()} == clean
    fourth = stages["secret_scan"](spark, third, sf_dir)
    assert fourth.columns == docs.columns and fourth.count() == len(clean)
    texts = {r.doc_id: r.text for r in fourth.collect()}
    assert all(not secret_spans(t) for t in texts.values())
    assert all(texts[i] == left[i] for i in texts if not secret_spans(left[i]))
    last = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert last == {i: reference.encode_ordinary(t) for i, t in texts.items()}


def test_pipeline_of_edge_cases(spark, sf_dir, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge_docs, sf_dir)
        assert out.count() > 0 and stage(spark, no_docs, sf_dir).collect() == []
        if name != "byte_bpe":
            assert out.columns == edge_docs.columns


def test_narrow_operators_do_not_shuffle(spark, sf_dir):
    for name in ("op1_quality_rules", "op7_pii", "op10_byte_bpe", "op6_license_scan", "op5_decontaminate"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, name


def test_native_operators_use_no_python(spark, sf_dir):
    for name in ("op1_quality_rules", "op2_secret_scan"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow")), name
