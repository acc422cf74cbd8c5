"""Spelling variants against an edit-by-edit search."""

import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from starloom.llm import spelling
from starloom.llm.oracles import SQL
from starloom.llm.queries import QUERIES

SMALL_LETTERS = {c: c + 32 for c in range(65, 91)}


def plain_words(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL_LETTERS)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_variants(docs):
    words = plain_words(docs)
    letters = sorted({c for w in words for c in w})
    out = {}
    for w, n in words.items():
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near = [v for v in edits if v != w and v in words]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best is not None and words[best] >= 10 * n else None, len(near))

    def root(w):
        while out[w][0] is not None:
            w = out[w][0]
        return w

    return {(w, form, root(w), words[w], k, None if form is None else words[form]) for w, (form, k) in out.items()}


def test_query_and_sql_equal_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    wanted = plain_variants(docs)
    assert {tuple(r) for r in QUERIES["op11_spelling_variants"](spark, sf_dir).collect()} == wanted
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert set(con.execute(SQL["op11_spelling_variants"]).fetchall()) == wanted


@pytest.mark.parametrize("filter_bytes", [64, 4096])
def test_passes_over_parts_of_the_filters_lose_nothing(spark, sf_dir, filter_bytes):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 40")
    wanted = plain_variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
    if filter_bytes == 64:  # one pass for every few blocks: few words are enough
        docs = docs.filter("doc_id < 4")
        wanted = plain_variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
    found = {tuple(r) for r in spelling.variants(docs, filter_bytes=filter_bytes).collect()}
    assert found == wanted


def test_passes_cover_every_block_once():
    counts = {7: 1000, 8: 3, 9: 77}
    groups = spelling.passes(counts, 240)
    assert all(sum(b - a for _, a, b in group) <= 30 for group in groups)
    blocks = [(n, b) for group in groups for n, a, end in group for b in range(a, end)]
    assert sorted(blocks) == [(n, b) for n in counts for b in range(spelling.n_blocks_of(counts[n]))]


def test_chains_ties_and_accents(docs_of):
    text = " ".join(["haustier"] * 4000 + ["haustiex"] * 225 + ["haustixx"] * 15 + ["hausxixx"])
    text += " " + " ".join(["ÀpfelbÄume", "àpfelbäume"] * 3 + ["tiefgang", "tiefganh", "tiefgank"] * 5)
    rows = [(i, text) for i in range(40)]
    found = {tuple(r) for r in spelling.variants(docs_of(rows)).collect()}
    assert found == plain_variants(rows)
    roots = {r[0]: r[2] for r in found}
    assert roots["hausxixx"] == roots["haustixx"] == "haustier"


def test_edges(spark, edge_docs, no_docs, docs_of):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert {tuple(r) for r in spelling.variants(edge_docs).collect()} == plain_variants(rows)
    assert spelling.variants(no_docs).collect() == []
    assert spelling.variants(docs_of([(1, None), (2, "")])).collect() == []
    long = [(1, "a" * 9000 + " " + "a" * 9001 + " " + "a" * 9000 + " " + "a" * 9001 + "b"), (2, "a" * 9000 + "b " + "a" * 9001)]
    assert {tuple(r) for r in spelling.variants(docs_of(long)).collect()} == plain_variants_of_long(long)
    clash = docs_of([(1, "variants variants variantx variantx")]).withColumns({n: F.lit(1) for n in ("word", "n", "edit")})
    assert len(spelling.variants(clash).collect()) >= 1


def plain_variants_of_long(rows):
    """As plain_variants, by comparing all pairs of a few long words."""
    words = plain_words(rows)

    def near(a, b):
        a, b = sorted((a, b), key=len)
        k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        return a != b and (a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :]) and len(b) - len(a) <= 1

    return {(w, None, w, n, sum(near(w, v) for v in words), None) for w, n in words.items()}
