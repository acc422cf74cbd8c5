"""Line, byte and SimHash deduplication and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from starloom.llm import decontaminate, line_dedup, repeated_bytes, simhash
from starloom.llm.queries import QUERIES
from starloom.session import cut_and_count

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(prints, budget=3):
    """Smallest id reachable, per (id, fingerprint) row, nulls last."""
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= budget:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {}
    for (doc, _), r in zip(prints, root):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return [least.get(r) for r in root]


def test_simhash_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in docs]
    wanted = {(i, format(f, "016x"), c) for (i, f), c in zip(prints, plain_components(prints))}
    assert {tuple(r) for r in QUERIES["op8_simhash"](spark, sf_dir).collect()} == wanted


@pytest.mark.parametrize("subtree", [60, 8192])
def test_trie_join_finds_every_component(spark, subtree):
    rng = np.random.default_rng(subtree)
    values = rng.integers(0, 1 << 63, 150, dtype=np.uint64).tolist()
    for v in list(values[:60]):  # chains of near values
        for _ in range(3):
            for b in rng.choice(64, rng.integers(1, 5), replace=False).tolist():
                v ^= 1 << b
            values.append(v)
    values = sorted({*values, 0, 7, (1 << 64) - 1})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    distinct = spark.createDataFrame([(v,) for v in signed], "fp BIGINT")
    edges = [tuple(r) for r in simhash.links(distinct, 3, subtree).collect()]
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    root = {v: v for v in signed}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        root[find(a)] = find(b)
    for i, a in enumerate(signed):
        for b in signed[:i]:
            if near(a, b):
                assert find(a) == find(b)
    wanted = plain_components(list(zip(range(len(values)), values)))
    assert len({find(v) for v in signed}) == len(set(wanted))
    roots = {r.node: r.root for r in simhash.components(simhash.links(distinct, 3, subtree)).collect()}
    named = [roots.get(v, v) for v in signed]
    assert all((named[i] == named[j]) == (wanted[i] == wanted[j]) for i in range(len(named)) for j in range(i))


def test_walk_of_large_nodes_in_chunks(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 50)
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 1 << 12, 700, dtype=np.uint64))
    found = {(int(x), int(y)) for a, b in simhash.linked_pairs(values, values, 0, 3) for x, y in zip(a, b)}
    wanted = {
        (i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= 3
    }
    assert found == wanted


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(900, 901)], "src BIGINT, dst BIGINT")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert {roots[i] for i in range(1, 51)} == {0} and roots[901] == 900


def test_few_edges_stay_in_few_partitions(spark):
    """A table of few rows is not spread over all shuffle partitions: each would write files of its own in every shuffle."""
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {key: spark.conf.get(key) for key in held}
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        edges = spark.range(5000).selectExpr("id AS src", "id - id % 100 AS dst")
        roots = simhash.components(edges)
        assert roots.rdd.getNumPartitions() <= 4
        assert {(r.node, r.root) for r in roots.collect()} == {(i, i - i % 100) for i in range(5000) if i % 100}
        rows, n_rows = cut_and_count(spark.range(9000).repartition(40, "id"))
        assert n_rows == rows.count() == 9000 and rows.rdd.getNumPartitions() == 3
        nothing, n_rows = cut_and_count(spark.range(0))
        assert n_rows == 0 and nothing.collect() == []
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_simhash_of_edge_cases(edge_docs, no_docs):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in edge_docs.collect()]
    wanted = {(i, c) for (i, _), c in zip(rows, plain_components(rows))}
    found = simhash.near_duplicates(edge_docs).collect()
    assert len(found) == len(rows) and {(r.doc_id, r.component_id) for r in found} == wanted
    kept = simhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    prints = [plain_fingerprint(r.text) for r in kept.collect()]
    named = plain_components([(i, f) for i, (_, f) in enumerate(rows)])
    assert len(prints) == len(set(named))
    assert simhash.near_duplicates(no_docs).collect() == simhash.one_of_each(no_docs).collect() == []


def plain_repeats(rows):
    """doc -> (bytes, removed mask) for rows sorted by rank."""
    seen, out = set(), []
    for doc, text in rows:
        data = (text or "").encode()
        mask = bytearray(len(data))
        for p in range(len(data) - 99):
            piece = data[p : p + 100]
            if piece in seen:
                mask[p : p + 100] = b"\1" * 100
            seen.add(piece)
        out.append((doc, data, bytes(mask)))
    return out


def check_repeats(found, rows):
    wanted = {
        (doc, len(data), bytes(x for x, m in zip(data, mask) if not m)): len(re.findall(b"\1+", mask))
        for doc, data, mask in plain_repeats(rows)
    }
    got = {(r.doc_id, r.n_bytes, bytes(r.kept)): len(r.spans) for r in found}
    assert got == wanted


def test_repeated_bytes_equal_brute_force(docs_of, monkeypatch):
    random.seed(5)
    word = lambda: "".join(random.choice("abcé") for _ in range(random.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for i in range(60):
        text = " ".join(word() for _ in range(random.randint(0, 80)))
        if i % 3 == 0:
            cut = random.randint(0, len(passage) - 30)
            text = text[:50] + passage[cut : cut + random.randint(90, 200)] + text[50:]
        if i % 7 == 0:
            text += "ab" * 120 + "x" * 250
        rows.append((i, text))
    rows += [(60, rows[3][1]), (61, rows[3][1] + "!"), (62, ""), (63, None), (64, "short")]
    check_repeats(repeated_bytes.without_repeats(docs_of(rows)).collect(), rows)
    monkeypatch.setattr(repeated_bytes, "STRETCH", 300)
    repeated_bytes.powers.cache_clear()
    check_repeats(repeated_bytes.without_repeats(docs_of(rows, 1)).collect(), rows)
    repeated_bytes.powers.cache_clear()


def test_sorted_streams_do_not_depend_on_batches():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 12, 400), rng.integers(0, 3, 400)
    doc, place = rng.integers(0, 30, 400), rng.integers(0, 4, 400) << 32
    order = np.lexsort((place, doc, b, a))
    table = pa.table([c[order] for c in (a, b, doc, place)], ["a", "b", "doc", "place"])
    for stream in (repeated_bytes.later_phrases, repeated_bytes.later_strings):
        results = []
        for size in (1, 7, 400):
            found = pa.Table.from_batches(stream(iter(table.to_batches(max_chunksize=size)))).to_pylist()
            results.append(sorted(tuple(r.values()) for r in found))
        assert results[0] == results[1] == results[2]


def test_repeated_bytes_of_edge_cases(edge_docs, no_docs):
    rows = sorted({(r.doc_id, r.text) for r in edge_docs.collect()}, key=lambda r: (r[0] is None, r[0] or 0))
    found = repeated_bytes.without_repeats(edge_docs)
    assert found.count() == edge_docs.count()
    with_id = [r for r in found.collect() if r.doc_id is not None]
    check_repeats(with_id, [r for r in rows if r[0] is not None])
    assert repeated_bytes.without_repeats(no_docs).collect() == []


def test_byte_query_equals_brute_force(spark, sf_dir):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    wanted = {}
    for doc, data, mask in plain_repeats(rows):
        kept = bytes(x for x, m in zip(data, mask) if not m)
        wanted[doc] = (len(data), sum(mask), len(re.findall(b"\1+", mask)), hashlib.sha256(kept).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op3_repeated_bytes"](spark, sf_dir).collect()} == wanted


def test_passages_of_edge_cases(edge_docs, no_docs):
    found = line_dedup.without_repeated_passages(edge_docs, least_weight=5).collect()
    assert len(found) == edge_docs.count()
    line = "one two three four five six seven eight nine ten"
    texts = {(r.doc_id, r.text) for r in found}
    assert {(4, line), (5, ""), (9, ""), (1, ""), (2, "")} <= texts and (None, "") in texts
    assert [(s.start, s.stop, s.units) for r in found if r.doc_id == 9 for s in r.removed] == [(0, 3 * len(line) + 2, 3)]
    assert line_dedup.without_repeated_passages(no_docs).collect() == []


def test_only_long_runs_of_repeated_sentences_go(docs_of):
    passage = "It was cold that day. Nobody had come,  and the house\nstood open to the wind! So we went in and looked around for a while."
    short = "It was cold that day."
    cjk = "\u5929\u6c14\u5f88\u597d" * 60 + "\u3002"
    rows = [(1, f"Before. {passage} After."), (2, f"Other start here. {passage.upper()} Other end."), (3, f"Then. {short} And more."),
            (4, cjk), (5, f"x {passage} y"), (6, "z\n" + cjk), (7, f"\u00a0{passage}")]
    found = {r.doc_id: r.text for r in line_dedup.without_repeated_passages(docs_of(rows)).collect()}
    assert found[1] == rows[0][1] and found[3] == rows[2][1] and found[4] == cjk
    assert found[2] == "Other start here. Other end." and found[6] == "z\n"
    assert found[5] == "x It was cold that day. y"  # its first sentence has another word
    assert {i: "".join(c for c in t if c not in " ") for i, t in found.items()}[7].startswith("\u00a0It")


def test_pieces_make_up_the_text():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("ab .!?\n\t\u3002") for _ in range(rng.randrange(30)))
        assert "".join(p.group() for p in line_dedup.pieces(text)) == text
        assert all(a < b for _, a, b, _, _ in line_dedup.units_of(text))


def plain_edits(item, text):
    last = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        row = [i]
        for j, y in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return min(last)


def test_decontamination_equals_full_alignment(spark, sf_dir):
    random.seed(9)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(12).collect()]
    index = decontaminate.Items([i for i, _ in items], [t for _, t in items])
    for trial in range(40):
        at = random.randrange(len(items))
        noisy = list(items[at][1])
        for _ in range(random.randrange(int(len(noisy) * 0.13))):
            spot = random.randrange(len(noisy))
            noisy[spot : spot + random.randint(0, 1)] = random.choice(["z", "", "yy"])
        text = "x " * random.randrange(40) + "".join(noisy).swapcase() + " q" * 30
        for number, (_, item) in enumerate(items):
            edits = plain_edits(decontaminate.codes(item), decontaminate.codes(text))
            found = [r[3] for r in index.find(text) if r[0] == number]
            assert (min(found) == edits) if edits <= index.edits[number] else not found


def test_decontamination_in_slices_and_blocks(spark, docs_of, monkeypatch):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the dog"), (2, "abc"), (3, None), (4, "")], "item_id INT, text STRING")
    text = "filler words " * 300 + "the quick brown fox jumps over the dog" + " filler" * 300
    docs = docs_of([(1, text), (1, text), (2, "xx ABC xx"), (3, "nothing"), (4, None), (None, "abc")])
    whole = sorted((tuple(r) for r in decontaminate.contaminated(docs, items).collect()), key=repr)
    assert {(r[0], r[1], r[4]) for r in whole} == {(1, 1, 0), (2, 2, 0), (None, 2, 0)} and len(whole) == 4
    small = sorted((tuple(r) for r in decontaminate.contaminated(docs, items, block=10).collect()), key=repr)
    assert small == whole
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items, block=10).collect()) == [3, 4]
    monkeypatch.setattr(decontaminate, "SLICE", 400)
    index = decontaminate.Items([1], ["the quick brown fox jumps over the dog"])
    start = text.index("the quick")
    assert index.find(text) == [(0, start, start + 38, 0)]


def test_decontamination_of_edge_cases(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id BIGINT, text STRING")
    one = spark.createDataFrame([(1, "one two three four five six")], "item_id BIGINT, text STRING")
    assert decontaminate.contaminated(edge_docs, none).collect() == decontaminate.contaminated(no_docs, one).collect() == []
    cleaned = decontaminate.clean(edge_docs, one)
    assert cleaned.columns == edge_docs.columns and cleaned.count() == edge_docs.count() - 5


def test_query_finds_planted_passages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    wanted = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op5_decontaminate"](spark, sf_dir).collect()}
    assert wanted <= found and {d for d, _ in found} == {d for d, _ in wanted}
