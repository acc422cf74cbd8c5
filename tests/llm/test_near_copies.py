"""The pipeline's near copies against brute force over exact similarities."""

import random
import re

import corpus_pipeline
from starloom.llm import near_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_shingles(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    """Least id, nulls last, of every component of similarity 0.8 or more."""
    sets = [plain_shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) * 5 >= 4 * len(a | b):
                one, other = root[i], root[j]
                root = [other if r == one else r for r in root]
    groups = {}
    for (doc, _), r in zip(rows, root):
        groups.setdefault(r, []).append(doc)
    return sorted((min((d for d in g if d is not None), default=None) for g in groups.values()), key=repr)


def changed(words, places):
    out = list(words)
    for p in places:
        out[p] = f"z{p}"
    return " ".join(out)


def test_stage_equals_exact_similarity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    kept = dict(corpus_pipeline.STAGES)["simhash"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == plain_kept(rows)


def test_copies_on_both_sides_of_the_limit(docs_of):
    random.seed(3)
    rows = []
    for group in range(12):
        words = [f"w{random.randrange(10**6)}" for _ in range(200)]
        rows.append((10 * group, " ".join(words)))
        rows.append((10 * group + 1, changed(words, (20, 60, 100, 140))))  # 176 of 216 shingles: 0.81
        rows.append((10 * group + 2, changed(words, (20, 60, 100, 140, 180))))  # 0.77 to the first, linked by the second
        rows.append((10 * group + 3, changed(words, (10, 30, 50, 70, 90, 110))))  # too far from all
    rows += [(None, rows[0][1]), (None, "alone without an id"), (200, "Two  words"), (201, "two words"), (202, None), (203, "")]
    wanted = plain_kept(rows)
    assert sum(d is not None and d < 200 for d in wanted) == 24
    assert sorted((r.doc_id for r in near_copies.one_of_each(docs_of(rows)).collect()), key=repr) == wanted


def test_a_set_joined_only_through_a_larger_component(spark):
    """The least set of a band isn't similar to a set that another member of the band is similar to."""
    random.seed(8)
    words = [f"w{random.randrange(10**6)}" for _ in range(150)]
    chain = [changed(words, [7 * i for i in range(3 * step)]) for step in range(7)]
    rows = [(i, t) for i, t in enumerate(chain)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    assert sorted(r.doc_id for r in near_copies.one_of_each(frame).collect()) == plain_kept(rows)


def test_edge_cases(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    kept = near_copies.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == plain_kept(rows)
    assert near_copies.one_of_each(no_docs).collect() == []


def test_common_boilerplate_gives_few_pairs(docs_of, monkeypatch):
    """Two thirds of every text are one passage; five pairs of near copies and a group of 30 stand among them."""
    random.seed(4)
    passage = " ".join(f"p{i}" for i in range(120))

    def own(n):
        return " ".join(f"w{random.randrange(10**6)}" for _ in range(n))

    rows = [(i, f"{passage} {own(60)}") for i in range(2000)]
    rows += [(3000 + i, rows[100 * i][1] + " and more") for i in range(5)]
    copied = own(60)
    rows += [(4000 + i, f"{passage} {copied} z{i}") for i in range(30)]
    pairs, plain = [], near_copies.across

    def counted(members):
        found = plain(members)
        pairs.append(found.count())
        return found

    monkeypatch.setattr(near_copies, "across", counted)
    kept = sorted(r.doc_id for r in near_copies.one_of_each(docs_of(rows)).collect())
    assert kept == [*range(2000), 4000]
    assert sum(pairs) < len(rows)


def test_prefixes_hold_a_common_shingle_of_every_similar_pair(spark):
    random.seed(6)
    sets = []
    for _ in range(30):
        base = [random.randrange(400) for _ in range(random.choice((1, 2, 5, 10, 11, 40)))]
        sets += [set(base), set(base[1:]) | {random.randrange(400)}, set(base) | {random.randrange(400)}]
    sets = [s for s in sets if s]
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "set_key BIGINT, hashes ARRAY<BIGINT>")
    firsts = {}
    for r in near_copies.prefixes(frame).collect():
        firsts.setdefault(r.set_key, set()).add(r.key)
    near = [(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if len(a & b) * 5 >= 4 * len(a | b)]
    assert near and all(firsts[i] & firsts[j] for i, j in near)


def test_sets_with_half_their_key_in_common_stay_apart(spark):
    rows = [(1, 10, 7, 1), (2, 20, 7, 2), (3, 30, 8, 1), (4, 40, 7, 1)]
    signed = spark.createDataFrame(rows, "doc_id BIGINT, text_key BIGINT, set_key BIGINT, set_check BIGINT")
    keys = {r.doc_id: r.set_key for r in near_copies.apart(signed).collect()}
    assert keys[1] == keys[4] and len({keys[1], keys[2], keys[3]}) == 3


def test_changed_copies_of_one_text_give_few_pairs(docs_of, monkeypatch):
    """300 copies with about an eighth of the shingles changed, too far from each other; some are linked."""
    random.seed(9)
    base = [f"w{i}" for i in range(400)]

    def copy(i, changes):
        out = list(base)
        for p in random.sample(range(400), changes):
            out[p] = f"z{i}x{p}"
        return " ".join(out)

    rows = [(i, copy(i, 12)) for i in range(300)]
    rows += [(1000 + i, rows[10 * i][1] + " and more") for i in range(5)]
    pairs, plain = [], near_copies.across

    def counted(members):
        found = plain(members)
        pairs.append(found.count())
        return found

    monkeypatch.setattr(near_copies, "across", counted)
    kept = sorted((r.doc_id for r in near_copies.one_of_each(docs_of(rows)).collect()), key=repr)
    assert kept == plain_kept(rows)
    assert sum(pairs) < 10 * len(rows)


def test_similar_pairs_pass_at_their_first_common_key(spark):
    random.seed(10)
    sets = []
    for _ in range(25):
        base = [random.randrange(300) for _ in range(random.choice((1, 5, 10, 11, 40)))]
        sets += [set(base), set(base[1:]) | {random.randrange(300)}, set(base) | {random.randrange(300)}]
    sets = [s for s in sets if s]
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "set_key BIGINT, hashes ARRAY<BIGINT>")
    members = near_copies.prefixes(frame).withColumn("root", near_copies.F.col("set_key"))
    members = members.withColumn("sketch", near_copies.F.array(*[near_copies.F.lit(0).cast("long")] * 3))
    found = {(r.src, r.dst) for r in near_copies.across(members).collect()}
    near = [(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if len(a & b) * 5 >= 4 * len(a | b)]
    assert near and found >= set(near)


def test_only_similar_sets_leave_the_join_on_prefixes(spark):
    """Sets that carry their hashes; a pair of which one set carries none is left to the texts."""
    random.seed(12)
    base = list(range(60))
    sets = [set(base[:-k] if k else base) | {1000 * i + j for j in range(k)} for i in range(12) for k in (0, 4, 8, 9, 12)]
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "set_key BIGINT, hashes ARRAY<BIGINT>")
    members = near_copies.prefixes(frame).withColumn("root", near_copies.F.col("set_key"))
    members = members.withColumn("sketch", near_copies.F.array(*[near_copies.F.lit(0).cast("long")] * 3))
    near = {(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if len(a & b) * 5 >= 4 * len(a | b)}
    found = {(r.src, r.dst) for r in near_copies.across(members.join(frame, "set_key")).collect()}
    assert near and found == near
    none = frame.withColumn("hashes", near_copies.F.expr("CASE WHEN set_key % 2 = 0 THEN hashes END"))
    assert {(r.src, r.dst) for r in near_copies.across(members.join(none, "set_key")).collect()} >= near


def test_candidates_by_fingerprint_are_those_of_the_trie(spark):
    """Components of the candidate pairs are those of all fingerprints within 3 bits, by brute force."""
    random.seed(13)
    prints = []
    for _ in range(40):
        fp = random.getrandbits(63)
        prints += [fp, fp, fp ^ 1 << random.randrange(63), fp ^ 7 << random.randrange(60), fp ^ 0x1F << random.randrange(58)]
    frame = spark.createDataFrame(list(enumerate(prints)), "set_key BIGINT, fp BIGINT")
    root, other = list(range(len(prints))), list(range(len(prints)))

    def join(roots, i, j):
        old, new = max(roots[i], roots[j]), min(roots[i], roots[j])
        roots[:] = [new if r == old else r for r in roots]

    for j, b in enumerate(prints):
        for i, a in enumerate(prints[:j]):
            if (a ^ b).bit_count() <= 3:
                join(root, i, j)
    pairs = near_copies.same_print(frame).collect()
    for r in pairs:
        assert r.src > r.dst
        join(other, r.src, r.dst)
    assert other == root and len(pairs) < len(prints)


def test_stage_takes_the_links_of_the_trie(docs_of, monkeypatch):
    """Without bands the stage still finds the copies whose fingerprints are near."""
    random.seed(14)
    words = [f"w{random.randrange(10**6)}" for _ in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words) + " more"), (3, " ".join(words[::-1]))]
    plain = near_copies.signature
    assert (plain(rows[0][1])[2] ^ plain(rows[1][1])[2]).bit_count() <= 3
    monkeypatch.setattr(near_copies, "minima", lambda hashes: near_copies.FACTORS * hashes.sum())
    assert sorted(r.doc_id for r in near_copies.one_of_each(docs_of(rows)).collect()) == [1, 3]
