"""Near copies by SimHash and MinHash bands, confirmed by exact Jaccard similarity of five-word shingles.

1. A text's set of shingles is hashed. Texts with equal sets meet in one aggregation; only distinct
   sets go on, each with its SimHash fingerprint, BANDS band keys of ROWS minima and a sketch of one
   bit per minimum.
2. The distinct fingerprints go through the binary trie self-join of ``simhash``: its links within
   BUDGET bits, and sets of one fingerprint, are candidates. As these find only a part of the pairs at
   0.8, sets that share a band key are candidates as well. First every set is paired with the least set
   of each of its bands, so a group of copies sends one pair per member and not one per pair of members.
3. Candidates whose sketches agree often enough are confirmed on their texts: exactly, by counting
   common shingles. Components of the confirmed links are found as in simhash.
4. In bands that still hold more than one component, the sets outside the band's largest component
   are paired with all sets of other components there and confirmed in the same way. Where more
   than FEW sets stand outside, as with texts around a common passage, their pairs would grow with
   the square of the band: all sets of such bands are paired by prefixes instead. Shingles in order
   of rarity, two sets of similarity 0.8 share one of the first fifth (plus one) of each, so a
   passage that many texts share makes no pair unless it is four fifths of them. The first one that
   they share has no more of both sets behind it than they can still have in common, which must be
   enough (positional filter); so changed copies of one text, each with rare shingles of its own,
   make few pairs; and sets of up to CARRIED shingles carry their hashes along, so that only similar
   ones leave that join. After that every two candidates are linked, in one component, or known not to be
   similar enough.

Two sets of similarity 0.8 share no band with a chance of about 1e-7 (two of 0.9: below 1e-15). A
Hamming budget that covers 0.8 has no such bound short of about 23 of 64 bits, where a trie prunes
nothing and a self-join of fingerprints grows with the square of the table.

Null and empty texts have the empty set, equal to itself. Texts of fewer words than a shingle are
one shingle. Null ids rank last and are told apart by their texts; repeated rows are one document;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.frames import free_name
from starloom.llm.simhash import LOWER, WORD, components, links as trie_links, voted
from starloom.operators.skew import BROADCAST_BYTES
from starloom.session import cut_and_count, cut_lineage

SHINGLE = 5
#: Least similarity, as a fraction of whole numbers.
LEAST = (4, 5)
BANDS, ROWS = 40, 5
#: Bits of the sketch, and how many must agree: 6.4 standard deviations below the mean at 0.8.
SKETCH, LEAST_AGREEING = 192, 146
SEED = 42
#: Bits in which linked fingerprints may differ.
BUDGET = 3
#: Most hashes that a set carries into the join on prefixes; pairs of larger sets are left to their texts.
CARRIED = 512
#: Sets outside a band's largest component that are paired within the band; for the plan only.
FEW = 4
#: Bytes of a row of ids in a hash table, at most.
ROW_BYTES = 64
#: Rows of an Arrow batch; a row may hold two texts.
BATCH_CONF, BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 256

FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str) -> set[str]:
    words = WORD.findall(text.translate(LOWER))
    parts = [words[i:] for i in range(min(SHINGLE, len(words)))]
    return {" ".join(p) for p in zip(*parts)}


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set of hashes."""
    least = np.full(len(FACTORS), 0xFFFFFFFFFFFFFFFF, np.uint64)
    for begin in range(0, len(hashes), 512):
        np.minimum(least, (hashes[begin : begin + 512, None] * FACTORS).min(axis=0), out=least)
    return least


def hashed(text: str) -> np.ndarray:
    """Hashes of a text's shingles."""
    return np.array([xxhash.xxh64_intdigest(p, SEED) for p in shingles(text)], np.uint64)


def signature(text: str) -> tuple[int, int, int, np.ndarray, np.ndarray]:
    """Both halves of the set's key, fingerprint, band keys (none for the empty set) and sketch, as signed numbers."""
    hashes = np.sort(hashed(text))
    key = struct.unpack("<qq", hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
    if not len(hashes):
        return *key, 0, np.empty(0, np.int64), np.zeros(SKETCH // 64, np.int64)
    print_ = int(np.uint64(voted(hashes)).view(np.int64))
    least = minima(hashes)
    bands = np.array(
        [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(least.reshape(BANDS, ROWS))], np.uint64
    )
    bits = (least[:SKETCH] >> np.uint64(30) ^ least[:SKETCH] >> np.uint64(17)) & np.uint64(1)
    return *key, print_, bands.view(np.int64), np.packbits(bits.astype(np.uint8)).view("<i8")


def signatures(texts: DataFrame) -> DataFrame:
    """doc_id, text_key, set_key, set_check, fp, bands and sketch of texts (doc_id, text_key, text)."""
    names = ["doc_id", "text_key", "set_key", "set_check", "fp", "bands", "sketch"]
    kind = pa.list_(pa.int64())

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                found = [signature(text.as_py()) for text in part.column(2)]
                columns = [
                    pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[3] for f in found], kind), pa.array([f[4] for f in found], kind),
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names)

    schema = "doc_id long, text_key long, set_key long, set_check long, fp long, bands array<long>, sketch array<long>"
    return texts.select("doc_id", "text_key", "text").mapInArrow(run, schema)


def apart(signed: DataFrame) -> DataFrame:
    """signed with equal set_keys only where all 128 bits of set_key and set_check are equal."""
    checks = signed.groupBy("set_key").agg(F.min("set_check").alias("low"), F.max("set_check").alias("high"))
    clashing = cut_lineage(checks.filter("low <> high").select(F.col("set_key").alias("clashing")))
    if clashing.isEmpty():
        return signed
    key = F.when(F.col("clashing").isNull(), F.col("set_key")).otherwise(F.xxhash64("set_key", "set_check"))
    joined = signed.join(small(clashing), F.col("set_key") == F.col("clashing"), "left")
    return cut_lineage(joined.withColumn("set_key", key).select(signed.columns))


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of BATCH rows for what runs inside."""
    before = spark.conf.get(BATCH_CONF, None)
    spark.conf.set(BATCH_CONF, str(BATCH))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
        else:
            spark.conf.set(BATCH_CONF, before)


def near(left: str, right: str) -> Column:
    """Whether two sketches agree in LEAST_AGREEING bits."""
    differing = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(SKETCH // 64)]
    return sum(differing[1:], differing[0]) <= SKETCH - LEAST_AGREEING


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (src, dst) those of similarity LEAST or more; texts has set_key and text."""
    left = texts.select(F.col("set_key").alias("src"), F.col("text").alias("left_text"))
    right = texts.select(F.col("set_key").alias("dst"), F.col("text").alias("right_text"))
    joined = pairs.join(left, "src").join(right, "dst").select("src", "dst", "left_text", "right_text")

    def run(batches):
        held: tuple = (None, None)
        for batch in batches:
            keep = []
            for dst, a, b in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if held[0] != dst:
                    held = dst, shingles(b.as_py())
                one, other = shingles(a.as_py()), held[1]
                common = len(one & other)
                keep.append(common * LEAST[1] >= LEAST[0] * (len(one) + len(other) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["src", "dst"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "src long, dst long")


def set_hashes(texts: DataFrame) -> DataFrame:
    """set_key and hashes of the shingles of texts (set_key, text)."""

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH):
                part = batch.slice(begin, BATCH)
                found = [hashed(text.as_py()).view(np.int64) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], ["set_key", "hashes"])

    return texts.select("set_key", "text").mapInArrow(run, "set_key long, hashes array<long>")


def prefixes(sets: DataFrame) -> DataFrame:
    """key, set_key, n and rest: the rarest shingles of every set (set_key, hashes), those that another set has.

    Of n shingles in any order common to all sets, the first n - ceil(0.8 n) + 1 of two sets of
    similarity 0.8 have one in common. Shingles of a single set come first and are not returned.
    A set that is given twice counts twice in that order, which changes no result. rest counts the
    set's shingles from this one on.
    """
    n, shared = F.col("n"), F.size("by_rarity")
    rows = sets.select("set_key", F.size("hashes").alias("n"), F.explode("hashes").alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    sorted_ = F.sort_array(F.collect_set(F.struct("sets", "key"))).alias("by_rarity")
    ranked = rows.join(counts, "key").groupBy("set_key", "n").agg(sorted_)
    length = n - F.ceil(n * LEAST[0] / LEAST[1]).cast("int") + 1 - (n - shared)
    first = F.slice("by_rarity", 1, F.greatest(length, F.lit(0)))
    placed = ranked.select("set_key", "n", shared.alias("shared"), F.posexplode(first).alias("place", "first"))
    return placed.select(F.col("first.key").alias("key"), "set_key", "n", (F.col("shared") - F.col("place")).alias("rest"))


def reachable() -> Column:
    """Whether two sets whose first common shingle is the key can have similarity LEAST.

    They have no more in common than the shorter rest. A similar pair passes at its first common key.
    """
    common = F.least("src_rest", "dst_rest")
    return common * sum(LEAST) >= (F.col("src_n") + F.col("dst_n")) * LEAST[0]


def alike() -> Column:
    """Whether two sets that carry their hashes have similarity LEAST; true where one carries none."""
    common = F.size(F.array_intersect("src_hashes", "dst_hashes"))
    enough = common * sum(LEAST) >= (F.col("src_n") + F.col("dst_n")) * LEAST[0]
    return F.col("src_hashes").isNull() | F.col("dst_hashes").isNull() | enough


def across(members: DataFrame) -> DataFrame:
    """Pairs (src, dst), least key first, within a key, of sets of different roots whose sketches are near.

    members has key, set_key, root and sketch, and n and rest where the keys are prefixes, there also
    hashes of the sets that carry them, whose pairs are then similar ones. Sets of the key's largest component are paired with the sets outside it only.
    """
    kept = [c for c in ("root", "sketch", "n", "rest", "hashes") if c in members.columns]
    sizes = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(
        F.max(F.struct("n", "root"))["root"].alias("largest"), F.count(F.lit(1)).alias("components")
    )
    mixed = members.join(largest.filter("components > 1"), "key")
    few = mixed.filter("root <> largest").select("key", F.col("set_key").alias("src"), *(F.col(c).alias(f"src_{c}") for c in kept))
    all_ = mixed.select("key", F.col("set_key").alias("dst"), *(F.col(c).alias(f"dst_{c}") for c in kept))
    pairs = few.join(all_, "key").filter(F.col("src_root") != F.col("dst_root"))
    if "rest" in kept:
        pairs = pairs.filter(reachable())
    pairs = pairs.filter(near("src_sketch", "dst_sketch"))
    if "hashes" in kept:
        pairs = pairs.filter(alike())
    return pairs.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))


def small(rows: DataFrame) -> DataFrame:
    """rows, broadcast if they are few: texts then stay where they are."""
    rows, n_rows = cut_and_count(rows)
    return F.broadcast(rows) if n_rows * ROW_BYTES <= BROADCAST_BYTES else rows


def same_print(distinct: DataFrame) -> DataFrame:
    """Pairs (src, dst) of sets, least key second, by their fingerprints: one per set and link at most.

    Sets of one fingerprint are paired with the least of them, and these by the trie self-join, whose
    links have the components of all pairs within BUDGET bits.
    """
    prints, _ = cut_and_count(distinct.groupBy("fp").agg(F.min("set_key").alias("least")))
    own = distinct.join(prints, "fp").filter("set_key <> least").select(F.col("set_key").alias("src"), F.col("least").alias("dst"))
    first = prints.select(F.col("fp").alias("src"), F.col("least").alias("a"))
    second = prints.select(F.col("fp").alias("dst"), F.col("least").alias("b"))
    linked = trie_links(prints.select("fp"), BUDGET).join(first, "src").join(second, "dst")
    return own.union(linked.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst")))


def similar_sets(distinct: DataFrame, texts: DataFrame) -> DataFrame:
    """node and root of every set that is linked to another, over distinct (set_key, fp, bands, sketch, ...).

    texts has first_id and first_key, as distinct, and text.
    """
    rows = distinct.select("set_key", F.explode("bands").alias("band"))
    crowded = rows.groupBy("band").agg(F.min("set_key").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members, _ = cut_and_count(rows.join(crowded.select("band", "least"), "band"))
    sketches = distinct.select(F.col("set_key").alias("of_set"), F.col("sketch"))

    def with_text(wanted: DataFrame) -> DataFrame:
        """set_key and text of the sets of wanted; of a repeated row all copies."""
        wanted = wanted.join(distinct.select("set_key", "first_id", "first_key"), "set_key").select(
            "set_key", F.col("first_id").alias("wanted_id"), F.col("first_key").alias("wanted_key")
        )
        same = F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("text_key") == F.col("wanted_key"))
        return texts.join(small(wanted), same).select("set_key", "text")

    def checked(pairs: DataFrame) -> DataFrame:
        close, _ = cut_and_count(pairs.filter(near("src_sketch", "dst_sketch")).select("src", "dst"))
        wanted = close.select(F.col("src").alias("set_key")).union(close.select("dst")).distinct()
        found = cut_lineage(with_text(wanted).dropDuplicates(["set_key"]))
        with small_batches(found.sparkSession):
            return cut_and_count(confirmed(close, found))[0]

    def sketched(pairs: DataFrame) -> DataFrame:
        first = sketches.select(F.col("of_set").alias("src"), F.col("sketch").alias("src_sketch"))
        second = sketches.select(F.col("of_set").alias("dst"), F.col("sketch").alias("dst_sketch"))
        return pairs.join(first, "src").join(second, "dst")

    star = members.filter("set_key <> least").select(F.col("set_key").alias("src"), F.col("least").alias("dst")).distinct()
    star, _ = cut_and_count(star.union(same_print(distinct)).distinct())
    links = checked(sketched(star))
    roots = components(links)

    named = members.select(F.col("band").alias("key"), "set_key").join(roots, F.col("set_key") == F.col("node"), "left")
    named, _ = cut_and_count(named.select("key", "set_key", F.coalesce("root", "set_key").alias("root")))
    sizes = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    outside = sizes.groupBy("key").agg((F.sum("n") - F.max("n")).alias("outside")).filter("outside > 0")
    mixed, _ = cut_and_count(named.join(outside, "key").join(sketches, F.col("set_key") == F.col("of_set")).drop("of_set"))
    crowd, n_crowd = cut_and_count(mixed.filter(F.col("outside") > FEW).select("set_key", "root", "sketch").dropDuplicates(["set_key"]))
    found = across(mixed.filter(F.col("outside") <= FEW))
    if n_crowd:
        with small_batches(crowd.sparkSession):
            hashes = cut_lineage(set_hashes(with_text(crowd.select("set_key"))))
        carried = F.when(F.size("hashes") <= CARRIED, F.col("hashes")).alias("hashes")
        carrying = crowd.join(hashes.select("set_key", carried).dropDuplicates(["set_key"]), "set_key")
        found = found.union(across(cut_lineage(prefixes(hashes)).join(carrying, "set_key")))
    found = found.distinct()
    tried = star.select(F.col("dst").alias("src"), F.col("src").alias("dst"))  # the least set comes first here
    more = checked(sketched(found.join(tried, ["src", "dst"], "left_anti")))
    return roots if more.isEmpty() else components(links.union(more))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row left of every group of near copies: the one of the smallest id, nulls last.

    A group is a component of the links of similarity LEAST or more. Rows are left out by a join with
    the ids that go, which moves no text while these are few.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("text_key", F.xxhash64("text"))
    with small_batches(docs.sparkSession):
        signed = apart(cut_lineage(signatures(texts)))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    distinct = signed.groupBy("set_key").agg(
        F.min(order).alias("first"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    distinct, _ = cut_and_count(
        distinct.select("set_key", "first", "fp", "bands", "sketch", F.col("first.id").alias("first_id"), F.col("first.key").alias("first_key"))
    )
    roots = similar_sets(distinct, texts)
    named = distinct.select("set_key", "first").join(roots, F.col("set_key") == F.col("node"), "left")
    kept = named.groupBy(F.coalesce("root", "set_key").alias("root")).agg(F.min("first").alias("kept"))
    kept = kept.select(F.col("kept.id").alias("kept_id"), F.col("kept.key").alias("kept_key"))
    pairs = signed.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    stays = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))
    found_id, found_key, key = (free_name(docs, n) for n in ("found_id", "found_key", "text_key"))

    def listed(rows: DataFrame) -> DataFrame:
        return small(rows.select(F.col("doc_id").alias(found_id), F.col("text_key").alias(found_key)))

    same = F.col(id_col).cast("long").eqNullSafe(F.col(found_id)) & (F.col(key) == F.col(found_key))
    left = docs.withColumn(key, F.xxhash64(text)).join(listed(pairs.join(kept, stays, "left_anti")), same, "left_anti")
    repeated, n_repeated = cut_and_count(pairs.filter("n > 1"))
    if not n_repeated:
        return left.drop(key)
    again = listed(repeated)
    once = left.join(again, same, "left_semi").dropDuplicates([id_col, key])
    return left.join(again, same, "left_anti").union(once).drop(key)
