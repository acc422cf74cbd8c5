"""Repeated bytes of documents that have no id, or share one, against brute force."""

import random

from pyspark.sql import functions as F
from test_duplicates import check_repeats

from starloom.llm import repeated_bytes


def short_keys(spark, texts):
    """The last 18 bits of the texts' keys."""
    frame = spark.createDataFrame(list(enumerate(texts)), "n INT, text STRING")
    rows = frame.select("n", F.xxhash64("text").alias("key")).collect()
    return {texts[r.n]: (r.key & (1 << 18) - 1, r.key) for r in rows}


def test_texts_of_equal_short_keys_are_different_documents(spark, docs_of):
    random.seed(2)
    passage = " ".join(str(random.randrange(10**6)) for _ in range(30))
    texts = [passage + f" and an end of its own, number {i}" for i in range(2_000)]
    keys, met = short_keys(spark, texts), {}
    for text in texts:
        met.setdefault(keys[text][0], []).append(text)
    pair = next(group for group in met.values() if len(group) > 1)[:2]
    pair.sort(key=lambda t: keys[t][1])  # documents without an id rank by their key
    for doc in (None, 7):
        rows = [(doc, text) for text in pair]
        check_repeats(repeated_bytes.without_repeats(docs_of(rows)).collect(), rows)
