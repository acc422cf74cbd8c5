import pytest

FIELDS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs; lang and source are filled in."""

    def build(rows, partitions=3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, FIELDS).repartition(partitions)

    return build


@pytest.fixture
def edge_docs(docs_of):
    """Nulls, empty and blank texts, repeated rows, ties, a long text, and columns of clashing names."""
    from pyspark.sql import functions as F

    line = "one two three four five six seven eight nine ten"
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\r\n "), (4, line), (4, line), (5, line), (None, line), (None, None),
        (None, "another text without an id, in a few words"), (6, "\U0001f600 é ß İ \x00 end"),
        (7, ("word%d " * 5 % (1, 2, 3, 4, 5)) * 4000), (8, "a" * 5000), (9, "\n".join([line] * 3)),
    ]
    clash = dict.fromkeys(
        ["found", "spans", "fp", "accepted", "contaminated", "kept_id", "found_doc", "rules", "removed", "places"], 1
    )
    return docs_of(rows).withColumns({name: F.lit(v) for name, v in clash.items()})


@pytest.fixture
def no_docs(docs_of):
    return docs_of([])
