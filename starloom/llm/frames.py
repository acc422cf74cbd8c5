"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: White space of the word rule `[^\x20\x09-\x0D]+`, fixed.
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df doesn't use yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once per row.

    The optimizer may move a projected expression into a lambda that mentions it once, where it
    runs again for every element; a lambda's own argument can't be moved.
    """
    return F.transform(F.array(value), body)[0]


def map_texts(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    make: Callable[[], Callable[[list, list[str]], list]],
    fields: str,
    batch_rows: int = 256,
) -> DataFrame:
    """Rows from (ids, texts) batches; null texts are empty.

    make() runs once per task and returns the function that turns a batch into a list of Arrow
    arrays, one per field after the id. batch_rows bounds the texts held as Python strings at once.
    """
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    names = ["doc_id", *(f.strip().split()[0].rstrip(":") for f in split_fields(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                ids = part.column(0)
                yield pa.RecordBatch.from_arrays([ids, *work(ids, part.column(1).to_pylist())], names)

    return source.mapInArrow(run, f"doc_id long, {fields}")


def map_rows(
    docs: DataFrame,
    text_col: str,
    make: Callable[[], Callable[[list[str]], list]],
    fields: str,
    batch_rows: int = 256,
) -> DataFrame:
    """docs with the fields that make()'s function gives for batches of texts; null texts are empty.

    Rows keep all their columns, so nothing has to be joined back. The names of the fields must be
    free in docs.
    """
    added = StructType.fromDDL(fields)
    schema = StructType([*docs.schema.fields, *added.fields])
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                texts = [t or "" for t in part.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, *work(texts)], schema.names)

    return docs.mapInArrow(run, schema)


def split_fields(fields: str) -> list[str]:
    """Top-level parts of a DDL field list."""
    parts, depth, begin = [], 0, 0
    for i, c in enumerate(fields):
        depth += (c in "<(") - (c in ">)")
        if c == "," and depth == 0:
            parts.append(fields[begin:i])
            begin = i + 1
    return [*parts, fields[begin:]]


SPANS_DDL = "array<struct<start:int,rank:int,stop:int,kind:string>>"
SPANS_ARROW = pa.list_(
    pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("stop", pa.int32()), ("kind", pa.string())])
)


def span_text(spans: Column) -> Column:
    """kind:start:stop of all spans, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))


def span_columns(spans: str, kinds: tuple[str, ...]) -> list[Column]:
    """Counts and digest of the base kinds, and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in kinds]
    base = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return [*counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col(spans)).alias("spans")]
