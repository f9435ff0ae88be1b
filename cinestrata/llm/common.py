"""Helpers that several operators share."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# White space of the word rule that all operators share: blank and the five controls from tab on.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrowed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast to the given types; whatever else the table has is left out."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES + "+")
    return F.filter(parts, lambda w: w != "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also inside lambdas.

    Spark copies an expression to every place that names it; within a lambda it would
    run again for each element.
    """
    return F.transform(F.array(value), use)[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that no piece has over ``limit`` bytes of ``column`` or else one row.

    Bounds the memory of a Python worker, however long the texts of a batch are.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def annotated(docs: DataFrame, run, fields: str) -> DataFrame:
    """``docs`` as column ``row`` beside the columns that ``run`` makes of each Arrow batch.

    ``run`` turns batches with the one column ``row`` into batches of the new columns and is
    given pieces of bounded size, so names of the table never clash with new ones.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(fields).fields])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = run()
        for batch in batches:
            texts = pc.struct_field(batch.column("row"), "text")
            beside = pa.RecordBatch.from_arrays([batch.column("row"), texts], ["row", "text"])
            for piece in pieces([beside], "text"):
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), *make(texts_of(piece))], schema.names)

    return rows.mapInArrow(whole, schema)


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])
