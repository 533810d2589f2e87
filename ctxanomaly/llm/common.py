"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxanomaly.session import cut, ship_package

__all__ = ["cut", "table", "prepare", "own_name", "text_key", "body", "same_row", "arrow_rows", "partitions_for"]

#: Rows and bytes in one Arrow batch handed to Python.  Texts may be long, so
#: batches are kept small; a user's smaller setting wins.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Ship the package to Python workers and bound the Arrow batches."""
    ship_package(spark)
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).rstrip("bB")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


def own_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it
    (in any case): columns of the caller are never taken for ours."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: str = "text") -> Column:
    """64-bit digest of a text.  ``(doc_id, text_key)`` names a row: rows that
    repeat both are alike in everything the operators read."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def body(text: str = "text") -> Column:
    """UTF-8 bytes of a text; a null text is empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def same_row(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns (an equi-join for Spark)."""
    cond = F.lit(True)
    for n in names:
        cond = cond & a[n].eqNullSafe(b[n])
    return cond


def arrow_rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns of each batch as Python lists, one tuple per batch."""
    for batch in batches:
        yield tuple(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)


def partitions_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Partitions for ``rows`` so that one task gets about ``rows_per_task``,
    and never fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-rows // rows_per_task))
