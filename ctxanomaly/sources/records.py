"""Sources: raw CSV records, stage tables, part-file directories, result files.

CSV columns are found by the names in the header, whatever their order.
"""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctxanomaly.operators.records import MALFORMED
from ctxanomaly.schema import RAW_TEXT


def _csv_text(spark: SparkSession, paths: str | list[str], header: list[str], same: bool, malformed: bool = False) -> DataFrame:
    """CSV files as text columns named by ``header``.  ``same``: every file
    must have it (Spark stops at the first that has not, naming the file).
    ``malformed``: one more column holds the lines that do not have the
    header's number of fields; they are only found where every field is parsed."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if malformed:
        schema = schema.add(MALFORMED, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
    reader = reader.schema(schema)
    return reader.option("enforceSchema", not same).csv(paths)


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files by their header line: one pass over the text, of which one line
    a file and task goes on."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")
    )
    first = (
        lines.filter("at = 0")
        .withColumn("i", F.monotonically_increasing_id())
        .groupBy("file")
        .agg(F.min_by("value", "i").alias("header"))
    )
    rows = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return {r["header"].lstrip("\ufeff"): [unquote(f) for f in r["files"]] for r in rows}


def _names(header: str) -> list[str]:
    return [c.strip() for c in next(csv.reader([header]))]


def read_records(
    spark: SparkSession, path: str, schema=RAW_TEXT, by_file: bool = False, malformed: bool = False
) -> DataFrame:
    """Multi-file CSV scan: the columns of ``schema`` by header name, as text.

    Other columns are ignored; a missing one is an error.  The files must
    agree in their header (checked by Spark while it reads); ``by_file=True``
    reads each group of files by its own header instead, for one more pass
    over the text.

    ``malformed=True`` adds the column ``_malformed``: the text of a line with
    too few or too many fields, as an unclosed quote leaves it (in the last
    field it loses nothing: the value ends with the line), else null.  Such
    lines are dropped by ``valid_records`` and are a drop reason of their own.
    """
    wanted = [f.name for f in schema.fields]
    more = [MALFORMED] if malformed else []

    def select(df: DataFrame, where: str) -> DataFrame:
        if missing := [c for c in wanted if c not in df.columns]:
            raise ValueError(f"column {', '.join(missing)} missing in {where} (it has: {', '.join(df.columns)})")
        return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields], *more)

    if by_file:
        groups = _headers(spark, path)
        if not groups:
            raise FileNotFoundError(f"no records in {path}")
        parts = [select(_csv_text(spark, files, _names(h), False, malformed), files[0]) for h, files in sorted(groups.items())]
        return reduce(DataFrame.unionAll, parts)
    header = spark.read.option("header", True).csv(path).columns
    return select(_csv_text(spark, path, header, True, malformed), path)


def read_stage(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Re-scan of a stage table written by :func:`ctxanomaly.sources.sinks.write_stage`.
    A CSV read with a schema finds its columns by name."""
    if fmt == "csv":
        if schema is not None:
            return read_records(spark, path, schema)
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.format(fmt).load(path)


def merge_parts(spark: SparkSession, path: str, fmt: str = "csv", schema=None) -> DataFrame:
    """All part files of a directory as one table (union all, by column name).

    Parts may have their columns in any order and lack some (null then);
    with a schema, columns it does not name are left out.  A directory
    without part files is an error, as is a missing one.
    """
    if fmt == "csv":
        groups = _headers(spark, path)
        if not groups:
            raise FileNotFoundError(f"no {fmt} part files in {path}")
        parts = [_csv_text(spark, files, _names(h), same=False) for h, files in sorted(groups.items())]
    else:
        reader = spark.read.option("mergeSchema", True) if fmt in ("parquet", "orc") else spark.read
        parts = [reader.format(fmt).load(path)]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if schema is None:
        return df
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def read_results(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Z-score results of any tool, ready for the reports: datetime, z-score
    and measures coerced (bad values become null), the label as 0/1."""
    from ctxanomaly.operators.features import coerce_numeric, normalize_label

    if fmt == "csv":
        df = _csv_text(spark, path, spark.read.option("header", True).csv(path).columns, same=True)
    else:
        df = read_stage(spark, path, fmt)
    if "datetime" in df.columns:
        df = coerce_datetime(df)
    numbers = ("total_passengers", "total_passages", "record_count", "group_mean", "group_std", "z_score")
    calendar = [c for c in ("hour", "month", "spark_dayofweek", "is_weekend") if c in df.columns]
    df = coerce_numeric(df, numbers)
    df = df.withColumns({c: F.col(c).try_cast("double").try_cast("int") for c in calendar})
    return normalize_label(df)


def coerce_datetime(df: DataFrame, col: str = "datetime") -> DataFrame:
    """Text or typed datetime column to ``timestamp_ntz``; bad values -> null.

    Text is read as wall-clock time (no session time zone involved).
    """
    return df.withColumn(col, F.col(col).try_cast("timestamp_ntz"))


def profile_metrics(df: DataFrame, cols: list[str] | None = None) -> dict[str, Column]:
    """Row count and non-null count per column, as named aggregates: for
    :func:`profile`, or to be observed by a job that reads the rows anyway."""
    return {"row_count": F.count(F.lit(1)), **{f"non_null_{c}": F.count(F.col(c)) for c in cols or df.columns}}


def profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Row count and non-null count per column, in one aggregate."""
    return df.agg(*[c.alias(name) for name, c in profile_metrics(df, cols).items()])
