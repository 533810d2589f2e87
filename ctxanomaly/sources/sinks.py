"""Sinks: stage tables and single-file reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_stage(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write a stage table.  Parquet keeps types; CSV gets a header.

    With ``partition_by`` the rows are rebalanced on those columns first
    (Spark splits large groups and merges small ones), so a folder gets a few
    full files instead of one from every task.  ``mode="replace"`` replaces
    the partitions that the rows fall into and leaves all others alone.
    """
    if mode == "replace" and not partition_by:
        raise ValueError("only a partitioned table can have partitions replaced")
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite" if mode == "replace" else mode).format(fmt)
    if mode == "replace":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_report(
    df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", order: Sequence[Column | str] = ()
) -> None:
    """One output file for an already aggregated report.  ``repartition(1)``
    adds a shuffle of the few report rows instead of collapsing the
    parallelism of the aggregate upstream; ``order`` is applied inside that
    one partition, after the shuffle, so the file keeps it."""
    one = df.repartition(1)
    if order:
        one = one.sortWithinPartitions(*order)
    writer = one.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
