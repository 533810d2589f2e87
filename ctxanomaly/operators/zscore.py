"""Contextual z-score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxanomaly.config import CONTEXT_KEYS, MEASURE
from ctxanomaly.functions.expressions import flag_abs_gt
from ctxanomaly.operators.context import attach_context, context_moments
from ctxanomaly.session import cut


def zscore(
    df: DataFrame,
    context: Sequence[str] = CONTEXT_KEYS,
    x: str = MEASURE,
    threshold: float = 3.0,
    is_cut: bool = False,
    shuffled: bool = False,
) -> DataFrame:
    """Add group_mean, group_std (sample), z_score and is_anomaly.

    Statistics use every row of ``df``.  One-row contexts have a null std,
    constant contexts a zero std: both give a null z, never anomalous.
    ``df`` is read twice; unless it is a cut (``is_cut``) it is cut first.
    ``shuffled`` as in :func:`attach_context`.
    """
    df = df if is_cut else cut(df, "cells")
    return against(df, context_moments(df, context, x), context, x, threshold, shuffled)


def against(
    df: DataFrame,
    moments: DataFrame,
    context: Sequence[str] = CONTEXT_KEYS,
    x: str = MEASURE,
    threshold: float = 3.0,
    shuffled: bool = False,
) -> DataFrame:
    """:func:`zscore` against given context moments (those of a cut)."""
    out = attach_context(df, moments, context, "left", is_cut=True, shuffled=shuffled)
    out = out.withColumn(
        "z_score", F.try_divide(F.col(x) - F.col("group_mean"), F.col("group_std"))
    )
    return out.withColumn("is_anomaly", flag_abs_gt(F.col("z_score"), threshold))


def top_by_abs(
    df: DataFrame,
    col: str = "z_score",
    n: int = 20,
    tie_keys: Sequence[str] = ("datetime", "line", "line_name", "town"),
) -> DataFrame:
    """The n rows of largest |col| (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(
        F.abs(F.col(col)).desc_nulls_last(), *[F.col(k).asc_nulls_first() for k in tie_keys]
    ).limit(n)
