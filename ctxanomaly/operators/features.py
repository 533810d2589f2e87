"""Forest input preparation: label, second filter, context features, scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctxanomaly.config import CONTEXT_KEYS, EPS, FEATURE_DIGITS, FEATURES, MEASURE
from ctxanomaly.functions.expressions import finite_nonneg, flag_of, rate, round_columns
from ctxanomaly.functions.sums import FixedSums, ScaledSums, unit_for
from ctxanomaly.operators.context import (
    attach_context,
    context_profile,
    leave_one_out,
    min_context,
    ratio_features,
)
from ctxanomaly.operators.hourly import ensure_temporal
from ctxanomaly.operators.records import fill_zero
from ctxanomaly.session import cut

SECOND_FILTER_COLUMNS = (
    "total_passengers",
    "total_passages",
    "record_count",
    "hour",
    "month",
    "spark_dayofweek",
    "is_weekend",
)


#: What :func:`deviations` reads of a row's context.
PROFILE_COLUMNS = (
    "loo_mean_passengers",
    "loo_std_passengers",
    "context_avg_passage_per_passenger",
    "context_avg_passenger_per_record",
)


def normalize_label(df: DataFrame, src: str = "is_anomaly", dst: str = "zscore_anomaly") -> DataFrame:
    """0/1 integer label for comparison (never a feature).

    An existing numeric ``dst`` is cast.  Else ``dst``, or ``src`` without
    one, counts as 1 when it is true, 'true' in any case, or numerically 1;
    an absent label is 0.
    """
    kinds = dict(df.dtypes)
    if kinds.get(dst, "string") not in ("string", "boolean"):
        return df.withColumn(dst, F.col(dst).try_cast("int"))
    for c in (dst, src):
        if c in kinds:
            return df.withColumn(dst, flag_of(F.col(c)))
    return df.withColumn(dst, F.lit(0))


def numeric_text(df: DataFrame) -> DataFrame:
    """The forest's number columns where they are text: totals as doubles,
    counts and calendar fields as whole numbers; bad values become null."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    out = coerce_numeric(df, [c for c in SECOND_FILTER_COLUMNS if c in texts])
    whole = {"record_count": "bigint", "hour": "int", "month": "int", "spark_dayofweek": "int", "is_weekend": "int"}
    return out.withColumns({c: F.col(c).try_cast(kind) for c, kind in whole.items() if c in texts})


def coerce_numeric(df: DataFrame, cols: Sequence[str] = SECOND_FILTER_COLUMNS) -> DataFrame:
    """``try_cast`` the present columns to double; unparsable values become null."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in present})


def complete_rows(df: DataFrame, cols: Sequence[str] = SECOND_FILTER_COLUMNS) -> DataFrame:
    """Drop rows with a null (or NaN) in any listed column."""
    return df.dropna(subset=list(cols))


def in_range_rows(df: DataFrame) -> DataFrame:
    """Finite totals >= 0, record_count > 0, hour within 0..23."""
    return df.filter(
        finite_nonneg(F.col("total_passengers"))
        & finite_nonneg(F.col("total_passages"))
        & (F.col("record_count") > F.lit(0))
        & F.col("hour").between(0, 23)
    )


def labelled_cells(df: DataFrame) -> DataFrame:
    """Label, numbers and temporal columns, ahead of the second filter."""
    return ensure_temporal(numeric_text(normalize_label(df)))


def second_filter(df: DataFrame) -> DataFrame:
    return in_range_rows(complete_rows(df))


def forest_input(df: DataFrame) -> DataFrame:
    """Label, temporal columns and the second filter, ahead of the features.

    Typed columns keep their types; text is coerced first, and what cannot
    be read as a number is dropped by the filters (and counted by
    ``cell_drop_reasons``).
    """
    return second_filter(labelled_cells(df))


def context_features(
    df: DataFrame,
    context: Sequence[str] = CONTEXT_KEYS,
    x: str = MEASURE,
    min_obs: int = 5,
    is_cut: bool = False,
    fact: DataFrame | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Ratios, context profile, n >= min_obs, leave-one-out moments and the
    ten deviation features (five signed, five absolute), nulls filled with 0.

    The context profile is computed over ``df`` itself (the rows passing the
    second filter), not over the z-score input.  ``df`` is read twice; unless
    it comes from a cut (``is_cut``) it is cut first.  ``fact``: the same rows
    for the second reading (with observed metrics, say); ``shuffled`` as in
    :func:`attach_context`.
    """
    return deviations(with_profile(df, context, x, min_obs, is_cut, fact, shuffled), x)


def with_profile(
    df: DataFrame,
    context: Sequence[str] = CONTEXT_KEYS,
    x: str = MEASURE,
    min_obs: int = 5,
    is_cut: bool = False,
    fact: DataFrame | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """The rows of contexts with ``min_obs`` observations, the profile of each
    one's context and its leave-one-out moments (arguments as in
    :func:`context_features`)."""
    df = df if is_cut else cut(df, "forest_input")
    stats = context_profile(ratio_features(df), context, x)
    joined = attach_context(df if fact is None else fact, stats, context, "inner", is_cut=True, shuffled=shuffled)
    return leave_one_out(min_context(joined, min_obs), x)


def deviations(df: DataFrame, x: str = MEASURE) -> DataFrame:
    """The ten features of rows that hold their context's profile: a
    projection of ``PROFILE_COLUMNS`` and the row's own totals."""
    out = ratio_features(df)
    xc = F.col(x)
    mu = F.col("loo_mean_passengers")
    signed = {
        "independent_context_residual": (xc - mu) / (F.col("loo_std_passengers") + F.lit(EPS)),
        "relative_to_context_mean": rate(xc - mu, mu + F.lit(1.0)),
        "log_observed_expected_ratio": F.log1p(xc) - F.log1p(mu),
        "passage_per_passenger_diff": F.col("passage_per_passenger")
        - F.col("context_avg_passage_per_passenger"),
        "passenger_per_record_diff": F.col("passenger_per_record")
        - F.col("context_avg_passenger_per_record"),
    }
    out = round_columns(out.withColumns(signed), list(signed), FEATURE_DIGITS)
    out = out.withColumns({f"abs_{k}": F.abs(F.col(k)) for k in signed})
    return fill_zero(out, FEATURES)


def feature_moments(df: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """One-row frame: mean and sample std of every column.

    One pass: the values, at the scale that features are rounded to, are added
    up exactly, one group per column (a few groups, combined on the map side),
    so the moments do not depend on order or partitioning.  Columns with a
    value that the scale cannot express are added up by :func:`wide_moments`.
    """
    fixed = FixedSums("x", 10**FEATURE_DIGITS)
    values = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("at", "x"))
    sums = values.withColumns(fixed.halves(F.col("x"))).groupBy("at").agg(*fixed.aggregates()).collect()
    moments: dict[str, float | None] = {}
    wide = [cols[r["at"]] for r in sums if r["_misfit_x"]]
    for r in sums:
        moments[f"{cols[r['at']]}_mean"], moments[f"{cols[r['at']]}_std"] = fixed.moments(r)
    if wide:
        moments |= wide_moments(df, wide).first().asDict()
    names = [f"{c}_{m}" for c in cols for m in ("mean", "std")]
    one = [tuple(moments.get(n) for n in names)]
    return df.sparkSession.createDataFrame(one, ", ".join(f"`{n}` double" for n in names))


def wide_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """:func:`feature_moments` for any doubles: the extremes first (one row,
    brought to the driver), then sums scaled by them."""
    spans = df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).first()
    aggs = []
    for c in cols:
        n, lo, hi = spans[f"n_{c}"], spans[f"lo_{c}"], spans[f"hi_{c}"]
        s = ScaledSums(F.col(c), F.lit(n), F.lit(lo).cast("double"), F.lit(hi).cast("double"), unit_for(F.lit(n)))
        aggs += [s.mean(s.sums()[0]).alias(f"{c}_mean"), s.std(*s.sums()).alias(f"{c}_std")]
    return df.agg(*aggs)


def fit_scaler(df: DataFrame, cols: Sequence[str] = FEATURES) -> dict[str, tuple[float, float]]:
    """Global (mean, std) per column; null mean -> 0, null or zero std -> 1.

    Like any estimator fit, this brings one aggregate row (2 numbers per
    column) to the driver.
    """
    row = feature_moments(df, cols).first()
    params = {}
    for c in cols:
        mean = row[f"{c}_mean"]
        std = row[f"{c}_std"]
        params[c] = (0.0 if mean is None else float(mean), 1.0 if not std else float(std))
    return params


def standardize(
    df: DataFrame,
    cols: Sequence[str] = FEATURES,
    params: dict[str, tuple[float, float]] | None = None,
    suffix: str = "_scaled",
) -> DataFrame:
    """Add ``<col>_scaled = (col - mean) / std`` with zero fill."""
    params = params or fit_scaler(df, cols)
    scaled = {
        f"{c}{suffix}": (F.col(c) - F.lit(params[c][0])) / F.lit(params[c][1]) for c in cols
    }
    return fill_zero(df.withColumns(scaled), scaled)
