"""Context statistics, their attachment to the fact, and leave-one-out moments.

A context is a coarser key than the fact (default: line, hour, day of
week).  Statistics are aggregated (partial + final, so hot contexts cost one
row per map partition) and joined back by an equi join: a null context key
never matches, so such rows keep null statistics.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxanomaly.config import CONTEXT_KEYS, EPS, FEATURE_DIGITS, MEASURE
from ctxanomaly.functions.expressions import rate
from ctxanomaly.functions.sums import FixedSums, ScaledSums, unit_for
from ctxanomaly.session import cut, cut_observed, fits_broadcast

RATIOS = {
    "passage_per_passenger": ("total_passages", "total_passengers"),
    "passenger_per_record": ("total_passengers", "record_count"),
    "passage_per_record": ("total_passages", "record_count"),
}


def _sums(c: str) -> ScaledSums:
    """Scaled sums of ``c`` from the statistics of its context."""
    return ScaledSums(F.col(c), *[F.col(f"_{n}_{c}") for n in ("n", "lo", "hi", "unit")])


def _finite(c: str) -> Column:
    return F.when(F.abs(F.col(c)) < float("inf"), F.col(c))  # NaN is above infinity


def context_state(df: DataFrame, context: Sequence[str], x: str, others: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Per context (and ``by``, e.g. the month): rows, count, extremes and
    exact sums of ``x``, and sums of the parts of the other columns; null
    context keys are left out.

    One aggregate with map-side combine.  All columns are counts, sums of
    whole numbers and extremes, so states of different rows merge
    (:func:`merge_states`) to the state of all of them, bit for bit.
    """
    keys = [*by, *context]
    keyed = df.dropna(subset=list(context)).select(*keys, *[_finite(c).alias(c) for c in (x, *others)])
    aggs = [F.count(F.lit(1)).alias("_rows"), F.min(x).alias(f"_lo_{x}"), F.max(x).alias(f"_hi_{x}"), *FixedSums(x).aggregates()]
    for c in others:
        parts = [F.sum(f"_{p}_{c}").alias(f"_{p}_{c}") for p in ("whole", "f1", "f2")]
        aggs += [F.count(f"_whole_{c}").alias(f"_n_{c}"), F.count(f"_far_{c}").alias(f"_far_{c}"), *parts]
    return fixed_rows(keyed, x, others).groupBy(*keys).agg(*aggs)


def merge_states(state: DataFrame, context: Sequence[str] = CONTEXT_KEYS) -> DataFrame:
    """One state per context from several (of months, of sources), without
    the cells they came from."""
    both = {"_lo": F.min, "_hi": F.max}
    merged = [c for c in state.columns if c.startswith("_")]
    return state.groupBy(*context).agg(*[both.get(c[:3], F.sum)(c).alias(c) for c in merged])


def state_sums(state: DataFrame, context: Sequence[str], x: str, others: Sequence[str] = ()) -> DataFrame:
    """The sums that the statistics are read from, and ``_poor``: whether the
    state cannot give them exactly (an ``x`` that the scale cannot express,
    another column out of its range, or totals beyond 38 digits)."""
    sums = FixedSums(x).scaled(state.withColumn(f"_unit_{x}", unit_for(F.col(f"_n_{x}"))))
    s, s2 = F.col(f"_s_{x}"), F.col(f"_s2_{x}")
    out_of_range = [F.col(f"_misfit_{x}") > 0, *[F.col(f"_far_{c}") > 0 for c in others]]
    poor = reduce(Column.__or__, out_of_range) | ((F.col(f"_n_{x}") > 0) & (s.isNull() | s2.isNull()))
    kept = [*context, "_rows", *[f"_{p}_{x}" for p in ("n", "lo", "hi", "unit")]]
    means = [mean_of_parts(c).alias(f"_mean_{c}") for c in others]
    return sums.select(*kept, s, s2, *means, poor.alias("_poor"))


def context_sums(df: DataFrame, context: Sequence[str], x: str, others: Sequence[str] = ()) -> DataFrame:
    """Per context: rows (``_rows``), the count, extremes and scaled sums of
    ``x`` (see ``functions.sums``), and the mean of the other columns
    (``_mean_<c>``); null keys are left out.

    One pass, by :func:`context_state`.  Only contexts that the state cannot
    give exactly (how many is observed while the sums are written) are added
    up a second time, by :func:`wide_sums`.
    """
    state = state_sums(context_state(df, context, x, others), context, x, others)
    out, seen = cut_observed(state, "context_stats", poor=F.count_if("_poor"))
    if not seen["poor"]:
        return out.drop("_poor")
    again = df.select(*context, *[_finite(c).alias(c) for c in (x, *others)])
    again = again.join(out.filter("_poor").select(*context), list(context), "left_semi")
    return out.filter(~F.col("_poor")).drop("_poor").unionByName(wide_sums(again, context, x, others))


def fixed_rows(keyed: DataFrame, x: str, others: Sequence[str]) -> DataFrame:
    """The whole numbers that one row adds to the sums."""
    parts = FixedSums(x).halves(F.col(x))
    for c in others:
        v = F.when(F.abs(F.col(c)) < F.lit(2.0**31), F.col(c))
        parts[f"_far_{c}"] = F.when(F.col(c).isNotNull() & v.isNull(), F.lit(1))
        parts[f"_whole_{c}"] = F.floor(v).cast("bigint")
        half = F.lit(2.0**31)
        rest = (v - F.floor(v)) * half
        parts[f"_f1_{c}"] = F.floor(rest).cast("bigint")
        parts[f"_f2_{c}"] = F.rint((rest - F.floor(rest)) * half).cast("bigint")
    return keyed.withColumns(parts)


def mean_of_parts(c: str) -> Column:
    """Mean of a column from the sums of its whole parts and fractions."""
    part = lambda p: F.col(f"_{p}_{c}").cast("double")
    return F.try_divide(part("whole") + (part("f1") + part("f2") / F.lit(2.0**31)) / F.lit(2.0**31), part("n"))


def wide_sums(keyed: DataFrame, context: Sequence[str], x: str, others: Sequence[str] = ()) -> DataFrame:
    """:func:`context_sums` for any doubles: count and extremes first, then
    scaled sums of every column."""
    cols = [x, *others]
    spans = keyed.groupBy(*context).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[f(c).alias(f"_{n}_{c}") for c in cols for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))],
    )
    spans = cut(spans.withColumns({f"_unit_{c}": unit_for(F.col(f"_n_{c}")) for c in cols}), "context_spans")
    kept = [c for c in spans.columns if c not in context]
    sums = [F.sum(_sums(c).parts()[0]).alias(f"_s_{c}") for c in cols]
    sums.append(F.sum(_sums(x).parts()[1]).alias(f"_s2_{x}"))
    out = keyed.join(spans, list(context)).groupBy(*context).agg(*[F.any_value(c).alias(c) for c in kept], *sums)
    means = [_sums(c).mean(F.col(f"_s_{c}")).alias(f"_mean_{c}") for c in others]
    return out.select(*context, "_rows", *[f"_{p}_{x}" for p in ("n", "lo", "hi", "unit", "s", "s2")], *means)


def _moments(sums: DataFrame, context: Sequence[str], x: str) -> DataFrame:
    s, a, b = _sums(x), F.col(f"_s_{x}"), F.col(f"_s2_{x}")
    return sums.select(*context, s.mean(a).alias("group_mean"), s.std(a, b).alias("group_std"))


def context_moments(
    df: DataFrame, context: Sequence[str] = CONTEXT_KEYS, x: str = MEASURE
) -> DataFrame:
    """Mean and sample standard deviation of ``x`` per context."""
    return _moments(context_sums(df, context, x), context, x)


def state_moments(state: DataFrame, context: Sequence[str] = CONTEXT_KEYS, x: str = MEASURE) -> DataFrame:
    """:func:`context_moments` from merged states alone: the same bits, and no
    cell is read.  A context whose state cannot give exact sums is an error,
    as its cells would have to be read again."""
    sums, seen = cut_observed(state_sums(merge_states(state, context), context, x), "state_sums", poor=F.count_if("_poor"))
    if seen["poor"]:
        raise ValueError(f"{seen['poor']} contexts hold values that the state's scale cannot express; recompute them from the cells")
    return _moments(sums.drop("_poor"), context, x)


def ratio_features(df: DataFrame) -> DataFrame:
    """Per-cell ratios, each divided by (denominator + 1)."""
    return df.withColumns(
        {
            name: rate(F.col(num), F.col(den) + F.lit(1.0))
            for name, (num, den) in RATIOS.items()
        }
    )


def context_profile(
    df: DataFrame, context: Sequence[str] = CONTEXT_KEYS, x: str = MEASURE
) -> DataFrame:
    """Per-context count, mean, sample variance and mean ratios, with the
    scaled sums of ``x`` that :func:`leave_one_out` takes a row out of.

    Expects :func:`ratio_features` columns.  The moments are rounded like the
    features (``FEATURE_DIGITS``); the sums are not.
    """
    sums = context_sums(df, context, x, list(RATIOS))
    s, a, b = _sums(x), F.col(f"_s_{x}"), F.col(f"_s2_{x}")
    tidy = lambda c: F.round(c, FEATURE_DIGITS)
    averages = [tidy(F.col(f"_mean_{name}")).alias(f"context_avg_{name}") for name in RATIOS]
    return sums.select(
        *context,
        F.col("_rows").alias("context_obs_count"),
        tidy(s.mean(a)).alias("context_mean_passengers"),
        tidy(s.variance(a, b)).alias("context_var_passengers"),
        *averages,
        *[F.col(f"_{n}_{x}") for n in ("n", "lo", "hi", "unit", "s", "s2")],
    )


def attach_context(
    df: DataFrame,
    stats: DataFrame,
    context: Sequence[str] = CONTEXT_KEYS,
    how: str = "left",
    is_cut: bool = False,
    shuffled: bool = False,
) -> DataFrame:
    """Equi join of per-context statistics onto the fact.

    The statistics are written once (a cut; ``is_cut``: they come from one,
    as those of this module do); Spark broadcasts them when their
    size is within its threshold and else shuffles both sides on the context
    key, where AQE splits skewed partitions.  Rows with a null key match
    nothing: in the shuffled form they go round the join, so they never meet
    in one partition.

    ``shuffled``: join by shuffle at any size.  A fact stored in buckets of
    the context key (``session.cut_bucketed``) is not moved by it: Spark deals
    the statistics to its buckets.
    """
    stats = stats if is_cut else cut(stats, "context_stats")
    keys = list(context)
    shuffled = shuffled or not fits_broadcast(stats)
    stats = stats.hint("merge") if shuffled else stats
    if how == "left" and shuffled:
        bare = {f.name: F.lit(None).cast(f.dataType) for f in stats.schema.fields if f.name not in keys}
        null_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
        return df.filter(~null_key).join(stats, keys, "left").unionByName(df.filter(null_key).withColumns(bare))
    return df.join(stats, keys, how)


def min_context(df: DataFrame, n: int = 5) -> DataFrame:
    """Keep rows whose context holds at least ``n`` observations.

    After a left :func:`attach_context` this filter rejects null counts, so
    Catalyst turns the outer join into an inner one.
    """
    return df.filter(F.col("context_obs_count") >= F.lit(n))


def leave_one_out(df: DataFrame, x: str = MEASURE) -> DataFrame:
    """Context mean and std of ``x`` without the row itself.

    The row's own share is taken out of the context's scaled sums, which are
    whole numbers (exact), and the moments of the remaining n - 1 values are
    read from them: mean', var' (0 for a single value), std' = sqrt(var' + 1e-6).
    Values are measured from the context's minimum in units of its range, so
    nothing cancels when they are large against their spread, and equal
    values leave a variance of exactly 0.
    """
    s = _sums(x)
    q, q2 = s.parts()
    left, rest, rest2 = F.col(f"_n_{x}") - 1, F.col(f"_s_{x}") - q, F.col(f"_s2_{x}") - q2
    var = F.when(left > 0, F.coalesce(s.variance(rest, rest2, left), F.lit(0.0)))
    out = df.withColumns(
        {
            "loo_mean_passengers": s.mean(rest, left),
            "loo_std_passengers": F.sqrt(var + F.lit(EPS)),
        }
    )
    return out.drop(*[f"_{n}_{x}" for n in ("n", "lo", "hi", "unit", "s", "s2")])
