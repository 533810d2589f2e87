"""Report operators over scored rows.  Every report is an aggregate with map-side
combine; the only rows that meet in one task are already aggregated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxanomaly.config import METHOD_LABELS, OVERLAP_LABELS, SENSITIVITY_THRESHOLDS, SUMMARY_PROPERTIES
from ctxanomaly.functions.expressions import finite_nonneg, flag_of, rate
from ctxanomaly.operators.records import MALFORMED, at_least, line_slice

Z = "zscore_anomaly"
IF = "iforest_anomaly"
SCORE = "iforest_score"


def _flag(c: str) -> Column:
    """0/1 integer view of a boolean, numeric or text flag column."""
    return flag_of(F.col(c))


def _method_aggs(a: str, b: str, score: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_obs"),
        F.sum(_flag(a)).cast("bigint").alias("zscore_anomaly_count"),
        F.sum(_flag(b)).cast("bigint").alias("iforest_anomaly_count"),
        F.avg(score).alias("avg_iforest_score"),
    ]


def _method_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "zscore_anomaly_rate": rate(F.col("zscore_anomaly_count"), F.col("total_obs")),
            "iforest_anomaly_rate": rate(F.col("iforest_anomaly_count"), F.col("total_obs")),
        }
    )


def method_summary(df: DataFrame, a: str = Z, b: str = IF, score: str = SCORE) -> DataFrame:
    """One row: totals, both / only-A / only-B counts, score avg/max/min, rates."""
    fa, fb = _flag(a), _flag(b)
    out = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(fa).cast("bigint").alias("zscore_anomaly_count"),
        F.sum(fb).cast("bigint").alias("iforest_anomaly_count"),
        F.count_if((fa == 1) & (fb == 1)).alias("both_methods_anomaly_count"),
        F.count_if((fa == 1) & (fb == 0)).alias("only_zscore_anomaly_count"),
        F.count_if((fa == 0) & (fb == 1)).alias("only_iforest_anomaly_count"),
        F.avg(score).alias("avg_iforest_score"),
        F.max(score).alias("max_iforest_score"),
        F.min(score).alias("min_iforest_score"),
    )
    return _summary_rates(out)


def _summary_rates(out: DataFrame) -> DataFrame:
    both = F.col("both_methods_anomaly_count")
    return out.withColumns(
        {
            "zscore_anomaly_rate": rate(F.col("zscore_anomaly_count"), F.col("total_rows")),
            "iforest_anomaly_rate": rate(F.col("iforest_anomaly_count"), F.col("total_rows")),
            "method_overlap_rate": rate(both, F.col("total_rows")),
            "overlap_among_zscore_anomalies": rate(both, F.col("zscore_anomaly_count")),
            "overlap_among_iforest_anomalies": rate(both, F.col("iforest_anomaly_count")),
        }
    )


def method_by(
    df: DataFrame, key: str, a: str = Z, b: str = IF, score: str = SCORE
) -> DataFrame:
    """Per-key comparison of the two methods, the null key dropped (as in
    :func:`rate_by`).  Months sort ascending; other keys by forest rate
    descending, then key."""
    out = _method_rates(df.filter(F.col(key).isNotNull()).groupBy(key).agg(*_method_aggs(a, b, score)))
    return out.orderBy(*method_order(key))


def method_order(key: str) -> list[Column]:
    return [F.col(key)] if key == "month" else [F.col("iforest_anomaly_rate").desc(), F.col(key)]


def _grain() -> Column:
    """Which of the grouping sets (), (month), (line) a row belongs to."""
    gid = F.grouping_id()
    return F.when(gid == 3, F.lit("all")).when(gid == 1, F.lit("month")).otherwise(F.lit("line"))


def method_cube(df: DataFrame, a: str = Z, b: str = IF, score: str = SCORE) -> DataFrame:
    """Overall, per-month and per-line comparisons in one scan (grouping sets)."""
    out = df.groupingSets([[], ["month"], ["line"]], "month", "line").agg(
        _grain().alias("grain"), *_method_aggs(a, b, score)
    )
    return _method_rates(out)


def scored_cube(df: DataFrame, a: str = Z, b: str = IF, score: str = SCORE) -> DataFrame:
    """Everything the method reports need, by grain, in one scan."""
    fa, fb = _flag(a), _flag(b)
    return df.groupingSets([[], ["month"], ["line"]], "month", "line").agg(
        _grain().alias("grain"),
        *_method_aggs(a, b, score),
        F.count_if((fa == 1) & (fb == 1)).alias("both_methods_anomaly_count"),
        F.count_if((fa == 1) & (fb == 0)).alias("only_zscore_anomaly_count"),
        F.count_if((fa == 0) & (fb == 1)).alias("only_iforest_anomaly_count"),
        F.max(score).alias("max_iforest_score"),
        F.min(score).alias("min_iforest_score"),
    )


def scored_reports(cube: DataFrame) -> dict[str, DataFrame]:
    """The method reports from a (written) :func:`scored_cube`."""
    by = {}
    for key in ("month", "line"):
        rows = cube.filter((F.col("grain") == key) & F.col(key).isNotNull())
        cols = [key, "total_obs", "zscore_anomaly_count", "iforest_anomaly_count", "avg_iforest_score"]
        by[f"method_by_{key}"] = _method_rates(rows.select(*cols)).orderBy(*method_order(key))
    overall = cube.filter(F.col("grain") == "all").drop("grain", "month", "line")
    return {"method_summary": _summary_rates(overall.withColumnRenamed("total_obs", "total_rows")), **by}


def zscore_cube(
    df: DataFrame, flag: str = "is_anomaly", z: str = "z_score", thresholds: Sequence[float] = SENSITIVITY_THRESHOLDS
) -> DataFrame:
    """Everything the z-score reports need, by grain, in one scan."""
    zs = F.abs(F.col(z).try_cast("double"))
    sets = [[], ["month"], ["line"], ["hour"]]
    gid = F.grouping_id()
    grain = F.when(gid == 7, F.lit("all")).when(gid == 3, F.lit("month")).when(gid == 5, F.lit("line"))
    return df.groupingSets(sets, "month", "line", "hour").agg(
        grain.otherwise(F.lit("hour")).alias("grain"),
        F.count(F.lit(1)).alias("rows"),
        F.count(F.col(flag)).alias("total_obs"),
        F.sum(_flag(flag)).cast("bigint").alias("anomaly_count"),
        F.avg("total_passengers").alias("avg_passengers"),
        *[F.count_if(zs > F.lit(float(t))).alias(f"over_{i}") for i, t in enumerate(thresholds)],
    )


def zscore_reports(
    cube: DataFrame, columns: int, thresholds: Sequence[float] = SENSITIVITY_THRESHOLDS
) -> dict[str, DataFrame]:
    """The z-score reports from a (written) :func:`zscore_cube`; ``columns``:
    how many the table has."""
    every = cube.filter(F.col("grain") == "all")
    ratio = F.coalesce(rate(F.col("anomaly_count"), F.col("rows")), F.lit(0.0))
    overall = every.select(
        F.col("rows").alias("total_rows"),
        F.coalesce("anomaly_count", F.lit(0).cast("bigint")).alias("total_anomalies"),
        ratio.alias("anomaly_ratio"),
    )
    by = {}
    for key in ("month", "line"):
        rows = cube.filter((F.col("grain") == key) & F.col(key).isNotNull())
        by[key] = rows.select(
            key, "total_obs", "anomaly_count", rate(F.col("anomaly_count"), F.col("total_obs")).alias("anomaly_rate")
        )
    over = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(f"over_{i}").alias("anomaly_count"))
            for i, t in enumerate(thresholds)
        ]
    )
    sensitivity = every.select("rows", F.inline(over)).withColumn("anomaly_rate", rate(F.col("anomaly_count"), F.col("rows")))
    hours = cube.filter((F.col("grain") == "hour") & F.col("hour").isNotNull())
    return {
        "rate_by_line": by["line"].orderBy("line"),
        "rate_by_month": by["month"].orderBy("month"),
        "threshold_sensitivity": sensitivity.drop("rows").orderBy("threshold"),
        "top5_line_rate": by["line"].orderBy(F.col("anomaly_rate").desc(), F.col("line")).limit(5),
        "top_anomaly_lines": by["line"].filter("anomaly_count > 0").select("line", "anomaly_count")
        .orderBy(F.col("anomaly_count").desc(), F.col("line")).limit(10),
        "overall_ratio": overall,
        "dataset_summary": _summary_rows(overall, columns),
        "hourly_average": hours.select("hour", "avg_passengers").orderBy("hour"),
    }


def rate_by(df: DataFrame, key: str, flag: str = "is_anomaly") -> DataFrame:
    """Per-key observations (non-null flags), anomalies and rate; the null
    key group is dropped."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.col(flag)).alias("total_obs"),
            F.sum(_flag(flag)).cast("bigint").alias("anomaly_count"),
        )
        .withColumn("anomaly_rate", rate(F.col("anomaly_count"), F.col("total_obs")))
    )


def top_rate(df: DataFrame, key: str = "line", n: int = 5, flag: str = "is_anomaly") -> DataFrame:
    """The n keys of highest anomaly rate (ties by key)."""
    return rate_by(df, key, flag).orderBy(F.col("anomaly_rate").desc(), F.col(key)).limit(n)


def threshold_sensitivity(
    df: DataFrame, z: str = "z_score", thresholds: Sequence[float] = SENSITIVITY_THRESHOLDS
) -> DataFrame:
    """Anomaly count and rate for several |z| thresholds in a single pass.
    A null z never counts; the rate divides by all rows."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, t in enumerate(thresholds):
        aggs.append(F.count_if(F.abs(F.col(z).try_cast("double")) > F.lit(float(t))).alias(f"c{i}"))
    wide = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(f"c{i}").alias("anomaly_count"))
            for i, t in enumerate(thresholds)
        ]
    )
    return (
        wide.select("n", F.inline(rows))
        .withColumn("anomaly_rate", rate(F.col("anomaly_count"), F.col("n")))
        .drop("n")
    )


def anomaly_count_by(df: DataFrame, key: str = "line", flag: str = "is_anomaly", n: int = 10) -> DataFrame:
    """Keys with the most flagged rows (ties by key), null key dropped."""
    return (
        df.filter((_flag(flag) == 1) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("anomaly_count"))
        .orderBy(F.col("anomaly_count").desc(), F.col(key))
        .limit(n)
    )


def overall_ratio(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """Total rows, flagged rows and their ratio (0 for an empty table)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum(_flag(flag)), F.lit(0)).cast("bigint").alias("total_anomalies"),
    ).withColumn(
        "anomaly_ratio",
        F.coalesce(rate(F.col("total_anomalies"), F.col("total_rows")), F.lit(0.0)),
    )


def dataset_summary(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """Property / value rows: total rows, columns, anomaly count and ratio."""
    return _summary_rows(overall_ratio(df, flag), len(df.columns))


def _summary_rows(overall: DataFrame, columns: int) -> DataFrame:
    wide = overall.withColumn("total_columns", F.lit(columns))
    props = list(zip(SUMMARY_PROPERTIES, ("total_rows", "total_columns", "total_anomalies", "anomaly_ratio")))
    rows = F.array(
        *[
            F.struct(F.lit(p).alias("property"), F.col(c).cast("double").alias("value"))
            for p, c in props
        ]
    )
    return wide.select(F.inline(rows))


def line_series(df: DataFrame, line: str, flag: str = "is_anomaly", x: str = "total_passengers") -> DataFrame:
    """Time-ordered series of one line with an anomaly overlay column."""
    return (
        line_slice(df, line)
        .select(
            "datetime",
            "line_name",
            "town",
            x,
            F.when(_flag(flag) == 1, F.col(x)).alias("anomaly_passengers"),
        )
        .orderBy("datetime", F.col("line_name").asc_nulls_first(), F.col("town").asc_nulls_first())
    )


def line_ranking(df_by_line: DataFrame, min_obs: int = 0, top_n: int = 10) -> DataFrame:
    """Top lines by forest rate among lines with at least ``min_obs`` rows,
    then re-sorted ascending for display."""
    top = (
        at_least(df_by_line, min_obs)
        .orderBy(F.col("iforest_anomaly_rate").desc(), F.col("line"))
        .limit(top_n)
    )
    return top.orderBy(F.col("iforest_anomaly_rate").asc(), F.col("line").desc())


def line_rate_pairs(df_by_line: DataFrame, min_obs: int = 0) -> DataFrame:
    """(line, z rate, forest rate, size) for lines with >= min_obs rows."""
    return at_least(df_by_line, min_obs).select(
        "line", "zscore_anomaly_rate", "iforest_anomaly_rate", "total_obs"
    )


def _relabel(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for src, dst in mapping.items():
        out = (F.when(c == F.lit(src), F.lit(dst)) if out is None else out.when(c == F.lit(src), F.lit(dst)))
    return out.otherwise(c)


def monthly_long(by_month: DataFrame, what: str = "count") -> DataFrame:
    """Melt the per-month comparison to (month, method, value)."""
    suffix = "anomaly_count" if what == "count" else "anomaly_rate"
    value = "anomaly_count" if what == "count" else "anomaly_rate"
    cols = [f"zscore_{suffix}", f"iforest_{suffix}"]
    long = by_month.select("month", *cols).unpivot(["month"], cols, "method", value)
    labels = {f"zscore_{suffix}": METHOD_LABELS["zscore"], f"iforest_{suffix}": METHOD_LABELS["iforest"]}
    return long.withColumn("method", _relabel(F.col("method"), labels))


def method_table(summary: DataFrame) -> DataFrame:
    """(method, anomaly_count, anomaly_rate): one row per method."""
    rows = F.array(
        F.struct(
            F.lit(METHOD_LABELS["zscore"]).alias("method"),
            F.col("zscore_anomaly_count").alias("anomaly_count"),
            F.col("zscore_anomaly_rate").alias("anomaly_rate"),
        ),
        F.struct(
            F.lit(METHOD_LABELS["iforest"]).alias("method"),
            F.col("iforest_anomaly_count").alias("anomaly_count"),
            F.col("iforest_anomaly_rate").alias("anomaly_rate"),
        ),
    )
    return summary.select(F.inline(rows))


def overlap_table(summary: DataFrame) -> DataFrame:
    """(category, count) for both / only z / only forest."""
    cols = ("both_methods_anomaly_count", "only_zscore_anomaly_count", "only_iforest_anomaly_count")
    rows = F.array(
        *[F.struct(F.lit(lbl).alias("category"), F.col(c).alias("count")) for lbl, c in zip(OVERLAP_LABELS, cols)]
    )
    return summary.select(F.inline(rows))


def formatted_monthly(by_month: DataFrame) -> DataFrame:
    """Display strings: thousands separators and two-decimal percentages."""
    pct = lambda c: F.format_string("%.2f%%", F.col(c) * F.lit(100.0))
    return by_month.select(
        "month",
        F.format_number(F.col("total_obs"), 0).alias("total_obs"),
        F.format_number(F.col("zscore_anomaly_count"), 0).alias("zscore_anomaly_count"),
        F.format_number(F.col("iforest_anomaly_count"), 0).alias("iforest_anomaly_count"),
        pct("zscore_anomaly_rate").alias("zscore_anomaly_rate"),
        pct("iforest_anomaly_rate").alias("iforest_anomaly_rate"),
    )


RECORD_REASONS = (
    "malformed_line",
    "null_or_bad_date",
    "null_or_bad_hour",
    "hour_out_of_range",
    "null_or_bad_passengers",
    "negative_or_non_finite_passengers",
    "kept",
)


def record_reason(columns: Sequence[str]) -> Column:
    """First failing validity rule of a typed raw record, or 'kept'.  A line
    that is no record of its file (see ``read_records``) fails first."""
    hour = F.col("transition_hour")
    p = F.col("number_of_passenger")
    malformed = F.col(MALFORMED).isNotNull() if MALFORMED in columns else F.lit(False)
    return (
        F.when(malformed, F.lit("malformed_line"))
        .when(F.col("transition_date").isNull(), F.lit("null_or_bad_date"))
        .when(hour.isNull(), F.lit("null_or_bad_hour"))
        .when(~hour.between(0, 23), F.lit("hour_out_of_range"))
        .when(p.isNull(), F.lit("null_or_bad_passengers"))
        .when(~finite_nonneg(p), F.lit("negative_or_non_finite_passengers"))
        .otherwise(F.lit("kept"))
    )


def record_drop_reasons(cast_raw: DataFrame) -> DataFrame:
    """First failing validity rule of every typed raw record, counted."""
    reason = record_reason(cast_raw.columns)
    return cast_raw.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("row_count"))


CELL_REASONS = ("null_total", "negative_or_non_finite_total", "null_context_key", "bad_calendar", "small_context", "kept")


def cell_reason(min_obs: int = 5, size: Column | None = None) -> Column:
    """First failing forest-input rule of an hourly cell, or 'kept'.

    ``size``: the second-filter context size (default: ``context_obs_count``;
    null when the cell fails the second filter or its key never matches).
    Number columns that are text should be coerced before (``numeric_text``).
    """
    size = F.col("context_obs_count") if size is None else size
    return (
        F.when(
            F.col("total_passengers").isNull()
            | F.col("total_passages").isNull()
            | F.col("record_count").isNull(),
            F.lit("null_total"),
        )
        .when(
            ~finite_nonneg(F.col("total_passengers"))
            | ~finite_nonneg(F.col("total_passages"))
            | (F.col("record_count") <= 0),
            F.lit("negative_or_non_finite_total"),
        )
        .when(
            F.col("line").isNull() | F.col("hour").isNull() | F.col("spark_dayofweek").isNull(),
            F.lit("null_context_key"),
        )
        .when(
            F.col("month").isNull() | F.col("is_weekend").isNull() | ~F.col("hour").between(0, 23),
            F.lit("bad_calendar"),
        )
        .when(
            F.coalesce(size, F.lit(0)) < F.lit(min_obs),
            F.lit("small_context"),
        )
        .otherwise(F.lit("kept"))
    )


def cell_drop_reasons(cells_with_context: DataFrame, min_obs: int = 5) -> DataFrame:
    """First failing forest-input rule of every hourly cell, counted."""
    return cells_with_context.groupBy(cell_reason(min_obs).alias("reason")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def counted(reason: Column, names: Sequence[str]) -> dict[str, Column]:
    """One count per reason, to be observed while a stage is written."""
    return {name: F.count_if(reason == F.lit(name)) for name in names}


def observed_reasons(spark: SparkSession, stage: str, counts: dict[str, int]) -> DataFrame:
    """Observed counts as a drop-reason table (reasons that occur)."""
    rows = [(stage, reason, n) for reason, n in counts.items() if n]
    return spark.createDataFrame(rows, "stage string, reason string, row_count bigint")
