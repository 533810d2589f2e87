"""Second filter, leave-one-out features, label forms, scaling."""

import datetime as dt
import math
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ctxanomaly.config import EPS, FEATURES
from ctxanomaly.functions.expressions import round_columns
from ctxanomaly.operators.features import (
    context_features,
    fit_scaler,
    forest_input,
    normalize_label,
    standardize,
)
from ctxanomaly.operators.records import select_present
from ctxanomaly.operators.zscore import zscore
from ctxanomaly.session import broadcast_limit_bytes

CELLS = (
    "datetime timestamp_ntz, line string, line_name string, town string, total_passengers double, "
    "total_passages double, record_count bigint, hour int, month int, spark_dayofweek int, "
    "is_weekend int, is_anomaly boolean"
)


def week(i, hour=5):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=7 * i)


def cell(i, line, x, passages=1.0, rc=1, hour=5):
    return (week(i, hour), line, "N", "T", x, passages, rc, hour, 1, 2, 0, False)


def feats(spark, rows):
    return context_features(forest_input(spark.createDataFrame(rows, CELLS)))


def raw_loo(xs, i):
    """Leave-one-out moments in the raw-moment form."""
    n = len(xs)
    s, s2, x = sum(xs), sum(v * v for v in xs), xs[i]
    n1 = n - 1.0
    ls, ls2 = s - x, s2 - x * x
    mean = ls / n1
    var = max((ls2 - ls * ls / n1) / max(n1 - 1.0, 1.0), 0.0)
    return mean, math.sqrt(var + EPS)


def test_constant_context(spark):
    out = feats(spark, [cell(i, "C", 7.0) for i in range(5)]).collect()
    assert len(out) == 5
    for r in out:
        assert r.loo_std_passengers == pytest.approx(0.001)
        assert r.independent_context_residual == 0.0
        assert r.loo_mean_passengers == 7.0


def test_constant_remainder_has_zero_variance(spark):
    # every other row equal: the leave-one-out variance is exactly 0
    rows = [cell(i, "R", 3.0) for i in range(9)] + [cell(9, "R", 4999.0)]
    out = {r.total_passengers: r for r in feats(spark, rows).collect()}
    assert out[4999.0].loo_std_passengers == math.sqrt(EPS)
    assert out[4999.0].loo_mean_passengers == 3.0


@pytest.mark.parametrize(
    "xs",
    [
        [1e9 + i for i in range(12)],
        [1e15 + i for i in range(12)],
        [1e-7 * i * i for i in range(9)],
        [0.0, 1e-9, 5e-9, 2e-9, 3e-9],
        [12345.67, 99.01, 4.5, 70000.25, 12.0, 12.0, 13.0],
    ],
)
def test_loo_equals_direct_moments(spark, xs):
    """Against the moments of the other rows themselves, in exact arithmetic."""
    rows = feats(spark, [cell(i, "D", x) for i, x in enumerate(xs)]).collect()
    for r in rows:
        i = xs.index(r.total_passengers)
        rest = [Fraction(x) for j, x in enumerate(xs) if j != i]
        mean = sum(rest) / len(rest)
        var = sum((x - mean) ** 2 for x in rest) / (len(rest) - 1)
        assert r.loo_mean_passengers == pytest.approx(float(mean), rel=1e-12)
        # float(var) is exact to the last digit; the epsilon of 1e-6 is part of the method
        assert r.loo_std_passengers**2 - EPS == pytest.approx(float(var), rel=1e-6, abs=1e-12)


def test_text_and_labels_reach_the_forest_input(spark):
    text = spark.createDataFrame([cell(i, "A", 1.0 + i) for i in range(7)], CELLS)
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns]).withColumn("zscore_anomaly", F.lit("1.0"))
    text = text.withColumn("total_passages", F.when(F.col("total_passengers") == "3.0", "n/a").otherwise(F.col("total_passages")))
    out = forest_input(text.withColumn("datetime", F.col("datetime").cast("timestamp_ntz")))
    rows = out.collect()
    assert len(rows) == 6 and all(r.zscore_anomaly == 1 for r in rows)
    assert dict(out.dtypes)["record_count"] == "bigint" and dict(out.dtypes)["hour"] == "int"


def test_null_keys_go_round_the_shuffled_join(spark):
    rows = [cell(i, "A", 1.0 + i) for i in range(6)] + [cell(9, None, 2.0)]
    df = spark.createDataFrame(rows, CELLS)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = sorted(map(tuple, zscore(df).collect()), key=repr)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = zscore(df)
        assert sorted(map(tuple, out.collect()), key=repr) == want
        assert "Union" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("text,value", [("1GB", 1 << 30), ("64m", 64 << 20), ("-1", -1), ("123", 123)])
def test_broadcast_threshold_is_parsed(spark, text, value):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert broadcast_limit_bytes(spark) == value
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_context_size_filter(spark):
    rows = [cell(i, "four", 1.0 + i) for i in range(4)] + [cell(i, "five", 1.0 + i) for i in range(5)]
    lines = {r.line for r in feats(spark, rows).collect()}
    assert lines == {"five"}


def test_second_filter_drops_null_and_negative_totals(spark):
    rows = [cell(i, "A", 1.0 + i) for i in range(6)]
    rows.append((week(9), "A", "N", "T", 5.0, None, 1, 5, 1, 2, 0, False))  # null passages
    rows.append((week(10), "A", "N", "T", -1.0, 1.0, 1, 5, 1, 2, 0, False))  # negative
    rows.append((week(11), None, "N", "T", 5.0, 1.0, 1, 5, 1, 2, 0, False))  # null line
    out = feats(spark, rows).collect()
    assert len(out) == 6 and all(r.line == "A" for r in out)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=5000), min_size=5, max_size=12))
def test_loo_matches_raw_moment_formula(spark, xs):
    rows = [cell(i, "P", float(x)) for i, x in enumerate(xs)]
    out = sorted(feats(spark, rows).collect(), key=lambda r: r.datetime)
    for i, r in enumerate(out):
        mean, std = raw_loo([float(x) for x in xs], i)
        assert r.loo_mean_passengers == pytest.approx(mean, rel=1e-9, abs=1e-9)
        assert r.loo_std_passengers == pytest.approx(std, rel=1e-9, abs=1e-12)
        expected = (float(xs[i]) - mean) / (std + EPS)
        assert r.independent_context_residual == pytest.approx(expected, rel=1e-6, abs=1e-6)
        assert r.abs_independent_context_residual == pytest.approx(abs(expected), rel=1e-6, abs=1e-6)


def test_label_forms(spark):
    df = spark.createDataFrame(
        [("true",), ("TRUE",), ("1",), ("false",), (None,), ("0",), ("1.0",)], "is_anomaly string"
    )
    assert [r.zscore_anomaly for r in normalize_label(df).collect()] == [1, 1, 1, 0, 0, 0, 1]
    b = spark.createDataFrame([(True,), (False,), (None,)], "is_anomaly boolean")
    assert [r.zscore_anomaly for r in normalize_label(b).collect()] == [1, 0, 0]
    existing = spark.createDataFrame([("1.0",), ("TRUE",), ("x",), (None,)], "zscore_anomaly string")
    assert [r.zscore_anomaly for r in normalize_label(existing).collect()] == [1, 1, 0, 0]
    i = spark.createDataFrame([(1,), (0,)], "is_anomaly int")
    assert [r.zscore_anomaly for r in normalize_label(i).collect()] == [1, 0]
    absent = spark.createDataFrame([(1,)], "x int")
    assert normalize_label(absent).collect()[0].zscore_anomaly == 0


def test_standardize_fallbacks(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    params = fit_scaler(df, ["a", "b"])
    assert params["a"] == (2.0, pytest.approx(math.sqrt(2.0)))
    assert params["b"] == (5.0, 1.0)  # zero std -> 1
    out = standardize(df, ["a", "b"], params).collect()
    assert [r.b_scaled for r in out] == [0.0, 0.0, 0.0]
    assert out[2].a_scaled == 0.0  # null filled


def test_select_present_keeps_order(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert select_present(df, ["b", "zz", "a"]).columns == ["b", "a"]


def test_feature_columns_complete(spark):
    out = feats(spark, [cell(i, "A", float(i * i)) for i in range(8)])
    assert set(FEATURES) <= set(out.columns)
    for r in out.collect():
        for c in FEATURES:
            assert r[c] is not None and math.isfinite(r[c])


def test_rounded_columns_are_those_of_round(spark):
    odd = [0.5e-10, 1.5e-10, -0.5e-10, -2.5e-10, 0.12345678905, -0.12345678905, 2.5, -0.0, -1e-12, 1e-320, 3518.4, 1e15, 1e300]
    near = [m * (k + 0.5) / 10**d for k in range(2000) for d, m in ((6, 1), (6, -1), (10, 1), (10, -7))]
    values = [*odd, *near, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v, None if v is None else v * 1.0000001) for v in values], "a double, b double")
    for digits in (6, 10):
        both = df.withColumns({f"want_{c}": F.round(c, digits) for c in ("a", "b")})
        both = round_columns(both, ["a", "b"], digits)
        assert both.columns == ["a", "b", "want_a", "want_b"]
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
        assert both.filter((text("a") != text("want_a")) | (text("b") != text("want_b"))).collect() == []
