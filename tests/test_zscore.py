"""Contextual z-score: hand-computed micro-tables (FIXTURES.md section 4)."""

import datetime as dt

import pytest

from ctxanomaly.operators.zscore import zscore

SCHEMA = "datetime timestamp_ntz, line string, hour int, spark_dayofweek int, total_passengers double"


def cells(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def week(i):
    return dt.datetime(2024, 1, 1, 5) + dt.timedelta(days=7 * i)


def test_spike_n10_not_flagged_n11_flagged(spark):
    ten = [(week(i), "A", 5, 2, 0.0) for i in range(9)] + [(week(9), "A", 5, 2, 100.0)]
    eleven = [(week(i), "B", 5, 2, 0.0) for i in range(10)] + [(week(10), "B", 5, 2, 100.0)]
    out = {(r.line, r.total_passengers): r for r in zscore(cells(spark, ten + eleven)).collect()}
    assert out[("A", 100.0)].z_score == pytest.approx(2.846050, abs=1e-6)
    assert out[("A", 100.0)].is_anomaly is False
    assert out[("B", 100.0)].z_score == pytest.approx(3.015113, abs=1e-6)
    assert out[("B", 100.0)].is_anomaly is True


def test_one_row_and_constant_contexts_are_never_anomalous(spark):
    rows = [(week(0), "solo", 1, 1, 5.0)] + [(week(i), "flat", 2, 2, 7.0) for i in range(5)]
    out = zscore(cells(spark, rows)).collect()
    solo = [r for r in out if r.line == "solo"][0]
    assert solo.group_std is None and solo.z_score is None and solo.is_anomaly is False
    for r in out:
        if r.line == "flat":
            assert r.group_std == 0.0 and r.z_score is None and r.is_anomaly is False


def test_null_context_key_never_matches(spark):
    rows = [(week(i), None, 3, 3, float(i)) for i in range(12)] + [(week(12), None, 3, 3, 1000.0)]
    out = zscore(cells(spark, rows)).collect()
    assert len(out) == 13
    assert all(r.group_mean is None and r.z_score is None and r.is_anomaly is False for r in out)


def test_threshold_is_strict(spark):
    # z of the spike in a 10-row context is 2.846050...; a threshold equal
    # to it (rounded down by 1e-12) flags, one equal to the value does not.
    ten = [(week(i), "A", 5, 2, 0.0) for i in range(9)] + [(week(9), "A", 5, 2, 100.0)]
    z = max(r.z_score for r in zscore(cells(spark, ten)).collect())
    at = {r.total_passengers: r.is_anomaly for r in zscore(cells(spark, ten), threshold=z).collect()}
    below = {r.total_passengers: r.is_anomaly for r in zscore(cells(spark, ten), threshold=z - 1e-9).collect()}
    assert at[100.0] is False and below[100.0] is True


def test_stats_join_is_broadcast_when_small(spark):
    rows = [(week(i), "A", 5, 2, float(i)) for i in range(20)]
    plan = zscore(cells(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_large_stats_fall_back_to_shuffle_join(spark):
    rows = [(week(i), "A" if i % 2 else "B", 5, 2, float(i * i % 17)) for i in range(40)]
    df = cells(spark, rows)
    expected = sorted(tuple(r) for r in zscore(df).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = zscore(df)
        p = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    assert got == expected
