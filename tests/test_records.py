"""Edge rows of the raw-record stage (FIXTURES.md section 4)."""

import datetime as dt

from pyspark.sql import functions as F

from ctxanomaly.operators.hourly import ensure_temporal, hourly_aggregate, measure_sum, with_temporal
from ctxanomaly.operators.records import cast_records, valid_records, with_datetime
from ctxanomaly.plans.detect import hourly_cells
from ctxanomaly.schema import RAW_TEXT


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_TEXT)


def test_casts_and_validity_drop_bad_rows(spark):
    rows = [
        ("2024-01-08", "5", "L1", "N1", "T1", "10", "3"),  # kept
        ("2024-01-08", "24", "L1", "N1", "T1", "10", "3"),  # hour 24
        ("2024-01-08", "-1", "L1", "N1", "T1", "10", "3"),  # hour -1
        ("2024-01-08", None, "L1", "N1", "T1", "10", "3"),  # null hour
        ("2024-01-08", "x", "L1", "N1", "T1", "10", "3"),  # bad hour
        ("2024-01-08", "5", "L1", "N1", "T1", "-1", "3"),  # negative
        ("2024-01-08", "5", "L1", "N1", "T1", None, "3"),  # null passengers
        ("2024-01-08", "5", "L1", "N1", "T1", "n/a", "3"),  # unparsable
        ("not-a-date", "5", "L1", "N1", "T1", "10", "3"),  # bad date
        (None, "5", "L1", "N1", "T1", "10", "3"),  # null date
        ("2024-01-08", "5", "L1", "N1", "T1", "NaN", "3"),  # NaN: rejected (deviation)
        ("2024-01-08", "5", "L1", "N1", "T1", "Infinity", "3"),  # infinity
        ("2024-01-08", "6", "L1", "N1", "T1", "4", "-2"),  # negative passage is allowed
    ]
    out = valid_records(cast_records(raw(spark, rows))).collect()
    assert sorted((r.transition_hour, r.number_of_passenger) for r in out) == [(5, 10.0), (6, 4.0)]


def test_hours_of_any_number_form(spark):
    rows = [("2024-01-08", h, "L", "N", "T", "1", "1") for h in ("8.0", "8", "8.5", "1e1", " 7", "NaN", "1e300", "-0.0")]
    got = sorted(r.transition_hour for r in valid_records(cast_records(raw(spark, rows))).collect())
    assert got == [0, 7, 8, 8, 10]
    typed = raw(spark, rows[:1]).withColumn("transition_hour", F.lit(8.0))
    assert cast_records(typed).first().transition_hour == 8


def test_sums_keep_the_order_out(spark):
    values = [0.1, 1e9, 0.2, -0.0, 3.3, 7.7] * 50
    sums = set()
    for n in (1, 3, 17):
        df = spark.createDataFrame([("k", v) for v in values], "k string, v double").repartition(n)
        sums.add(df.groupBy("k").agg(measure_sum(F.col("v")).alias("s")).first().s)
    assert len(sums) == 1 and abs(sums.pop() - sum(values)) < 1e-3
    for big in ([1e18] * 30, [1e300, 1.0]):
        df = spark.createDataFrame([(v,) for v in big], "v double")
        assert df.agg(measure_sum(F.col("v")).alias("s")).first().s == sum(big)


def test_datetime_and_calendar(spark):
    rows = [
        ("2024-01-07", "0", "L", "N", "T", "1", "1"),  # Sunday
        ("2024-01-06", "13", "L", "N", "T", "1", "1"),  # Saturday
        ("2024-01-08", "23", "L", "N", "T", "1", "1"),  # Monday
    ]
    out = {r.datetime: r for r in hourly_cells(raw(spark, rows)).collect()}
    sun = out[dt.datetime(2024, 1, 7, 0)]
    sat = out[dt.datetime(2024, 1, 6, 13)]
    mon = out[dt.datetime(2024, 1, 8, 23)]
    assert (sun.spark_dayofweek, sun.is_weekend, sun.hour, sun.month) == (1, 1, 0, 1)
    assert (sat.spark_dayofweek, sat.is_weekend, sat.hour) == (7, 1, 13)
    assert (mon.spark_dayofweek, mon.is_weekend, mon.hour) == (2, 0, 23)


def test_hourly_sums_skip_nulls_and_count_rows(spark):
    rows = [
        ("2024-01-08", "5", "L1", "N1", "T1", "10", "3"),
        ("2024-01-08", "5", "L1", "N1", "T1", "20", None),  # passages partly null
        ("2024-01-08", "6", "L1", "N1", "T1", "7", None),  # passages all null
        ("2024-01-08", "5", "L1", "N1", "T2", "1", "1"),  # another town: own cell
        ("2024-01-08", "5", None, "N1", "T1", "2", "2"),  # null line: own group
    ]
    cells = hourly_aggregate(with_datetime(valid_records(cast_records(raw(spark, rows))))).collect()
    by_key = {(r.datetime.hour, r.line, r.town): r for r in cells}
    a = by_key[(5, "L1", "T1")]
    assert (a.total_passengers, a.total_passages, a.record_count) == (30.0, 3.0, 2)
    b = by_key[(6, "L1", "T1")]
    assert b.total_passages is None and b.record_count == 1
    assert (5, "L1", "T2") in by_key and (5, None, "T1") in by_key
    assert len(cells) == 4


def test_ensure_temporal_fills_only_missing(spark):
    rows = [("2024-01-07", "3", "L", "N", "T", "1", "1")]
    cells = with_temporal(hourly_aggregate(with_datetime(cast_records(raw(spark, rows)))))
    partial = cells.drop("month", "is_weekend").withColumn("hour", cells.hour + 100)
    out = ensure_temporal(partial).collect()[0]
    assert out.hour == 103  # present: untouched
    assert (out.month, out.is_weekend, out.spark_dayofweek) == (1, 1, 1)


def test_ensure_temporal_names_missing_source(spark):
    import pytest

    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="datetime"):
        ensure_temporal(df)


def test_results_do_not_depend_on_session_time_zone(spark):
    from ctxanomaly.sources import raw_events

    from conftest import SF001

    def cells():
        return {tuple(r) for r in hourly_cells(raw_events(spark, SF001)).collect()}

    old = spark.conf.get("spark.sql.session.timeZone")
    base = cells()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        shifted = cells()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == shifted
