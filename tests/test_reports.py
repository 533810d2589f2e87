"""Report reconciliations (the arithmetic relations of the published results)."""

from pyspark.sql import functions as F

from ctxanomaly.operators import reports as R


def test_summary_reconciles(detection001):
    s = R.method_summary(detection001.scored).collect()[0]
    assert s.both_methods_anomaly_count + s.only_zscore_anomaly_count == s.zscore_anomaly_count
    assert s.both_methods_anomaly_count + s.only_iforest_anomaly_count == s.iforest_anomaly_count
    assert s.total_rows == detection001.scored.count()
    assert s.min_iforest_score <= s.avg_iforest_score <= s.max_iforest_score


def test_month_and_line_totals_equal_grand_total(detection001):
    scored = detection001.scored
    s = R.method_summary(scored).collect()[0]
    for key in ("month", "line"):
        rows = R.method_by(scored, key).collect()
        assert sum(r.total_obs for r in rows) == s.total_rows
        assert sum(r.iforest_anomaly_count for r in rows) == s.iforest_anomaly_count
        assert sum(r.zscore_anomaly_count for r in rows) == s.zscore_anomaly_count
    months = [r.month for r in R.method_by(scored, "month").collect()]
    assert months == sorted(months)


def test_grouping_sets_match_separate_reports(detection001):
    scored = detection001.scored
    cube = R.method_cube(scored)
    by_month = {r.month: r.total_obs for r in R.method_by(scored, "month").collect()}
    got = {r.month: r.total_obs for r in cube.filter("grain = 'month'").collect()}
    assert got == by_month
    total = cube.filter("grain = 'all'").collect()[0].total_obs
    assert total == scored.count()


def test_threshold_sensitivity_counts_strictly(spark):
    df = spark.createDataFrame([(2.0,), (2.5,), (3.0,), (3.1,), (None,), (-2.6,)], "z_score double")
    out = {r.threshold: (r.anomaly_count, r.anomaly_rate) for r in R.threshold_sensitivity(df).collect()}
    assert out[2.0] == (4, 4 / 6)  # 2.5, 3.0, 3.1, -2.6; null never counts, rate over all rows
    assert out[2.5] == (3, 3 / 6)
    assert out[3.0] == (1, 1 / 6)


def test_rate_by_drops_null_key_and_counts_non_null_flags(spark):
    df = spark.createDataFrame(
        [("A", True), ("A", False), ("A", None), (None, True)], "line string, is_anomaly boolean"
    )
    rows = R.rate_by(df, "line").collect()
    assert len(rows) == 1
    assert (rows[0].total_obs, rows[0].anomaly_count, rows[0].anomaly_rate) == (2, 1, 0.5)


def test_overall_ratio_on_empty_table(spark):
    df = spark.createDataFrame([], "is_anomaly boolean")
    r = R.overall_ratio(df).collect()[0]
    assert (r.total_rows, r.total_anomalies, r.anomaly_ratio) == (0, 0, 0.0)


def test_dataset_summary_rows(spark):
    df = spark.createDataFrame([(True, 1), (False, 2)], "is_anomaly boolean, x int")
    got = {r.property: r.value for r in R.dataset_summary(df).collect()}
    assert got == {"Total rows": 2.0, "Total columns": 2.0, "Anomaly count": 1.0, "Anomaly ratio": 0.5}


def test_long_views_and_tables(detection001):
    scored = detection001.scored
    by_month = R.method_by(scored, "month")
    long = R.monthly_long(by_month, "count").collect()
    assert {r.method for r in long} == {"Z-score", "Contextual Isolation Forest"}
    assert len(long) == 2 * by_month.count()
    summary = R.method_summary(scored)
    assert [r.method for r in R.method_table(summary).collect()] == ["Z-score", "Contextual Isolation Forest"]
    overlap = R.overlap_table(summary).collect()
    assert [r.category for r in overlap] == list(R.OVERLAP_LABELS)


def test_line_ranking_filters_and_orders(detection001):
    by_line = R.method_by(detection001.scored, "line")
    top = R.line_ranking(by_line, min_obs=0, top_n=3).collect()
    assert len(top) == 3
    rates = [r.iforest_anomaly_rate for r in top]
    assert rates == sorted(rates)  # re-sorted ascending for display
    assert R.line_ranking(by_line, min_obs=10**9).count() == 0


def test_formatted_monthly(detection001):
    rows = R.formatted_monthly(R.method_by(detection001.scored, "month")).collect()
    assert all(r.zscore_anomaly_rate.endswith("%") for r in rows)


def test_drop_reasons_account_for_every_row(spark):
    from ctxanomaly.operators.records import cast_records
    from ctxanomaly.sources import raw_events

    from conftest import SF001

    raw = raw_events(spark, SF001)
    reasons = R.record_drop_reasons(cast_records(raw))
    assert reasons.agg(F.sum("row_count")).collect()[0][0] == raw.count()
