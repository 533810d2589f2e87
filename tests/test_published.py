"""Reconciliation with the published results: report schemas and the
arithmetic between published counts and rates (no raw data is published)."""

import pytest
from pyspark.sql import functions as F

from ctxanomaly.operators import reports as R

# Published report headers and overall figures.
SUMMARY_HEADER = (
    "total_rows,zscore_anomaly_count,iforest_anomaly_count,both_methods_anomaly_count,"
    "only_zscore_anomaly_count,only_iforest_anomaly_count,avg_iforest_score,max_iforest_score,"
    "min_iforest_score,zscore_anomaly_rate,iforest_anomaly_rate,method_overlap_rate,"
    "overlap_among_zscore_anomalies,overlap_among_iforest_anomalies"
)
MONTHLY_HEADER = (
    "month,total_obs,zscore_anomaly_count,iforest_anomaly_count,avg_iforest_score,"
    "zscore_anomaly_rate,iforest_anomaly_rate"
)
RATE_HEADER = "month,total_obs,anomaly_count,anomaly_rate"
SENSITIVITY_HEADER = "threshold,anomaly_count,anomaly_rate"
SUMMARY = dict(
    total_rows=6008418,
    zscore_anomaly_count=69143,
    iforest_anomaly_count=74542,
    both_methods_anomaly_count=38742,
    only_zscore_anomaly_count=30401,
    only_iforest_anomaly_count=35800,
    zscore_anomaly_rate=0.0115076880470033,
    iforest_anomaly_rate=0.0124062606829285,
    method_overlap_rate=0.0064479535212097,
    overlap_among_zscore_anomalies=0.5603170241383799,
    overlap_among_iforest_anomalies=0.5197338413243541,
)
SENSITIVITY = {2.0: (281601, 0.04662367017049368), 2.5: (140063, 0.023189729848579574), 3.0: (69143, 0.011447759157809967)}
Z_ROWS = 6039872


def test_report_schemas_match_published_headers(detection001):
    scored = detection001.scored
    assert ",".join(R.method_summary(scored).columns) == SUMMARY_HEADER
    assert ",".join(R.method_by(scored, "month").columns) == MONTHLY_HEADER
    assert ",".join(R.rate_by(detection001.zscored, "month").columns) == RATE_HEADER
    assert ",".join(R.threshold_sensitivity(detection001.zscored).columns) == SENSITIVITY_HEADER


def test_published_counts_reconcile():
    s = SUMMARY
    assert s["both_methods_anomaly_count"] + s["only_zscore_anomaly_count"] == s["zscore_anomaly_count"]
    assert s["both_methods_anomaly_count"] + s["only_iforest_anomaly_count"] == s["iforest_anomaly_count"]
    # every z flag survives the forest filters: |z| > 3 needs n >= 11 > 5
    assert SENSITIVITY[3.0][0] == s["zscore_anomaly_count"]


def test_rate_formulas_reproduce_published_rates(spark):
    counts = {k: v for k, v in SUMMARY.items() if k.endswith("count") or k == "total_rows"}
    row = spark.createDataFrame([counts])
    both = F.col("both_methods_anomaly_count")
    got = row.select(
        R.rate(F.col("zscore_anomaly_count"), F.col("total_rows")).alias("zscore_anomaly_rate"),
        R.rate(F.col("iforest_anomaly_count"), F.col("total_rows")).alias("iforest_anomaly_rate"),
        R.rate(both, F.col("total_rows")).alias("method_overlap_rate"),
        R.rate(both, F.col("zscore_anomaly_count")).alias("overlap_among_zscore_anomalies"),
        R.rate(both, F.col("iforest_anomaly_count")).alias("overlap_among_iforest_anomalies"),
    ).collect()[0]
    for k in got.asDict():
        assert got[k] == pytest.approx(SUMMARY[k], rel=1e-12)
    for t, (n, r) in SENSITIVITY.items():
        assert n / Z_ROWS == pytest.approx(r, rel=1e-12)
