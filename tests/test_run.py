"""The batch job writes every stage and report."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ctxanomaly.plans.run import run
from ctxanomaly.session import checkpoint_root
from ctxanomaly.sources import raw_lineitem, write_stage

from conftest import SF001


def test_run_writes_all_outputs(spark):
    base = f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}"
    raw = raw_lineitem(spark, SF001)
    write_stage(raw, f"{base}/raw", fmt="parquet")
    run(spark, f"{base}/raw", f"{base}/out", input_format="parquet")
    names = set(os.listdir(f"{base}/out"))
    assert {"hourly", "zscore", "scored", "method_summary", "method_by_month", "threshold_sensitivity"} <= names
    years = [n for n in os.listdir(f"{base}/out/scored") if n.startswith("year=")]
    assert len(years) >= 6
    for year in years:
        for month in os.listdir(f"{base}/out/scored/{year}"):
            files = [f for f in os.listdir(f"{base}/out/scored/{year}/{month}") if f.endswith(".parquet")]
            assert len(files) == 1, "a folder gets few full files"
    assert {"top_zscore", "top_iforest", "dataset_summary", "hourly_average", "drop_reasons", "overall_ratio"} <= names
    top = spark.read.option("header", True).csv(f"{base}/out/top_iforest").collect()
    scores = [float(r["iforest_score"]) for r in top]
    assert len(top) == 20 and scores == sorted(scores, reverse=True)
    left = f"{checkpoint_root(spark)}/ctxanomaly"
    assert not [n for n in os.listdir(left) if n.startswith("run-") and "hourly" in os.listdir(f"{left}/{n}")]
    summary = spark.read.option("header", True).csv(f"{base}/out/method_summary").collect()
    assert len(summary) == 1


def test_csv_stages_give_the_same_results(spark, detection001):
    base = f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}"
    write_stage(raw_lineitem(spark, SF001).drop("town").withColumn("more", F.lit("x")), f"{base}/raw", fmt="csv")
    with pytest.raises(ValueError, match="town"):
        run(spark, f"{base}/raw", f"{base}/out", stage_format="csv")
    write_stage(raw_lineitem(spark, SF001).withColumn("more", F.lit("x")).select("more", "town", "line", *[
        "transition_hour", "transition_date", "line_name", "number_of_passage", "number_of_passenger"]), f"{base}/raw2", fmt="csv")
    run(spark, f"{base}/raw2", f"{base}/out", stage_format="csv")
    got = spark.read.option("header", True).csv(f"{base}/out/scored")
    assert got.filter("iforest_anomaly = 1").count() == detection001.scored.filter("iforest_anomaly = 1").count()
    drops = spark.read.option("header", True).csv(f"{base}/out/drop_reasons").collect()
    assert {r["stage"] for r in drops} == {"records", "cells"}


def test_reports_are_those_of_the_single_operators(detection001):
    from ctxanomaly.operators import reports as R
    from ctxanomaly.plans.run import reports

    got, z, s = reports(detection001), detection001.zscored, detection001.scored
    want = {
        "method_summary": R.method_summary(s), "method_by_month": R.method_by(s, "month"),
        "method_by_line": R.method_by(s, "line"), "rate_by_line": R.rate_by(z, "line"),
        "rate_by_month": R.rate_by(z, "month"), "threshold_sensitivity": R.threshold_sensitivity(z),
        "top5_line_rate": R.top_rate(z, "line", 5), "top_anomaly_lines": R.anomaly_count_by(z, "line"),
        "overall_ratio": R.overall_ratio(z), "dataset_summary": R.dataset_summary(z),
    }
    key = lambda df: sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns))) for r in df.collect()), key=repr
    )
    for name, df in want.items():
        assert sorted(got[name].columns) == sorted(df.columns), name
        assert key(got[name]) == key(df), name


def test_empty_input_is_an_explicit_error(spark):
    from ctxanomaly.plans.detect import detect

    empty = raw_lineitem(spark, SF001).limit(0)
    with pytest.raises(ValueError):
        detect(empty)


def test_forest_job_from_a_written_zscore_table(spark, detection001):
    """The forest stage can start from a z-score table written as CSV text."""
    from ctxanomaly.plans.detect import detect_forest
    from ctxanomaly.sources import read_stage

    path = f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}/zscore_csv"
    zs = detection001.zscored.drop("month", "is_weekend")  # derived again from datetime
    write_stage(zs, path, fmt="csv")
    back = read_stage(spark, path, fmt="csv", schema=zs.schema)
    d = detect_forest(back)
    cols = ["datetime", "line", "line_name", "town", "iforest_anomaly", "zscore_anomaly"]
    assert {tuple(r) for r in d.scored.select(*cols).collect()} == {
        tuple(r) for r in detection001.scored.select(*cols).collect()
    }


def test_run_from_zscore_stage(spark, detection001):
    base = f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}"
    write_stage(detection001.zscored, f"{base}/zscore_in")
    run(spark, f"{base}/zscore_in", f"{base}/out", input_format="parquet", from_stage="zscore")
    names = set(os.listdir(f"{base}/out"))
    assert "scored" in names and "hourly" not in names and "method_by_line" in names


def test_cleanup_removes_the_run_folder(spark):
    from ctxanomaly.plans.detect import detect

    d = detect(raw_lineitem(spark, SF001))
    assert d.run_dir is not None and os.path.isdir(d.run_dir)
    cuts = set(n.split("-")[0] for n in os.listdir(d.run_dir))
    assert {"hourly", "context_stats", "zscore", "featured", "drawn", "scored"} <= cuts
    assert d.cleanup()
    assert not os.path.exists(d.run_dir)
