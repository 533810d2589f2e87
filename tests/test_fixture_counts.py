"""Counts of the fixture mappings as measured in FIXTURES.md section 3."""

from pyspark.sql import functions as F

from ctxanomaly.operators import reports as R
from ctxanomaly.operators.context import context_moments
from ctxanomaly.operators.records import cast_records, valid_records
from ctxanomaly.operators.zscore import zscore
from ctxanomaly.plans.detect import hourly_cells
from ctxanomaly.sources import raw_events, raw_lineitem

from conftest import SF001


def test_events_sf0001_counts(spark):
    raw = raw_events(spark, SF001)
    assert raw.count() == 1000
    assert valid_records(cast_records(raw)).count() == 948
    cells = hourly_cells(raw)
    assert cells.count() == 937
    assert cells.filter(F.col("total_passages").isNull()).count() == 12
    assert cells.filter(F.col("line").isNull()).count() == 9


def test_lineitem_sf0001_counts(spark):
    cells = hourly_cells(raw_lineitem(spark, SF001))
    assert cells.count() == 5991
    assert context_moments(cells).count() == 1006
    sizes = cells.groupBy("line", "hour", "spark_dayofweek").agg(F.count(F.lit(1)).alias("n"))
    in_big = cells.join(sizes.filter("n >= 5"), ["line", "hour", "spark_dayofweek"]).count()
    assert in_big == 5030
    sens = {r.threshold: r.anomaly_count for r in R.threshold_sensitivity(zscore(cells)).collect()}
    assert sens == {2.0: 34, 2.5: 0, 3.0: 0}


SF01 = "/root/testdata/sf0.01"


def test_events_sf001_counts(spark):
    raw = raw_events(spark, SF01)
    assert raw.count() == 10000
    assert valid_records(cast_records(raw)).count() == 9482
    cells = hourly_cells(raw)
    assert cells.count() == 8937
    assert cells.filter(F.col("total_passages").isNull()).count() == 108
    assert cells.filter(F.col("line").isNull()).count() == 96
    sizes = cells.groupBy("line", "hour", "spark_dayofweek").agg(F.count(F.lit(1)).alias("n"))
    assert cells.join(sizes.filter("n >= 5"), ["line", "hour", "spark_dayofweek"]).count() == 8773
    assert zscore(cells).filter("is_anomaly").count() == 25


def test_lineitem_sf001_counts(spark):
    cells = hourly_cells(raw_lineitem(spark, SF01))
    assert cells.count() == 59752
    assert context_moments(cells).count() == 1008
    sens = {r.threshold: r.anomaly_count for r in R.threshold_sensitivity(zscore(cells)).collect()}
    assert sens == {2.0: 197, 2.5: 78, 3.0: 44}
