"""Sources and sinks: round trips and errors."""

import os
import uuid

import pytest
from pyspark.sql import types as T

from ctxanomaly.schema import RAW_TEXT
from ctxanomaly.session import checkpoint_root
from ctxanomaly.sources import (
    coerce_datetime,
    merge_parts,
    profile,
    raw_events,
    read_records,
    read_results,
    read_stage,
    write_report,
    write_stage,
)

from conftest import SF001


def read_stage_schema():
    return T.StructType(
        [T.StructField("line", T.StringType()), T.StructField("x", T.IntegerType()), T.StructField("town", T.StringType())]
    )


def fresh(spark, name):
    return f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}/{name}"


def test_csv_records_round_trip(spark):
    raw = raw_events(spark, SF001)
    path = fresh(spark, "raw")
    write_stage(raw, path, fmt="csv")
    back = read_records(spark, path)
    assert back.schema == RAW_TEXT
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, raw.collect()), key=str)


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)


HEADER = "transition_date,transition_hour,line,line_name,town,number_of_passenger,number_of_passage"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    _write(tmp_path, "a.csv", "town,number_of_passage,extra,line,transition_hour,number_of_passenger,line_name,transition_date\nT,2,x,L,5,9,N,2024-01-08\n")
    got = read_records(spark, str(tmp_path))
    assert got.schema == RAW_TEXT
    assert tuple(got.first()) == ("2024-01-08", "5", "L", "N", "T", "9", "2")
    assert len(read_records(spark, str(tmp_path), by_file=True).collect()) == 1


def test_missing_column_is_named(spark, tmp_path):
    _write(tmp_path, "a.csv", "line,transition_date,transition_hour,x\nL,2024-01-08,5,1\n")
    with pytest.raises(ValueError, match="number_of_passenger"):
        read_records(spark, str(tmp_path))
    with pytest.raises(ValueError, match="a.csv"):
        read_records(spark, str(tmp_path), by_file=True)


def test_files_with_other_headers(spark, tmp_path):
    _write(tmp_path, "a b%.csv", HEADER + "\n2024-01-08,5,L,N,T,9,2\n")
    _write(tmp_path, "b.csv", ",".join(HEADER.split(",")[::-1]) + "\n4,8,T2,N2,L2,6,2024-01-09\n")
    with pytest.raises(Exception, match="(?s)header.*b.csv|b.csv.*header|CSV header"):
        read_records(spark, str(tmp_path)).collect()
    got = {tuple(r) for r in read_records(spark, str(tmp_path), by_file=True).collect()}
    assert got == {("2024-01-08", "5", "L", "N", "T", "9", "2"), ("2024-01-09", "6", "L2", "N2", "T2", "8", "4")}


def test_merge_by_name_with_missing_columns(spark, tmp_path):
    _write(tmp_path, "a.csv", "line,x,town\nL,1,T\n")
    _write(tmp_path, "b.csv", "town,line,more\nT2,L2,z\n")
    got = merge_parts(spark, str(tmp_path), schema=read_stage_schema())
    assert {tuple(r) for r in got.collect()} == {("L", 1, "T"), ("L2", None, "T2")}
    free = merge_parts(spark, str(tmp_path))
    assert set(free.columns) == {"line", "x", "town", "more"}
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(f"{tmp_path}/p/1")
    spark.createDataFrame([("b",)], "y string").write.mode("append").parquet(f"{tmp_path}/p/1")
    assert {tuple(r) for r in merge_parts(spark, f"{tmp_path}/p/1", fmt="parquet").select("x", "y").collect()} == {(1, "a"), (None, "b")}


def test_merge_of_an_empty_directory(spark, tmp_path):
    os.makedirs(f"{tmp_path}/none")
    with pytest.raises(FileNotFoundError):
        merge_parts(spark, f"{tmp_path}/none")


def test_results_are_coerced(spark, tmp_path):
    _write(tmp_path, "z.csv", "z_score,line,datetime,is_anomaly,hour\n3.5,L,2024-01-08 05:00:00,True,5.0\nn/a,L,soon,1.0,x\n,L,,false,\n")
    rows = sorted(read_results(spark, str(tmp_path)).collect(), key=lambda r: -(r["z_score"] or 0))
    assert [r["zscore_anomaly"] for r in rows] == [1, 1, 0] and rows[0]["hour"] == 5
    assert rows[0]["z_score"] == 3.5 and rows[0]["datetime"].hour == 5
    assert rows[1]["z_score"] is None and rows[1]["datetime"] is None and rows[1]["hour"] is None


def test_stage_partitioned_by_month_prunes(spark, detection001):
    path = fresh(spark, "hourly")
    write_stage(detection001.hourly, path, partition_by=("month",))
    back = read_stage(spark, path)
    assert back.count() == detection001.hourly.count()
    files = [f for m in os.listdir(path) if m.startswith("month=") for f in os.listdir(f"{path}/{m}") if f.endswith(".parquet")]
    assert len(files) == 12
    plan = back.filter("month = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_report_is_one_file(spark, detection001):
    from ctxanomaly.operators.reports import method_by

    path = fresh(spark, "report")
    report = method_by(detection001.scored, "month")
    write_report(report, path)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1
    assert read_stage(spark, path, fmt="csv", schema=report.schema).count() == report.count()


def test_merge_parts_errors_on_missing_directory(spark):
    with pytest.raises(Exception):
        merge_parts(spark, fresh(spark, "missing"), fmt="csv")


def test_coerce_datetime_bad_values_become_null(spark):
    df = spark.createDataFrame([("2024-01-07 05:00:00",), ("garbage",), (None,)], "datetime string")
    got = [r.datetime for r in coerce_datetime(df).collect()]
    assert got[0].hour == 5 and got[1] is None and got[2] is None


def test_profile_counts_non_null(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    r = profile(df).collect()[0]
    assert (r.row_count, r.non_null_a, r.non_null_b) == (2, 2, 1)
