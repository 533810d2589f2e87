"""Mappings of the TPC-H-like test tables onto the raw record schema.

``raw_events`` (F1) yields dirty text records: bad dates, hours out of range,
null lines, unparsable and negative counts.  ``raw_lineitem`` (F2) yields
typed records over twelve months and six lines.  Both read whole tables.
``raw_prices`` (F3) has fractional measures and coarse keys: tens of records
per cell.  Joins carry no broadcast hint; Spark sizes the sides at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """text records from ``events`` with injected dirt."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    eid = F.col("event_id")
    rows = ev.join(cust, F.col("c_custkey") == F.col("user_id")).join(
        nation, F.col("n_nationkey") == F.col("c_nationkey")
    )
    return rows.select(
        F.when(eid % 103 == 0, F.lit("not-a-date"))
        .otherwise(F.col("ts").cast("date").cast("string"))
        .alias("transition_date"),
        F.when(eid % 97 == 0, F.lit("24"))
        .when(eid % 89 == 0, F.lit(None).cast("string"))
        .otherwise(F.hour("ts").cast("string"))
        .alias("transition_hour"),
        F.when(eid % 101 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("line"),
        F.upper("event_type").alias("line_name"),
        F.col("n_name").alias("town"),
        F.when(eid % 83 == 0, F.lit("n/a"))
        .when(eid % 107 == 0, F.lit("-1"))
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
        .alias("number_of_passenger"),
        F.when(eid % 79 == 0, F.lit(None).cast("string"))
        .otherwise(F.regexp_extract("props", "([0-9]+)", 1))
        .alias("number_of_passage"),
    )


def raw_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """typed records from ``lineitem`` (synthetic hour = orderkey mod 24)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = li.join(supp, F.col("s_suppkey") == F.col("l_suppkey")).join(
        nation, F.col("n_nationkey") == F.col("s_nationkey")
    )
    return rows.select(
        F.col("l_shipdate").cast("date").alias("transition_date"),
        (F.col("l_orderkey") % 24).cast("int").alias("transition_hour"),
        F.concat("l_returnflag", "l_linestatus").alias("line"),
        F.concat(F.lit("LINE "), "l_returnflag", "l_linestatus").alias("line_name"),
        F.col("n_name").alias("town"),
        F.col("l_quantity").alias("number_of_passenger"),
        F.col("l_linenumber").cast("double").alias("number_of_passage"),
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """prices by week and half of the day.

    Dates are moved back to their Monday and hours to 0 or 12, so a cell
    gathers many records; passages are a product of two fractions.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_discount", "l_quantity", "l_returnflag", "l_shipdate"
    )
    return li.select(
        F.date_trunc("week", F.col("l_shipdate").cast("timestamp_ntz")).cast("date").alias("transition_date"),
        ((F.col("l_orderkey") % 2) * 12).cast("int").alias("transition_hour"),
        F.col("l_returnflag").alias("line"),
        F.concat(F.lit("LINE "), "l_returnflag").alias("line_name"),
        F.lit("ALL").alias("town"),
        F.col("l_extendedprice").alias("number_of_passenger"),
        (F.col("l_quantity") * (F.lit(1.0) - F.col("l_discount"))).alias("number_of_passage"),
    )
