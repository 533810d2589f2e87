"""Raw-record operators: casts, validity, datetime, simple slices and fills."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxanomaly.functions.expressions import finite_nonneg

#: Column that holds the text of a line that is no record of its file.
MALFORMED = "_malformed"


def cast_records(df: DataFrame) -> DataFrame:
    """Type the raw columns; unparsable text becomes null (ANSI-safe ``try_cast``).

    Hours may be written as numbers of any form (``8``, ``8.0``); one that is
    not whole becomes null.
    """
    hour = F.col("transition_hour").try_cast("double")
    return df.withColumns(
        {
            "transition_date": F.col("transition_date").try_cast("date"),
            "transition_hour": F.when(F.rint(hour) == hour, hour.try_cast("int")),
            "number_of_passenger": F.col("number_of_passenger").try_cast("double"),
            "number_of_passage": F.col("number_of_passage").try_cast("double"),
        }
    )


def valid_records(df: DataFrame) -> DataFrame:
    """Keep rows with a date, an hour in 0..23 and a finite passenger count >= 0.

    ``number_of_passage`` may be null or negative here.  NaN and infinity are
    rejected (a NaN would otherwise poison the statistics of its context), as
    are lines marked as malformed.
    """
    hour = F.col("transition_hour")
    whole = df.filter(F.col(MALFORMED).isNull()).drop(MALFORMED) if MALFORMED in df.columns else df
    return whole.filter(
        F.col("transition_date").isNotNull()
        & hour.isNotNull()
        & hour.between(0, 23)
        & finite_nonneg(F.col("number_of_passenger"))
    )


def with_datetime(df: DataFrame) -> DataFrame:
    """Hourly timestamp from date + hour, without string round trips."""
    return df.withColumn(
        "datetime",
        F.col("transition_date").cast("timestamp_ntz")
        + F.make_dt_interval(F.lit(0), F.col("transition_hour")),
    )


def line_slice(df: DataFrame, value: str, column: str = "line") -> DataFrame:
    """Rows of one entity."""
    return df.filter(F.col(column) == F.lit(value))


def anomalies(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """Rows whose flag is set (boolean or 0/1)."""
    c = F.col(flag)
    return df.filter(c == F.lit(1) if dict(df.dtypes)[flag] != "boolean" else c)


def at_least(df: DataFrame, n: int, column: str = "total_obs") -> DataFrame:
    """Report rows backed by at least ``n`` observations."""
    return df.filter(F.col(column) >= F.lit(n))


def fill_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Replace null and NaN by 0 in the given numeric columns."""
    return df.fillna(0.0, subset=list(cols))


def select_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Project the listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select(*[c for c in cols if c in present])
