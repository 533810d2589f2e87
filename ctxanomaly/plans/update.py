"""Monthly update of a stored detection: new or corrected months replace their
partitions, and the context statistics follow from kept sums.

The store holds, by year and month, ``hourly/`` cells, ``context_state/``
(exact sums per month and context) and ``zscore/``.  An update reads the raw
records of its months only: their cells are aggregated and replaced, their
sums are replaced, and the statistics of all months are merged from the sums,
without reading other months' cells.  Every write replaces the partitions that
its rows fall into and leaves the files of all others alone, so an update that
is run again after a failure gives the same store.

z-scores are written for the updated months; those of other months stay as
they were until :func:`rescore`, which scores stored cells against the merged
statistics (of all months, or of some).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxanomaly.config import DetectConfig
from ctxanomaly.operators.context import context_state, state_moments
from ctxanomaly.operators.zscore import against
from ctxanomaly.plans.detect import hourly_cells
from ctxanomaly.session import cut, run_folder
from ctxanomaly.sources import read_stage
from ctxanomaly.sources.sinks import write_stage

MONTH = ("year", "month")


def update(raw: DataFrame, store: str, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    """Add or replace the months of ``raw``, which holds all records of each;
    returns their z-scored cells, as stored."""
    spark = raw.sparkSession
    with run_folder(spark):
        cells = cut(hourly_cells(raw).withColumn("year", F.year("datetime")), "month_cells")
        write_stage(cells, f"{store}/hourly", partition_by=MONTH, mode="replace")
        state = context_state(cells, cfg.context, cfg.measure, by=MONTH)
        write_stage(state, f"{store}/context_state", partition_by=MONTH, mode="replace")
        scored = against(cells, merged_moments(spark, store, cfg), cfg.context, cfg.measure, cfg.z_threshold)
        write_stage(scored, f"{store}/zscore", partition_by=MONTH, mode="replace")
        months = cells.select(*MONTH).distinct().collect()
    return in_months(read_stage(spark, f"{store}/zscore"), [tuple(m) for m in months])


def merged_moments(spark: SparkSession, store: str, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    """Context moments of all stored months, from their sums."""
    return state_moments(read_stage(spark, f"{store}/context_state"), cfg.context, cfg.measure)


def in_months(df: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of the given years and months (other partitions are not read)."""
    return df.filter(" or ".join(f"(year = {int(y)} and month = {int(m)})" for y, m in months) or "false")


def rescore(
    spark: SparkSession, store: str, months: Sequence[tuple[int, int]] | None = None, cfg: DetectConfig = DetectConfig()
) -> None:
    """Score stored cells (of the given years and months, or all) against the
    merged statistics and replace their z-scores."""
    cells = read_stage(spark, f"{store}/hourly")
    if months is not None:
        cells = in_months(cells, months)
    scored = against(cells, merged_moments(spark, store, cfg), cfg.context, cfg.measure, cfg.z_threshold)
    write_stage(scored, f"{store}/zscore", partition_by=MONTH, mode="replace")
