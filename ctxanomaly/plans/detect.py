"""End-to-end detection: records -> hourly -> z-score -> features -> forest.

Stage outputs are written once and read back (as cuts under the checkpoint
folder, or where ``store`` puts them), so every later job, including all
reports, reads materialised columns and the scoring UDF runs once per run.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ctxanomaly.config import FEATURES, SCALED_FEATURES, DetectConfig
from ctxanomaly.operators import reports as R
from ctxanomaly.operators.features import (
    PROFILE_COLUMNS,
    deviations,
    fit_scaler,
    forest_input,
    labelled_cells,
    second_filter,
    standardize,
    with_profile,
)
from ctxanomaly.operators.forest import (
    contamination_threshold,
    fit,
    flag_ge,
    score_expr,
    score_forest,
    with_pool_hash,
    with_row_key,
)
from ctxanomaly.operators.hourly import hourly_aggregate, with_temporal
from ctxanomaly.operators.records import MALFORMED, cast_records, select_present, valid_records, with_datetime
from ctxanomaly.operators.zscore import zscore
from ctxanomaly.session import cut, cut_bucketed, cut_observed, remove_folder, run_folder
from ctxanomaly.sources.records import profile_metrics

# Fixed output names of the scored table.
OUTPUT_COLUMNS = (
    "datetime",
    "line",
    "line_name",
    "town",
    "total_passengers",
    "total_passages",
    "record_count",
    "hour",
    "month",
    "spark_dayofweek",
    "is_weekend",
    "zscore_anomaly",
    "context_obs_count",
    "loo_mean_passengers",
    "loo_std_passengers",
    *FEATURES,
)
#: Columns of the cuts: the features are :func:`deviations` of them, a
#: projection wherever they are read.
FEATURED = (*dict.fromkeys([c for c in OUTPUT_COLUMNS if c not in FEATURES] + [*PROFILE_COLUMNS]),)


@dataclass
class Detection:
    cfg: DetectConfig
    hourly: DataFrame | None
    zscored: DataFrame
    featured: DataFrame
    nodes: pd.DataFrame
    scored: DataFrame
    threshold: tuple[float, int | None]
    run_dir: str | None = None
    #: Rows by drop reason of the stages ``records`` and ``cells``, and the
    #: raw records' row count and non-null counts, where they were asked for.
    drops: dict[str, dict[str, int]] = field(default_factory=dict)
    profile: dict[str, int] = field(default_factory=dict)

    def cleanup(self) -> bool:
        """Delete this run's stage cuts.  The DataFrames above read those
        files: use them (or write what you keep) before cleaning up."""
        if self.run_dir is None:
            return False
        return remove_folder(self.scored.sparkSession, self.run_dir)


def clean_records(raw: DataFrame) -> DataFrame:
    """Typed, valid records with their hourly timestamp."""
    return with_datetime(valid_records(cast_records(raw)))


def hourly_cells(raw: DataFrame) -> DataFrame:
    """Hourly aggregate of the valid records plus calendar columns."""
    return with_temporal(hourly_aggregate(clean_records(raw)))


def featured_cells(
    zscored: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    is_cut: bool = False,
    seen: Observation | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Second filter, context features, row key and pool hash (unscaled)."""
    return with_row_key(deviations(profiled_cells(zscored, cfg, is_cut, seen, shuffled), cfg.measure), cfg.hourly_keys)


def profiled_cells(
    zscored: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    is_cut: bool = False,
    seen: Observation | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """The cells behind the second filter with their context's profile and
    their pool hash.  ``seen`` receives the cells by the second filter's rules
    ('kept': they pass it) while the result is written."""
    if not is_cut:
        zscored = cut(zscored, "cells")
    fact = None
    if seen is not None:
        cells = labelled_cells(zscored)
        reasons = R.counted(R.cell_reason(cfg.min_context_obs, F.lit(cfg.min_context_obs)), R.CELL_REASONS)
        fact = second_filter(cells.observe(seen, *[c.alias(k) for k, c in reasons.items()]))
    rows = with_profile(forest_input(zscored), cfg.context, cfg.measure, cfg.min_context_obs, True, fact, shuffled)
    return with_pool_hash(with_row_key(rows, cfg.hourly_keys), cfg).drop("row_key")


Store = Callable[[DataFrame, str], DataFrame]


class _Clock:
    def __init__(self, sink: dict[str, float] | None):
        self.sink = sink
        self.t = time.perf_counter()

    def lap(self, name: str) -> None:
        now = time.perf_counter()
        if self.sink is not None:
            self.sink[name] = round(now - self.t, 3)
        self.t = now


def detect(
    raw: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    timings: dict[str, float] | None = None,
    score_counter=None,
    store: Store = cut,
    count_drops: bool = False,
) -> Detection:
    """Run both methods over raw records and return every stage.

    ``timings``, when given, receives wall seconds per stage;
    ``score_counter`` (an accumulator) the number of rows the scorer saw;
    ``store(df, name)`` writes the stages ``hourly``, ``zscore`` and
    ``scored`` and reads them back (see also :func:`bucketed_store`);
    ``count_drops`` has the drop reasons and the records' profile observed by
    the jobs that write the stages.
    """
    clock = _Clock(timings)
    with run_folder(raw.sparkSession) as folder:
        drops, columns = {}, {}
        if count_drops:
            hourly, drops["records"], columns = hourly_observed(raw, store)
        else:
            hourly = store(hourly_cells(raw), "hourly")
        clock.lap("hourly")
        d = detect_cells(hourly, cfg, clock, score_counter, store, is_cut=True, count_drops=count_drops)
    d.run_dir = folder
    d.drops, d.profile = drops | d.drops, columns
    return d


def hourly_observed(raw: DataFrame, store: Store) -> tuple[DataFrame, dict[str, int], dict[str, int]]:
    """The hourly stage, the raw records by drop reason, and their profile,
    from one scan of the raw records.

    The records are counted before a shuffle, where Spark adds up a task that
    it runs again after an executor is lost.  The kept records are therefore
    compared with those in the cells, which the last stage counts exactly; a
    difference has the reasons counted by a scan."""
    typed, before, after = cast_records(raw), Observation(), Observation()
    metrics = R.counted(R.record_reason(typed.columns), R.RECORD_REASONS) | profile_metrics(typed, raw_columns(typed))
    seen = typed.observe(before, *[c.alias(k) for k, c in metrics.items()])
    cells = with_temporal(hourly_aggregate(with_datetime(valid_records(seen))))
    hourly = store(cells.observe(after, F.sum("record_count").alias("records")), "hourly")
    counts = before.get
    if counts["kept"] != (after.get["records"] or 0):
        counts = typed.agg(*[c.alias(k) for k, c in metrics.items()]).first().asDict()
    reasons = {k: counts.pop(k) for k in R.RECORD_REASONS}
    return hourly, reasons, counts


def raw_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != MALFORMED]


def bucketed_store(cfg: DetectConfig, buckets: int) -> Store:
    """A store that keeps the stages ``hourly`` and ``zscore`` in buckets of
    the context key: one shuffle when a stage is written, and none when its
    context statistics are added up and joined back, however large they are.
    """

    def store(df: DataFrame, name: str) -> DataFrame:
        return cut_bucketed(df, name, cfg.context, buckets) if name in ("hourly", "zscore") else cut(df, name)

    store.shuffled = True
    return store


def detect_cells(
    hourly: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    clock: _Clock | None = None,
    score_counter=None,
    store: Store = cut,
    is_cut: bool = False,
    count_drops: bool = False,
) -> Detection:
    """Both methods starting from hourly cells (e.g. a stage written earlier)."""
    clock = clock or _Clock(None)
    shuffled = getattr(store, "shuffled", False)
    with run_folder(hourly.sparkSession) as folder:
        zscored = store(zscore(hourly, cfg.context, cfg.measure, cfg.z_threshold, is_cut, shuffled), "zscore")
        clock.lap("zscore")
        d = detect_forest(zscored, cfg, clock, score_counter, store, is_cut=True, count_drops=count_drops)
    d.hourly = hourly
    d.run_dir = folder
    return d


def detect_forest(
    zscored: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    clock: _Clock | None = None,
    score_counter=None,
    store: Store = cut,
    is_cut: bool = False,
    count_drops: bool = False,
) -> Detection:
    """The forest and the flags, starting from z-scored cells.

    The z-score label may be boolean, 0/1 or text, and missing temporal
    columns are derived from ``datetime`` (see ``forest_input``).
    """
    clock = clock or _Clock(None)
    shuffled = getattr(store, "shuffled", False)
    with run_folder(zscored.sparkSession) as folder:
        if not is_cut:
            zscored = cut(zscored, "cells")
        # Totals and profiles are written once; features and scaling are cheap
        # projections applied where they are read (pool, scoring, results).
        cells, total, drops = profiled_stage(zscored, cfg, count_drops, shuffled)
        feats = with_row_key(deviations(cells, cfg.measure), cfg.hourly_keys)
        scaled = standardize(feats, FEATURES, fit_scaler(feats, FEATURES))
        featured = select_present(scaled, [*OUTPUT_COLUMNS, "row_key", "h_pool", *SCALED_FEATURES])
        clock.lap("features")
        nodes = fit(featured, cfg, total=total)
        clock.lap("fit")
        scored = select_present(score_forest(scaled, nodes, cfg, counter=score_counter), [*FEATURED, "iforest_path_units"])
        scored = deviations(cut(scored, "scored"), cfg.measure).withColumn("iforest_score", score_expr("iforest_path_units", cfg))
        scored = select_present(scored, [*OUTPUT_COLUMNS, "iforest_path_units", "iforest_score"])
        clock.lap("score")
        threshold = contamination_threshold(scored, cfg, total)
        flagged = flag_ge(scored, threshold)
        if store is not cut:
            flagged = store(flagged, "scored")
        clock.lap("threshold")
    return Detection(cfg, None, zscored, featured, nodes, flagged, threshold, folder, {"cells": drops} if drops else {})


def featured_stage(
    zscored: DataFrame, cfg: DetectConfig = DetectConfig(), count_drops: bool = False, shuffled: bool = False
) -> tuple[DataFrame, int, dict[str, int]]:
    """The featured cells of a cut of z-scored ones, their number, and
    (``count_drops``) the cells by drop reason."""
    cells, total, drops = profiled_stage(zscored, cfg, count_drops, shuffled)
    feats = with_row_key(deviations(cells, cfg.measure), cfg.hourly_keys)
    return select_present(feats, [*OUTPUT_COLUMNS, "row_key", "h_pool"]), total, drops


def profiled_stage(
    zscored: DataFrame, cfg: DetectConfig = DetectConfig(), count_drops: bool = False, shuffled: bool = False
) -> tuple[DataFrame, int, dict[str, int]]:
    """:func:`featured_stage` before its features: the totals and the profile
    of each cell, written once."""
    seen = Observation() if count_drops else None
    rows = select_present(profiled_cells(zscored, cfg, True, seen, shuffled), [*FEATURED, "h_pool"])
    cells, counts = cut_observed(rows, "featured", total=F.count(F.lit(1)))
    return cells, counts["total"], _cell_drops(zscored, seen.get, counts["total"], cfg) if seen else {}


def _cell_drops(zscored: DataFrame, counts: dict[str, int], kept: int, cfg: DetectConfig) -> dict[str, int]:
    """Cells by drop reason: those that pass the second filter and are not
    among the featured rows are of small contexts.  Where a shuffle join put
    the observed stage before the last one, the cells counted are compared
    with the table's rows (its files know them), and counted again if they
    differ."""
    if sum(counts.values()) != zscored.count():
        reason = R.cell_reason(cfg.min_context_obs, F.lit(cfg.min_context_obs))
        counts = labelled_cells(zscored).agg(*[c.alias(k) for k, c in R.counted(reason, R.CELL_REASONS).items()]).first().asDict()
    return counts | {"kept": kept, "small_context": counts["kept"] - kept}
