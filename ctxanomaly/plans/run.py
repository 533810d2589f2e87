"""Batch job: raw records in, every stage table and report out.

    spark-submit -m ctxanomaly.plans.run --input 's3://bucket/raw/*.csv' --output s3://bucket/results

Writes, under ``--output``:

* ``hourly/``, ``zscore/`` and ``scored/`` (parquet by year and month, or CSV),
  each once, at its place;
* ``method_summary/``, ``method_by_month/``, ``method_by_line/``,
  ``rate_by_line/``, ``rate_by_month/``, ``threshold_sensitivity/``,
  ``top5_line_rate/``, ``top_anomaly_lines/``, ``overall_ratio/``,
  ``dataset_summary/``, ``hourly_average/``, ``top_zscore/``, ``top_iforest/``
  and ``drop_reasons/`` (one CSV each).

Reports of a table come from one scan of it (plus one for its top rows).  The
run's temporary cuts are removed at the end, also on failure.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxanomaly.config import DetectConfig
from ctxanomaly.operators import reports as R
from ctxanomaly.operators.context import attach_context, context_profile, ratio_features
from ctxanomaly.operators.features import forest_input, numeric_text
from ctxanomaly.operators.forest import top_by_score
from ctxanomaly.operators.hourly import ensure_temporal
from ctxanomaly.operators.records import anomalies, cast_records
from ctxanomaly.operators.zscore import top_by_abs
from ctxanomaly.plans.detect import Detection, _Clock, detect, detect_cells, detect_forest
from ctxanomaly.session import cut, remove_folder, run_folder
from ctxanomaly.sources import read_records, read_results, read_stage, write_report, write_stage

REPORT_ORDER = {
    "method_by_month": ("month",),
    "rate_by_month": ("month",),
    "rate_by_line": ("line",),
    "hourly_average": ("hour",),
    "threshold_sensitivity": ("threshold",),
    "drop_reasons": ("stage", "reason"),
}


def reports(d: Detection) -> dict[str, DataFrame]:
    """All report tables of a detection, keyed by output name."""
    out = R.scored_reports(cut(R.scored_cube(d.scored), "scored_cube"))
    out["top_iforest"] = top_by_score(d.scored)
    z = d.zscored
    flag = "is_anomaly" if "is_anomaly" in z.columns else "zscore_anomaly"
    if "z_score" in z.columns:
        out |= R.zscore_reports(cut(R.zscore_cube(ensure_temporal(z), flag), "zscore_cube"), len(z.columns))
        out["top_zscore"] = top_by_abs(anomalies(z, flag))
    return out


def drop_reasons(raw: DataFrame | None, d: Detection) -> DataFrame:
    """Why records and cells did not reach the forest, counted by stage: as
    observed while the stages were written, else by a scan."""
    if d.drops:
        spark = d.scored.sparkSession
        return reduce(DataFrame.unionByName, [R.observed_reasons(spark, stage, n) for stage, n in d.drops.items()])
    cells = numeric_text(ensure_temporal(d.zscored))
    profile = context_profile(ratio_features(forest_input(d.zscored)), d.cfg.context, d.cfg.measure)
    sized = attach_context(cells, profile.select(*d.cfg.context, "context_obs_count"), d.cfg.context)
    out = R.cell_drop_reasons(sized, d.cfg.min_context_obs).select(F.lit("cells").alias("stage"), "reason", "row_count")
    if raw is None:
        return out
    records = R.record_drop_reasons(cast_records(raw))
    return records.select(F.lit("records").alias("stage"), "reason", "row_count").unionByName(out)


def _order(name: str, df: DataFrame) -> list:
    if name == "method_by_line":
        return R.method_order("line")
    if name == "top5_line_rate":
        return [F.col("anomaly_rate").desc(), F.col("line")]
    if name == "top_anomaly_lines":
        return [F.col("anomaly_count").desc(), F.col("line")]
    keys = [F.col(k).asc_nulls_first() for k in ("datetime", "line", "line_name", "town") if k in df.columns]
    if name == "top_zscore":
        return [F.abs(F.col("z_score")).desc(), *keys]
    if name == "top_iforest":
        return [F.col("iforest_score").desc(), *keys]
    return list(REPORT_ORDER.get(name, ()))


def run(
    spark: SparkSession,
    input_path: str,
    output: str,
    cfg: DetectConfig = DetectConfig(),
    input_format: str = "csv",
    from_stage: str = "raw",
    stage_format: str = "parquet",
) -> dict[str, float]:
    """Detect over the table at ``input_path`` and write every output.

    ``from_stage``: "raw" records (default), "hourly" cells or "zscore"
    results written by an earlier run (or by another tool with the same
    columns).
    """
    timings: dict[str, float] = {}
    out = output.rstrip("/")

    def store(df: DataFrame, name: str) -> DataFrame:
        path = f"{out}/{name}"
        if stage_format == "csv":
            write_stage(df, path, fmt="csv")
            return read_stage(spark, path, fmt="csv", schema=df.schema)
        write_stage(df.withColumn("year", F.year("datetime")), path, partition_by=("year", "month"))
        return read_stage(spark, path).select(*df.columns)

    with run_folder(spark) as folder:
        try:
            raw = None
            if from_stage == "raw":
                csv = input_format == "csv"
                raw = read_records(spark, input_path, malformed=True) if csv else spark.read.format(input_format).load(input_path)
                d = detect(raw, cfg, timings=timings, store=store, count_drops=True)
            elif from_stage == "hourly":
                d = detect_cells(read_stage(spark, input_path, fmt=input_format), cfg, _Clock(timings), store=store, count_drops=True)
            elif from_stage == "zscore":
                d = detect_forest(read_results(spark, input_path, input_format), cfg, _Clock(timings), store=store, count_drops=True)
            else:
                raise ValueError(f"unknown stage {from_stage!r}")
            clock = _Clock(timings)
            for name, df in {**reports(d), "drop_reasons": drop_reasons(raw, d)}.items():
                write_report(df, f"{out}/{name}", order=_order(name, df))
            clock.lap("reports")
        finally:
            remove_folder(spark, folder)
    return timings


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True, help="raw records (glob for CSV)")
    ap.add_argument("--output", required=True, help="output folder")
    ap.add_argument("--format", default="csv", help="input format: csv (default) or parquet")
    ap.add_argument(
        "--from-stage",
        default="raw",
        choices=["raw", "hourly", "zscore"],
        help="what the input holds: raw records, hourly cells or z-score results",
    )
    ap.add_argument("--stage-format", default="parquet", choices=["parquet", "csv"], help="format of the stage tables")
    ap.add_argument("--threshold-mode", default="exact", choices=["exact", "approx", "sketch"])
    ap.add_argument("--z-threshold", type=float, default=3.0)
    ap.add_argument("--contamination", type=float, default=0.011448)
    ap.add_argument("--pool-size", type=int, default=None, help="rows the trees are drawn from (default: all)")
    args = ap.parse_args(argv)
    cfg = replace(
        DetectConfig(),
        threshold_mode=args.threshold_mode,
        z_threshold=args.z_threshold,
        contamination=args.contamination,
        pool_size=args.pool_size,
    )
    spark = SparkSession.builder.appName("ctxanomaly").getOrCreate()
    print(json.dumps(run(spark, args.input, args.output, cfg, args.format, args.from_stage, args.stage_format)))


if __name__ == "__main__":
    main()
