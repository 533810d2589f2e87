"""

Fixture mappings (see FIXTURES.md): F1 ``raw_events`` gives dirty text
records (casts, validity, null keys); F2 ``raw_lineitem`` gives typed
records over twelve months (z-score, features, forest, reports); F3
``raw_prices`` has fractional measures and many records per cell.  Every
query reads whole tables.  Doubles are rounded to 6 decimals in both the
Spark result and the SQL oracle.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ctxanomaly.config import PUBLISHED_POOL, SCALED_FEATURES, DetectConfig  # noqa: E402
from ctxanomaly.functions.expressions import c_factor  # noqa: E402
from ctxanomaly.operators import reports as R  # noqa: E402
from ctxanomaly.operators.context import (  # noqa: E402
    attach_context,
    context_moments,
    context_profile,
    context_state,
    leave_one_out,
    min_context,
    ratio_features,
    state_moments,
)
from ctxanomaly.operators.features import (  # noqa: E402
    complete_rows,
    context_features,
    feature_moments,
    forest_input,
    in_range_rows,
    normalize_label,
    standardize,
)
from ctxanomaly.operators.forest import (  # noqa: E402
    SKETCH_RANK_ERROR,
    bernoulli_pool,
    bernoulli_sample,
    contamination_threshold,
    fit_forest,
    flag_ge,
    score_of_units,
    score_sketches,
    sketch_threshold,
    threshold_rank,
    top_by_score,
    training_pool,
    tree_samples,
)
from ctxanomaly.operators.hourly import ensure_temporal, hourly_aggregate  # noqa: E402
from ctxanomaly.operators.records import (  # noqa: E402
    anomalies,
    cast_records,
    valid_records,
    with_datetime,
)
from ctxanomaly.operators.zscore import top_by_abs, zscore  # noqa: E402
from ctxanomaly.plans.detect import (  # noqa: E402
    OUTPUT_COLUMNS,
    Detection,
    detect,
    detect_forest,
    featured_stage,
    hourly_cells,
    hourly_observed,
)
from ctxanomaly.plans.run import drop_reasons as cell_report  # noqa: E402
from ctxanomaly.plans.update import rescore, update  # noqa: E402
from checks.oracles import sql_queries  # noqa: E402
from ctxanomaly.session import checkpoint_root, cut, cut_bucketed  # noqa: E402
from ctxanomaly.sources import (  # noqa: E402
    coerce_datetime,
    merge_parts,
    profile,
    raw_events,
    raw_lineitem,
    raw_prices,
    read_records,
    read_results,
)
from ctxanomaly.sources.sinks import write_stage  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from ctxanomaly.llm import queries as corpus_queries  # noqa: E402
except ModuleNotFoundError as missing:  # the subpackage may be absent; other errors are errors
    if missing.name is None or not missing.name.startswith(("corpus_pipeline", "ctxanomaly.llm")):
        raise
    corpus_pipeline = corpus_queries = None

FLAGSHIP_SF = "/root/testdata/sf0.001"
CFG = DetectConfig()
KEYS = ["datetime", "line", "line_name", "town"]
CELL = [*KEYS, "total_passengers", "total_passages", "record_count"]
TEMPORAL = ["hour", "month", "spark_dayofweek", "is_weekend"]
RAW = ["transition_date", "transition_hour", "line", "line_name", "town", "number_of_passenger", "number_of_passage"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (the oracle rounds the same columns)."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    if not doubles:
        return df
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in doubles})


_DETECTIONS: dict[tuple[str, str, str], Detection] = {}


def detection(spark: SparkSession, sf_dir: str, mapping: str = "lineitem") -> Detection:
    """Detection over F2 (or another mapping), kept for the session and table
    folder: the forest reports all read the same written cut (one scoring
    pass)."""
    key = (spark.sparkContext.applicationId, sf_dir, mapping)
    if key not in _DETECTIONS:
        raw = {"lineitem": raw_lineitem, "events": raw_events, "prices": raw_prices}[mapping]
        _DETECTIONS[key] = detect(raw(spark, sf_dir), CFG)
    return _DETECTIONS[key]


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/ctxanomaly/{uuid.uuid4().hex}/{name}"


# --- F1 helpers ----------------------------------------------------------------


def _ev_cells(spark, sf):
    return hourly_cells(raw_events(spark, sf))


def _ev_zscored(spark, sf):
    return zscore(_ev_cells(spark, sf), CFG.context, CFG.measure, CFG.z_threshold)


def _lz(spark, sf):
    return zscore(hourly_cells(raw_lineitem(spark, sf)), CFG.context, CFG.measure, CFG.z_threshold)


def _l_ratios(spark, sf):
    return cut(ratio_features(forest_input(_lz(spark, sf))), "ratios")


# --- queries --------------------------------------------------------------------


def q_scan_records(spark, sf):
    path = scratch(spark, "raw_csv")
    write_stage(raw_events(spark, sf), path, fmt="csv")
    return read_records(spark, path).select(*RAW)


def q_scan_records_permuted(spark, sf):
    path = scratch(spark, "permuted_csv")
    write_stage(raw_events(spark, sf).select("town", F.lit("x").alias("more"), *RAW[::-1][:2], *RAW[:4]), path, fmt="csv")
    return read_records(spark, path).select(*RAW)


def q_cast_records_decimal_hours(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts")
    part = F.when(F.col("event_id") % 3 == 1, ".5").when(F.col("event_id") % 3 == 2, ".0").otherwise("")
    hour = F.when(F.col("event_id") % 89 != 0, F.concat(F.hour("ts").cast("string"), part))
    null = F.lit(None).cast("string")
    raw = ev.select("event_id", hour.alias("transition_hour"), *[null.alias(c) for c in RAW if c != "transition_hour"])
    return cast_records(raw).select("event_id", "transition_hour")


def q_cast_records(spark, sf):
    return cast_records(raw_events(spark, sf)).select(*RAW)


def q_valid_records(spark, sf):
    return valid_records(cast_records(raw_events(spark, sf))).select(*RAW)


def q_build_datetime(spark, sf):
    return with_datetime(valid_records(cast_records(raw_events(spark, sf)))).select(*RAW, "datetime")


def q_coerce_datetime(spark, sf):
    raw = raw_events(spark, sf).select(F.col("transition_date").alias("datetime"), "line")
    return coerce_datetime(raw)


def q_profile_records(spark, sf):
    return profile(cast_records(raw_events(spark, sf)).select(*RAW))


def q_hourly_aggregate(spark, sf):
    return hourly_aggregate(with_datetime(valid_records(cast_records(raw_events(spark, sf))))).select(*CELL)


def q_temporal_features(spark, sf):
    return _ev_cells(spark, sf).select(*CELL, *TEMPORAL)


def q_ensure_temporal(spark, sf):
    partial = _ev_cells(spark, sf).drop("month", "is_weekend")
    return ensure_temporal(partial).select(*CELL, *TEMPORAL)


def q_merge_parts(spark, sf):
    cells = hourly_cells(raw_lineitem(spark, sf)).select(*CELL)
    path = scratch(spark, "hourly_parts")
    write_stage(cells, path, fmt="csv")
    return merge_parts(spark, path, fmt="csv", schema=cells.schema)


def q_merge_parts_mixed(spark, sf):
    """Parts with their columns as they are, in another order with one more,
    and without an optional one."""
    cells = cut(hourly_cells(raw_lineitem(spark, sf)).select(*CELL, "hour"), "cells")
    path = scratch(spark, "mixed_parts")
    for k, cols in enumerate((CELL, ["hour", *CELL[::-1]], [c for c in CELL if c != "total_passages"])):
        write_stage(cells.filter(F.col("hour") % 3 == k).select(*cols), path, fmt="csv", mode="append")
    return merge_parts(spark, path, fmt="csv", schema=cells.select(*CELL).schema)


def q_read_results(spark, sf):
    z = _ev_zscored(spark, sf)
    path = scratch(spark, "results_csv")
    bad = F.when(F.col("hour") % 5 == 0, F.lit("n/a")).otherwise(F.col("z_score").cast("string"))
    write_stage(z.withColumn("z_score", bad), path, fmt="csv")
    return read_results(spark, path).select(*KEYS, "total_passengers", "z_score", "zscore_anomaly")


def q_coerce_numeric(spark, sf):
    from ctxanomaly.operators.features import coerce_numeric

    text = _ev_cells(spark, sf).select(
        *KEYS, *[F.col(c).cast("string").alias(c) for c in ("total_passengers", "total_passages", "record_count")]
    )
    return coerce_numeric(text, ["total_passengers", "total_passages", "record_count"])


def q_read_stage(spark, sf):
    from ctxanomaly.sources import read_stage

    cells = hourly_cells(raw_lineitem(spark, sf)).select(*CELL, *TEMPORAL)
    path = scratch(spark, "hourly_by_month")
    write_stage(cells, path, fmt="parquet", partition_by=("month",))
    return read_stage(spark, path).select(*CELL, *TEMPORAL)


def q_normalize_label(spark, sf):
    return normalize_label(_ev_zscored(spark, sf)).select(*KEYS, "zscore_anomaly")


def q_complete_rows(spark, sf):
    return complete_rows(normalize_label(_ev_zscored(spark, sf))).select(*CELL, "zscore_anomaly")


def q_in_range_rows(spark, sf):
    return in_range_rows(complete_rows(normalize_label(_ev_zscored(spark, sf)))).select(*CELL, "zscore_anomaly")


def q_drop_reasons(spark, sf):
    records = R.record_drop_reasons(cast_records(raw_events(spark, sf))).select(
        F.lit("records").alias("stage"), "reason", "row_count"
    )
    zs = _ev_zscored(spark, sf)
    prof = context_profile(ratio_features(forest_input(zs)), CFG.context, CFG.measure)
    cells = attach_context(_ev_cells(spark, sf), prof.select(*CFG.context, "context_obs_count"), CFG.context)
    cell_reasons = R.cell_drop_reasons(cells, CFG.min_context_obs).select(
        F.lit("cells").alias("stage"), "reason", "row_count"
    )
    return records.unionByName(cell_reasons)


def q_drop_reasons_observed(spark, sf):
    """The same counts as ``drop_reasons``, from the jobs that write the stages."""
    hourly, records, _ = hourly_observed(raw_events(spark, sf), cut)
    z = cut(zscore(hourly, CFG.context, CFG.measure, CFG.z_threshold, is_cut=True), "zscore")
    _, _, cells = featured_stage(z, CFG, count_drops=True)
    return R.observed_reasons(spark, "records", records).unionByName(R.observed_reasons(spark, "cells", cells))


def q_profile_records_observed(spark, sf):
    _, _, seen = hourly_observed(raw_events(spark, sf), cut)
    columns = ["row_count", *[f"non_null_{c}" for c in RAW]]
    return spark.createDataFrame([tuple(seen[c] for c in columns)], ", ".join(f"{c} bigint" for c in columns))


def q_drop_reasons_malformed(spark, sf):
    """Raw lines with one field too many, and with a quote that is not closed."""
    raw = raw_events(spark, sf)
    town = F.when(F.col("town") == "FRANCE", "FRANCE,x").when(F.col("town") == "PERU", '"PERU').otherwise(F.col("town"))
    path = scratch(spark, "broken_csv")
    raw.select(*[town.alias(c) if c == "town" else c for c in RAW]).write.option("header", True).option("quote", "").csv(path)
    typed = cast_records(read_records(spark, path, malformed=True))
    return R.record_drop_reasons(typed)


def q_contextual_zscore_events(spark, sf):
    return _ev_zscored(spark, sf).select(*CELL, *TEMPORAL, "group_mean", "group_std", "z_score", "is_anomaly")


ZCOLS = [*CELL, *TEMPORAL, "group_mean", "group_std", "z_score", "is_anomaly"]


def q_context_moments(spark, sf):
    return context_moments(hourly_cells(raw_lineitem(spark, sf)), CFG.context, CFG.measure)


def q_context_moments_merged(spark, sf):
    """Moments of all months from the kept sums of each."""
    cells = cut(hourly_cells(raw_lineitem(spark, sf)), "cells")
    path = scratch(spark, "context_state")
    write_stage(context_state(cells, CFG.context, CFG.measure, by=("month",)), path, partition_by=("month",))
    return state_moments(spark.read.parquet(path), CFG.context, CFG.measure)


def _late_correction(spark, sf):
    """A store of all months, March of every year delivered again with one
    passenger more in every record."""
    key = (spark.sparkContext.applicationId, sf, "store")
    if key not in _DETECTIONS:
        raw, path = raw_lineitem(spark, sf), scratch(spark, "store")
        update(raw, path, CFG)
        march = raw.filter(F.month("transition_date") == 3)
        scored = update(march.withColumn("number_of_passenger", F.col("number_of_passenger") + 1), path, CFG)
        _DETECTIONS[key] = path, cut(scored, "corrected")
    return _DETECTIONS[key]


def q_update_month(spark, sf):
    path, _ = _late_correction(spark, sf)
    return spark.read.parquet(f"{path}/hourly").select(*CELL, *TEMPORAL)


def q_update_zscore(spark, sf):
    return _late_correction(spark, sf)[1].select(*ZCOLS)


def q_rescore(spark, sf):
    path, _ = _late_correction(spark, sf)
    rescore(spark, path, cfg=CFG)
    return spark.read.parquet(f"{path}/zscore").select(*ZCOLS)


def q_contextual_zscore_bucketed(spark, sf):
    cells = cut_bucketed(hourly_cells(raw_lineitem(spark, sf)), "cells", CFG.context, 8)
    return zscore(cells, CFG.context, CFG.measure, CFG.z_threshold, is_cut=True, shuffled=True).select(*ZCOLS)


def q_attach_context(spark, sf):
    cells = hourly_cells(raw_lineitem(spark, sf))
    stats = context_moments(cells, CFG.context, CFG.measure)
    return attach_context(cells, stats, CFG.context).select(*CELL, *TEMPORAL, "group_mean", "group_std")


def q_contextual_zscore(spark, sf):
    return _lz(spark, sf).select(*ZCOLS)


def q_zscore_anomalies(spark, sf):
    return anomalies(_lz(spark, sf)).select(*ZCOLS)


def q_top_zscore(spark, sf):
    return top_by_abs(anomalies(_lz(spark, sf)), "z_score", 20, KEYS).select(*ZCOLS)


def q_threshold_sensitivity(spark, sf):
    return R.threshold_sensitivity(_lz(spark, sf))


def q_rate_by_month(spark, sf):
    return R.rate_by(_lz(spark, sf), "month")


def q_rate_by_line(spark, sf):
    return R.rate_by(_lz(spark, sf), "line")


def q_rate_by_weekend(spark, sf):
    return R.rate_by(_lz(spark, sf), "is_weekend")


def q_rate_by_town(spark, sf):
    return R.rate_by(_lz(spark, sf), "town")


def q_top5_line_rate(spark, sf):
    return R.top_rate(_lz(spark, sf), "line", 5)


def q_hourly_average(spark, sf):
    from ctxanomaly.operators.hourly import profile_by_hour

    return profile_by_hour(_lz(spark, sf))


def q_top_anomaly_lines(spark, sf):
    return R.anomaly_count_by(_lz(spark, sf), "line", "is_anomaly", 10)


def q_overall_ratio(spark, sf):
    return R.overall_ratio(_lz(spark, sf))


def q_dataset_summary(spark, sf):
    return R.dataset_summary(_lz(spark, sf).select(*ZCOLS))


def q_line_series(spark, sf):
    return R.line_series(_lz(spark, sf), "NO")


def q_ratio_features(spark, sf):
    return _l_ratios(spark, sf).select(*CELL, "passage_per_passenger", "passenger_per_record", "passage_per_record")


def q_context_profile(spark, sf):
    prof = context_profile(_l_ratios(spark, sf), CFG.context, CFG.measure)
    return prof.select(*[c for c in prof.columns if not c.startswith("_")])


def q_c_factor(spark, sf):
    prof = context_profile(_l_ratios(spark, sf), CFG.context, CFG.measure)
    return prof.select(*CFG.context, "context_obs_count", c_factor(F.col("context_obs_count")).alias("c_factor"))


def q_context_profile_joined(spark, sf):
    ratios = _l_ratios(spark, sf)
    prof = context_profile(ratios, CFG.context, CFG.measure)
    return attach_context(ratios, prof, CFG.context).select(
        *CELL, "context_obs_count", "context_mean_passengers", "context_var_passengers"
    )


def q_min_context(spark, sf):
    ratios = _l_ratios(spark, sf)
    prof = context_profile(ratios, CFG.context, CFG.measure)
    return min_context(attach_context(ratios, prof, CFG.context), CFG.min_context_obs).select(
        *CELL, "context_obs_count"
    )


def q_leave_one_out(spark, sf):
    ratios = _l_ratios(spark, sf)
    prof = context_profile(ratios, CFG.context, CFG.measure)
    joined = min_context(attach_context(ratios, prof, CFG.context), CFG.min_context_obs)
    return leave_one_out(joined).select(*CELL, "context_obs_count", "loo_mean_passengers", "loo_std_passengers")


def q_context_features(spark, sf):
    return context_features(forest_input(_lz(spark, sf))).select(*OUTPUT_COLUMNS)


def _l_features(spark, sf):
    return cut(context_features(forest_input(_lz(spark, sf))), "features")


def q_feature_moments(spark, sf):
    return feature_moments(_l_features(spark, sf))


def q_standardize(spark, sf):
    return standardize(_l_features(spark, sf)).select(*KEYS, *SCALED_FEATURES)


def _featured_scaled(spark, sf):
    return detection(spark, sf).featured


PUBLISHED = replace(CFG, pool_size=PUBLISHED_POOL)


def q_training_pool(spark, sf):
    return training_pool(_featured_scaled(spark, sf), PUBLISHED).select("row_key", "h_pool", *SCALED_FEATURES)


def q_bernoulli_sample(spark, sf):
    cfg = replace(CFG, pool_size=2000)
    return bernoulli_sample(_featured_scaled(spark, sf), cfg).select("row_key", "h_pool", *SCALED_FEATURES)


def q_bernoulli_pool(spark, sf):
    cfg = replace(CFG, pool_size=2000)
    return bernoulli_pool(_featured_scaled(spark, sf), cfg).select("row_key", "h_pool")


def q_tree_samples_published_pool(spark, sf):
    pool = cut(training_pool(_featured_scaled(spark, sf), PUBLISHED), "pool")
    return tree_samples(pool, PUBLISHED).select("tree_id", "row_key", "h_tree")


def q_tree_samples(spark, sf):
    return tree_samples(_featured_scaled(spark, sf), CFG).select("tree_id", "row_key", "h_tree")


def q_fit_forest(spark, sf):
    return fit_forest(tree_samples(_featured_scaled(spark, sf), CFG), CFG)


def q_iforest_score(spark, sf):
    return detection(spark, sf).scored.select(*KEYS, "iforest_path_units", "iforest_score")


def q_iforest_threshold(spark, sf):
    scored = detection(spark, sf).scored
    n = scored.count()
    flagged = F.col("iforest_anomaly") == 1
    return scored.agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.lit(threshold_rank(n, CFG.contamination)).cast("bigint").alias("threshold_rank"),
        F.max(F.when(flagged, F.col("iforest_path_units"))).alias("threshold_units"),
        F.min(F.when(flagged, F.col("iforest_score"))).alias("threshold_score"),
    )


def q_iforest_flags(spark, sf):
    return detection(spark, sf).scored.select(
        *KEYS, "zscore_anomaly", "iforest_score", "iforest_prediction", "iforest_anomaly"
    )


def q_detect_end_to_end(spark, sf):
    return detection(spark, sf).scored.select(*OUTPUT_COLUMNS, "iforest_score", "iforest_prediction", "iforest_anomaly")


def q_top_iforest(spark, sf):
    return top_by_score(detection(spark, sf).scored, 20, KEYS).select(
        *KEYS, "zscore_anomaly", "iforest_score", "iforest_anomaly"
    )


def q_method_summary(spark, sf):
    return R.method_summary(detection(spark, sf).scored)


def q_method_summary_events(spark, sf):
    return R.method_summary(detection(spark, sf, "events").scored)


def q_iforest_flags_events(spark, sf):
    return detection(spark, sf, "events").scored.select(
        *KEYS, "zscore_anomaly", "iforest_path_units", "iforest_score", "iforest_anomaly"
    )


def q_method_by_month(spark, sf):
    return R.method_by(detection(spark, sf).scored, "month")


def q_method_by_line(spark, sf):
    return R.method_by(detection(spark, sf).scored, "line")


def q_method_grouping_sets(spark, sf):
    return R.method_cube(detection(spark, sf).scored)


def q_line_ranking_min_obs(spark, sf):
    return R.line_ranking(R.method_by(detection(spark, sf).scored, "line"), min_obs=1000, top_n=3)


def q_line_rate_pairs(spark, sf):
    return R.line_rate_pairs(R.method_by(detection(spark, sf).scored, "line"), min_obs=1000)


def q_monthly_counts_long(spark, sf):
    return R.monthly_long(R.method_by(detection(spark, sf).scored, "month"), "count")


def q_monthly_rates_long(spark, sf):
    return R.monthly_long(R.method_by(detection(spark, sf).scored, "month"), "rate")


def q_method_table(spark, sf):
    return R.method_table(R.method_summary(detection(spark, sf).scored))


def q_overlap_table(spark, sf):
    return R.overlap_table(R.method_summary(detection(spark, sf).scored))


def q_write_report(spark, sf):
    from ctxanomaly.sources import read_stage, write_report

    by_month = R.method_by(detection(spark, sf).scored, "month")
    path = scratch(spark, "monthly_report")
    write_report(by_month, path, fmt="csv", order=R.method_order("month"))
    return read_stage(spark, path, fmt="csv", schema=by_month.schema)


def q_iforest_flags_approx(spark, sf):
    """Whether the approximate threshold's rank is within its tolerance, and
    the flags are the rows at or above it."""
    cfg = replace(CFG, threshold_mode="approx")
    scored = detection(spark, sf).scored.drop("iforest_anomaly", "iforest_prediction")
    threshold = contamination_threshold(scored, cfg)
    below, at = F.col("iforest_score") < threshold[0], F.col("iforest_score") <= threshold[0]
    counts = flag_ge(scored, threshold).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(below).alias("below"), F.count_if(at).alias("at_most"),
        F.count_if((F.col("iforest_anomaly") == 1) != ~below).alias("wrong"),
    )
    rank = F.ceil(F.col("n") * F.lit(1 - cfg.contamination))
    slack = F.col("n") * F.lit(cfg.quantile_rel_error) + 1
    within = (F.col("below") <= rank + slack) & (F.col("at_most") >= rank - slack)
    return counts.select(
        F.col("n").alias("scored_rows"), within.alias("rank_within_tolerance"), (F.col("wrong") == 0).alias("flags_follow_score")
    )


def q_iforest_flags_sketch(spark, sf):
    """Whether the threshold from monthly sketches has a rank within their
    bound, and the flags are the rows at or above it."""
    scored = detection(spark, sf).scored.drop("iforest_anomaly", "iforest_prediction")
    units = sketch_threshold(cut(score_sketches(scored), "sketches"), CFG)
    at, u = F.lit(units), F.col("iforest_path_units")
    counts = flag_ge(scored, (score_of_units(units, CFG), units)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(u < at).alias("below"), F.count_if(u <= at).alias("at_most"),
        F.count_if((F.col("iforest_anomaly") == 1) != (u <= at)).alias("wrong"),
    )
    rank = F.floor(F.col("n") * F.lit(CFG.contamination)) + 1
    slack = F.col("n") * F.lit(SKETCH_RANK_ERROR) + 1
    within = (F.col("below") <= rank + slack) & (F.col("at_most") >= rank - slack)
    return counts.select(
        F.col("n").alias("scored_rows"), within.alias("rank_within_bound"), (F.col("wrong") == 0).alias("flags_follow_units")
    )


def q_formatted_monthly(spark, sf):
    return R.formatted_monthly(R.method_by(detection(spark, sf).scored, "month"))


def q_hourly_aggregate_prices(spark, sf):
    return hourly_cells(raw_prices(spark, sf)).select(*CELL)


def q_contextual_zscore_prices(spark, sf):
    return detection(spark, sf, "prices").zscored.select(*ZCOLS)


def q_context_features_prices(spark, sf):
    featured = detection(spark, sf, "prices").featured
    loo = F.round("loo_std_passengers", 4)  # deviations of 1e5: compared at four decimals
    return featured.withColumn("loo_std_passengers", loo).select(*OUTPUT_COLUMNS)


def q_iforest_flags_prices(spark, sf):
    return detection(spark, sf, "prices").scored.select(
        *KEYS, "zscore_anomaly", "iforest_path_units", "iforest_score", "iforest_anomaly"
    )


def q_method_summary_prices(spark, sf):
    return R.method_summary(detection(spark, sf, "prices").scored)


def _text_detection(spark, sf):
    """The forest from z-scores written as text: some passages are not
    numbers, and labels read 1.0, TRUE or false."""
    key = (spark.sparkContext.applicationId, sf, "text")
    if key not in _DETECTIONS:
        z = detection(spark, sf).zscored
        label = F.when(F.col("is_anomaly"), F.when(F.col("hour") % 2 == 0, "1.0").otherwise("TRUE")).otherwise("false")
        bad = F.when(F.dayofmonth("datetime") == 13, F.lit("n/a")).otherwise(F.col("total_passages").cast("string"))
        path = scratch(spark, "zscore_text")
        text = z.withColumns({"total_passages": bad, "zscore_anomaly": label}).drop("is_anomaly", "month")
        write_stage(text, path, fmt="csv")
        _DETECTIONS[key] = detect_forest(coerce_datetime(spark.read.option("header", True).csv(path)), CFG)
    return _DETECTIONS[key]


def q_iforest_flags_text(spark, sf):
    return _text_detection(spark, sf).scored.select(*KEYS, "zscore_anomaly", "iforest_path_units", "iforest_anomaly")


def q_drop_reasons_text(spark, sf):
    return cell_report(None, _text_detection(spark, sf))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: both methods end to end on sf0.001 F2, compared by month."""
    return rounded(R.method_by(detection(spark, FLAGSHIP_SF).scored, "month"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _wrap(fn) for name, fn in _QUERIES.items()}
    if corpus_queries is not None:
        out |= corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query key."""
    sql = sql_queries()
    out = {k: sql[k] for k in _QUERIES if k in sql}
    if corpus_queries is not None:
        out |= corpus_queries.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return out
