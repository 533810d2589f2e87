"""Physical-plan properties that matter at scale."""

from ctxanomaly.config import FEATURES
from ctxanomaly.operators import forest
from ctxanomaly.operators import reports as R
from ctxanomaly.operators.features import context_features, forest_input
from ctxanomaly.operators.forest import score_forest, tree_samples
from ctxanomaly.operators.zscore import zscore
from ctxanomaly.plans.detect import OUTPUT_COLUMNS, hourly_cells
from ctxanomaly.sources import raw_lineitem

from conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_scan_prunes_columns_and_pushes_filters(spark):
    p = plan(hourly_cells(raw_lineitem(spark, SF001)))
    assert "PushedFilters: [IsNotNull(l_shipdate)" in p
    assert "GreaterThanOrEqual(l_quanti" in p  # plan text is abbreviated
    # lineitem columns not used by the mapping never leave the file
    assert "l_extendedprice" not in p and "l_comment" not in p
    assert "partial_sum" in p  # map-side combine before the shuffle


def test_tree_samples_limit_before_shuffle(spark, detection001):
    p = plan(tree_samples(detection001.featured))
    assert "WindowGroupLimit" in p
    assert "Join" not in p and "featured" not in p  # reads the few drawn rows only


def test_raw_tables_are_scanned_once(spark):
    z = zscore(hourly_cells(raw_lineitem(spark, SF001)))
    features = context_features(forest_input(z))
    for df in (z, features):
        assert not [f for f in df.inputFiles() if "lineitem" in f]  # all later reads are of the cut cells


def test_scoring_is_arrow_batched_and_map_only(spark, detection001):
    p = plan(score_forest(detection001.featured, detection001.nodes))
    assert "ArrowEvalPython" in p
    assert "BatchEvalPython" not in p
    assert "Exchange" not in p


def test_report_cube_is_one_scan(detection001):
    p = plan(R.method_cube(detection001.scored))
    assert p.count("FileScan parquet") == 1 or p.count("Scan parquet") == 1
    assert "Expand" in p


def test_cuts_hold_totals_and_profiles_not_features(spark, detection001):
    for df in (detection001.featured, detection001.scored):
        stored = spark.read.parquet(*df.inputFiles()).columns
        assert not {*FEATURES, "row_key", "iforest_score"} & {*stored}
        assert {"loo_mean_passengers", "context_avg_passage_per_passenger"} <= {*stored}
    again = context_features(forest_input(detection001.zscored)).select(*OUTPUT_COLUMNS)
    for df in (detection001.featured, detection001.scored):
        assert again.exceptAll(df.select(*OUTPUT_COLUMNS)).count() == 0 and again.count() == df.count()


def test_draws_are_told_by_arrow_batches_of_the_scan(spark, detection001, monkeypatch):
    seen = []
    monkeypatch.setattr(forest, "cut", lambda df, name: seen.append(plan(df)) or df)
    tree_samples(detection001.featured, total=5030)
    lines = seen[0].splitlines()
    at = next(i for i, line in enumerate(lines) if "ArrowEvalPython [drawn(h_pool" in line)
    assert "Scan parquet" in "".join(lines[at : at + 3])  # before the features are derived
