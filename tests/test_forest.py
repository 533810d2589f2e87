"""Isolation forest: kernels, exact ranks, reproducibility, plans."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ctxanomaly.config import DetectConfig
from ctxanomaly.functions.expressions import c_factor, c_factor_py
from ctxanomaly.functions.isotree import ForestArrays, grow_tree, leaf_units
from ctxanomaly.operators.forest import DRAW_PRIME, any_draw_below, draw_factors, fit, threshold_rank
from ctxanomaly.operators.quantile import value_at_rank
from ctxanomaly.schema import PATH_UNIT

from conftest import SF001


def test_c_factor_values(spark):
    assert [c_factor_py(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert c_factor_py(256) == pytest.approx(10.244771, abs=1e-6)
    df = spark.createDataFrame([(0,), (1,), (2,), (256,)], "n int")
    got = [r.c for r in df.select(c_factor(df.n).alias("c")).collect()]
    assert got == pytest.approx([0.0, 0.0, 1.0, 10.244771], abs=1e-6)


def test_max_depth_from_max_samples():
    assert DetectConfig().max_depth == math.ceil(math.log2(256)) == 8
    assert DetectConfig(max_samples=257).max_depth == 9


def test_leaf_rules():
    # one row -> leaf at the root
    nodes = grow_tree(0, np.array([[1.0, 2.0]]), 42, 8)
    assert len(nodes) == 1 and nodes[0][4] is True and nodes[0][3] == 1
    # constant data: the chosen feature is constant -> leaf, no retry
    nodes = grow_tree(0, np.full((50, 3), 4.0), 42, 8)
    assert len(nodes) == 1 and nodes[0][4] is True and nodes[0][3] == 50
    # depth cap: every leaf at depth <= cap; sizes of leaves add up to n
    x = np.random.default_rng(0).normal(size=(256, 4))
    nodes = grow_tree(3, x, 42, 8)
    leaves = [n for n in nodes if n[4]]
    assert max(n[2] for n in nodes) <= 8
    assert sum(n[3] for n in leaves) == 256
    for n in leaves:
        assert n[7] == leaf_units(n[2], n[3])


def test_descent_matches_tree_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(256, 3))
    rows = []
    for t in range(4):
        rows += grow_tree(t, x, 7, 8)
    nodes = pd.DataFrame(
        rows, columns=["tree_id", "node_id", "depth", "size", "is_leaf", "feature", "split", "path_units"]
    )
    arrays = ForestArrays(nodes, 4, 8)
    probe = rng.normal(size=(100, 3)) * 2
    got = arrays.path_units(probe)
    index = {(r.tree_id, r.node_id): r for r in nodes.itertuples()}
    for i, row in enumerate(probe):
        total = 0
        for t in range(4):
            node = index[(t, 1)]
            while not node.is_leaf:
                child = 2 * node.node_id + (1 if row[int(node.feature)] >= node.split else 0)
                node = index[(t, child)]
            total += int(node.path_units)
        assert got[i] == total


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=2**40), min_size=1, max_size=300), st.data())
def test_value_at_rank_is_exact(spark, values, data):
    rank = data.draw(st.integers(min_value=1, max_value=len(values)))
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = value_at_rank(df, "v", rank, 62, max_rows=7)
    assert got == sorted(values)[rank - 1]


def test_threshold_rank_uses_exact_decimal():
    assert threshold_rank(59752, 0.011448) == math.ceil(59752 * 988552 / 1_000_000)
    assert threshold_rank(1, 0.5) == 1
    assert threshold_rank(10, 0.0) == 10


def test_small_pool_is_an_error(spark, detection001):
    cfg = DetectConfig(min_pool_rows=10**6)
    with pytest.raises(ValueError, match="training pool"):
        fit(detection001.featured, cfg)


def test_scores_and_flags(detection001):
    s = detection001.scored
    row = s.agg({"iforest_score": "min"}).collect()[0][0], s.agg({"iforest_score": "max"}).collect()[0][0]
    assert 0.0 < row[0] <= row[1] < 1.0
    n = s.count()
    flagged = s.filter("iforest_anomaly = 1").count()
    # ties at the threshold are flagged, so at least the target count
    assert flagged >= n - threshold_rank(n, 0.011448) + 1
    score_thr, units_thr = detection001.threshold
    assert s.filter(f"iforest_anomaly = 1 and iforest_score < {score_thr - 1e-12}").count() == 0
    assert units_thr is not None


def test_forest_is_partition_independent(spark, detection001):
    from ctxanomaly.plans.detect import detect
    from ctxanomaly.sources import raw_lineitem

    other = detect(raw_lineitem(spark, SF001).repartition(7))
    key = ["tree_id", "node_id"]
    a = detection001.nodes.sort_values(key).reset_index(drop=True)
    b = other.nodes.sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_exact=True)
    cols = ["datetime", "line", "line_name", "town", "iforest_path_units", "iforest_anomaly"]
    fa = {tuple(r) for r in detection001.scored.select(*cols).collect()}
    fb = {tuple(r) for r in other.scored.select(*cols).collect()}
    assert fa == fb


def test_scoring_udf_runs_once(detection001):
    # reports read the written scores: no Python evaluation in their plans
    from ctxanomaly.operators.reports import method_by

    plan = method_by(detection001.scored, "month")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_path_unit_scale():
    assert PATH_UNIT == 10**9


def test_approx_threshold_is_close_to_exact(detection001):
    from dataclasses import replace

    from ctxanomaly.operators.forest import contamination_threshold, flag_ge

    scored = detection001.scored.drop("iforest_anomaly", "iforest_prediction")
    cfg = replace(DetectConfig(), threshold_mode="approx")
    thr = contamination_threshold(scored, cfg)
    assert thr[1] is None
    n = scored.count()
    r = threshold_rank(n, cfg.contamination)
    slack = cfg.quantile_rel_error * n + 1
    below = scored.filter(f"iforest_score < {thr[0]!r}").count()
    at_most = scored.filter(f"iforest_score <= {thr[0]!r}").count()
    # approxQuantile's guarantee: the returned value's rank is within rel_error * n
    assert below <= r + slack and at_most >= r - slack
    assert flag_ge(scored, thr).filter("iforest_anomaly = 1").count() == n - below


def test_forest_ignores_shuffle_partitioning(spark, detection001):
    from ctxanomaly.plans.detect import detect
    from ctxanomaly.sources import raw_lineitem

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        other = detect(raw_lineitem(spark, SF001).coalesce(1))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    key = ["tree_id", "node_id"]
    pd.testing.assert_frame_equal(
        detection001.nodes.sort_values(key).reset_index(drop=True),
        other.nodes.sort_values(key).reset_index(drop=True),
        check_exact=True,
    )
    assert detection001.threshold == other.threshold
    cols = ["datetime", "line", "line_name", "town", "iforest_path_units", "iforest_anomaly", "zscore_anomaly"]
    assert {tuple(r) for r in detection001.scored.select(*cols).collect()} == {
        tuple(r) for r in other.scored.select(*cols).collect()
    }


def test_fractional_measures_give_the_same_bits(spark):
    from ctxanomaly.plans.detect import detect
    from ctxanomaly.sources import raw_prices

    raw = raw_prices(spark, SF001)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    runs = []
    for parts, shuffle in ((1, "1"), (7, "8"), (64, "64")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        try:
            runs.append(detect(raw.repartition(parts)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    cols = ["datetime", "line", "line_name", "town", "total_passengers", "iforest_path_units", "iforest_anomaly", "zscore_anomaly"]
    first = {tuple(r) for r in runs[0].scored.select(*cols).collect()}
    nodes = [r.nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True) for r in runs]
    for r, n in zip(runs[1:], nodes[1:]):
        pd.testing.assert_frame_equal(nodes[0], n, check_exact=True)
        assert {tuple(x) for x in r.scored.select(*cols).collect()} == first
    assert any(x[4] % 1 for x in first)


def test_draws_cover_all_rows_and_a_pool_only_part(spark, detection001):
    from dataclasses import replace

    from ctxanomaly.operators.forest import training_pool, tree_samples

    featured = detection001.featured
    n = featured.count()
    every = tree_samples(featured, DetectConfig())
    assert every.groupBy("tree_id").count().filter("count != 256").isEmpty()
    assert every.select("row_key").distinct().count() > 0.8 * n
    small = replace(DetectConfig(), pool_size=300)
    pool = training_pool(featured, small)
    assert pool.count() == 300
    want = sorted((r.h_pool, r.row_key) for r in featured.select("h_pool", "row_key").collect())[:300]
    assert sorted((r.h_pool, r.row_key) for r in pool.collect()) == want
    few = tree_samples(pool.limit(100), DetectConfig(max_samples=256, num_trees=3))
    assert few.count() == 300  # fewer rows than max_samples: every tree gets them all


def test_config_validation():
    for bad in (
        dict(contamination=1.0),
        dict(num_trees=0),
        dict(max_samples=1),
        dict(min_context_obs=1),
        dict(threshold_mode="fast"),
        dict(pool_size=0),
        dict(num_trees=1_000_000),
    ):
        with pytest.raises(ValueError):
            DetectConfig(**bad)


def test_draws_below_a_bound_by_folding():
    prime = DRAW_PRIME
    h = np.array([0, 1, prime - 1, prime, prime + 1, (1 << 60) - 1, *range(10**9, 10**9 + 500)], dtype=np.int64)
    for factors in ([(1, 0)], [(prime - 1, prime - 1)], [(1, prime - 1), (12345, 6789)], draw_factors(DetectConfig())):
        least = np.min([(h % prime * a + b) % prime for a, b in factors], axis=0)
        for bound in (1, 2, 10**6, 10**9, prime - 1, prime):
            assert (any_draw_below(h, factors, bound) == (least < bound)).all()
