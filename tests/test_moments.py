"""Exact one-pass sums, their states, and what the plans read."""

import datetime as dt
import math
import os
import uuid
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ctxanomaly.config import FEATURES
from ctxanomaly.functions.sums import FixedSums
from ctxanomaly.operators.context import (
    RATIOS,
    context_moments,
    context_state,
    context_sums,
    merge_states,
    ratio_features,
    state_moments,
)
from ctxanomaly.operators.features import context_features, feature_moments, forest_input, wide_moments
from ctxanomaly.operators.forest import score_sketches, sketch_threshold, threshold_rank, training_pool
from ctxanomaly.operators.reports import observed_reasons
from ctxanomaly.operators.zscore import zscore
from ctxanomaly.plans.detect import bucketed_store, detect, featured_stage, hourly_cells, hourly_observed
from ctxanomaly.plans.run import drop_reasons
from ctxanomaly.plans.update import rescore, update
from ctxanomaly.session import checkpoint_root, cut, cut_bucketed
from ctxanomaly.sources import raw_events, raw_lineitem, read_records, write_stage

from conftest import SF001

CONTEXT = ("line", "hour", "spark_dayofweek")


def cells(spark, values, line="A"):
    rows = [(dt.datetime(2024, 1, 1 + i % 28, 5), line, 5, 2, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "datetime timestamp_ntz, line string, hour int, spark_dayofweek int, total_passengers double")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-(10**15), 10**15), min_size=1, max_size=30))
def test_fixed_sums_are_exact(spark, units):
    fixed = FixedSums("x", 10**6)
    df = spark.createDataFrame([(u / 1e6,) for u in units], "x double").repartition(3)
    row = df.withColumns(fixed.halves(F.col("x"))).agg(*fixed.aggregates())
    got = row.select("*", fixed.total().alias("s"), fixed.total_of_squares().alias("s2")).first()
    exact = [Fraction(round(Fraction(u / 1e6) * 10**6)) for u in units]
    assert got["_misfit_x"] == 0 and got["_n_x"] == len(units)
    assert int(got["s"]) == sum(exact) and int(got["s2"]) == sum(k * k for k in exact)
    mean, std = fixed.moments(got)
    assert mean == float(sum(exact) / len(exact) / 10**6)
    if len(exact) > 1:
        m = sum(exact) / len(exact)
        assert std == pytest.approx(math.sqrt(sum((k - m) ** 2 for k in exact) / (len(exact) - 1)) / 1e6, rel=1e-15)


def test_values_beyond_the_scale_are_counted_not_rounded(spark):
    fixed = FixedSums("x", 10**6)
    df = spark.createDataFrame([(1.5,), (1e-9,), (1e14,), (None,), (-2.25,)], "x double")
    got = df.withColumns(fixed.halves(F.col("x"))).agg(*fixed.aggregates()).select("*", fixed.total().alias("s")).first()
    assert got["_misfit_x"] == 2 and got["_n_x"] == 2 and int(got["s"]) == -750_000


def test_one_context_beyond_the_scale_leaves_others_in_one_pass(spark):
    df = cut(cells(spark, [1.0, 2.0, 4.5]).unionByName(cells(spark, [1e15, 1e15 + 1, 1e15 + 5], "B")).unionByName(cells(spark, [1 / 3, 2 / 3], "C")), "cells")
    got = {r["line"]: r for r in context_moments(df).collect()}
    assert got["A"]["group_mean"] == 2.5 and got["A"]["group_std"] == pytest.approx(math.sqrt(3.25), rel=1e-15)
    assert got["B"]["group_mean"] == 1e15 + 2 and got["B"]["group_std"] == pytest.approx(math.sqrt(7), rel=1e-12)
    assert got["C"]["group_mean"] == pytest.approx(0.5, rel=1e-15)


def test_sums_are_bit_equal_at_any_partitioning(spark):
    base = ratio_features(forest_input(cut(zscore(hourly_cells(raw_lineitem(spark, SF001))), "z")))
    want = None
    for n in (1, 7, 64):
        got = sorted(map(tuple, context_sums(base.repartition(n), CONTEXT, "total_passengers", list(RATIOS)).collect()))
        want = want or got
        assert got == want
    f = cut(context_features(forest_input(cut(zscore(hourly_cells(raw_lineitem(spark, SF001))), "z"))), "f")
    moments = {tuple(feature_moments(f.repartition(n)).first()) for n in (1, 7, 64)}
    assert len(moments) == 1


def test_no_pass_for_extremes_and_no_join_in_the_statistics(spark):
    state = context_state(hourly_cells(raw_lineitem(spark, SF001)), CONTEXT, "total_passengers")
    p = plan(state)
    assert "min(total_passengers" in p and p.count("HashAggregate") == 4  # cells, then their contexts
    joins = [line for line in p.splitlines() if "Join" in line]
    assert len(joins) == 2  # those of the raw mapping


def test_feature_moments_of_any_doubles(spark):
    df = spark.createDataFrame([(1e-12 * i, float(i), None) for i in range(9)], "a double, b double, c double")
    got = feature_moments(df, ["a", "b", "c"]).first()
    want = wide_moments(df, ["a"]).first()
    assert got["a_mean"] == want["a_mean"] and got["a_std"] == want["a_std"]
    assert got["b_mean"] == 4.0 and got["c_mean"] is None and got["c_std"] is None
    empty = feature_moments(df.limit(0), ["a"]).first()
    assert empty["a_mean"] is None


def test_merged_states_equal_the_state_of_all(spark):
    c = cut(hourly_cells(raw_lineitem(spark, SF001)), "cells")
    by_month = context_state(c, CONTEXT, "total_passengers", by=("month",))
    whole = context_state(c, CONTEXT, "total_passengers")
    columns = whole.columns
    merged = merge_states(by_month).select(*columns)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    a, b = (sorted(map(tuple, m.collect())) for m in (state_moments(by_month), context_moments(c)))
    assert a == b  # bit for bit


def test_state_with_values_beyond_the_scale_is_an_error(spark):
    with pytest.raises(ValueError, match="scale"):
        state_moments(context_state(cells(spark, [1e-9, 2.0]), CONTEXT, "total_passengers"))


def test_update_replaces_its_months_only(spark):
    store = f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}"
    raw = raw_lineitem(spark, SF001)
    update(raw, store)

    def files(month_is):
        out = {}
        for stage in ("hourly", "context_state", "zscore"):
            for folder, _, names in os.walk(f"{store}/{stage}"):
                for n in names:
                    if n.endswith(".parquet") and folder.endswith("month=3") == month_is:
                        out[f"{folder}/{n}"] = os.path.getmtime(f"{folder}/{n}")
        return out

    others, march = files(False), files(True)
    assert others and march
    late = raw.filter(F.month("transition_date") == 3).withColumn("number_of_passenger", F.col("number_of_passenger") * 2)
    scored = update(late, store)
    assert files(False) == others and not set(files(True)) & set(march)
    assert {r["month"] for r in scored.select("month").distinct().collect()} == {3}
    again = sorted(map(tuple, scored.select("datetime", "line", "town", "z_score").collect()), key=repr)
    update(late, store)  # run again: the same store
    assert sorted(map(tuple, scored.sparkSession.read.parquet(f"{store}/zscore").filter("month = 3").select("datetime", "line", "town", "z_score").collect()), key=repr) == again
    rescore(spark, store)
    full = spark.read.parquet(f"{store}/hourly")
    want = sorted(map(tuple, zscore(full).select("datetime", "line", "town", "z_score").collect()), key=repr)
    assert sorted(map(tuple, spark.read.parquet(f"{store}/zscore").select("datetime", "line", "town", "z_score").collect()), key=repr) == want


def test_only_partitioned_tables_are_replaced_in_part(spark):
    with pytest.raises(ValueError, match="partition"):
        write_stage(spark.range(3), f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}", mode="replace")


def test_bucketed_fact_is_not_shuffled_by_its_context(spark):
    fact = cut_bucketed(hourly_cells(raw_lineitem(spark, SF001)), "cells", CONTEXT, 4)
    assert "Exchange" not in plan(context_state(fact, CONTEXT, "total_passengers"))
    out = zscore(fact, is_cut=True, shuffled=True)
    p = plan(out)
    assert "SortMergeJoin" in p and "Bucketed: true" in p and "BroadcastHashJoin" not in p
    # each Exchange deals statistics: none stands above a scan of the fact
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Exchange" in line:
            below = "\n".join(lines[i + 1 : i + 6])
            assert "group_mean" in below or "_lo_" in below or "context_stats" in below, below
    want = sorted(map(tuple, zscore(hourly_cells(raw_lineitem(spark, SF001))).select(*out.columns).collect()), key=repr)
    assert sorted(map(tuple, out.collect()), key=repr) == want


def test_detection_over_buckets_is_the_same(spark, detection001):
    d = detect(raw_lineitem(spark, SF001), store=bucketed_store(detection001.cfg, 4))
    assert d.threshold == detection001.threshold
    assert d.scored.filter("iforest_anomaly = 1").count() == detection001.scored.filter("iforest_anomaly = 1").count()
    held = [t.name for t in spark.catalog.listTables() if t.name.startswith(("ctxanomaly_hourly_", "ctxanomaly_zscore_"))]
    assert len(held) == 2 and d.cleanup()
    assert not [t.name for t in spark.catalog.listTables() if t.name in held]


def test_observed_counts_are_those_of_scans(spark, detection001):
    raw = raw_events(spark, SF001)
    hourly, records, profile = hourly_observed(raw, cut)
    z = cut(zscore(hourly, is_cut=True), "z")
    feats, total, cells_ = featured_stage(z, count_drops=True)
    assert total == feats.count() and profile["row_count"] == raw.count()
    got = observed_reasons(spark, "records", records).unionByName(observed_reasons(spark, "cells", cells_))

    class Seen:
        drops, zscored, cfg = {}, z, detection001.cfg

    want = drop_reasons(raw, Seen)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_counting_drops_scans_the_raw_table_once(spark):
    df, _, _ = hourly_observed(raw_lineitem(spark, SF001), lambda df, name: _planned(df))
    assert df is not None


def _planned(df):
    p = plan(df)
    assert p.count("CollectMetrics") == 2 and p.count("lineitem.parquet") == 1
    return cut(df, "hourly")


def test_malformed_lines_are_a_reason_of_their_own(spark):
    path = f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}"
    os.makedirs(path)
    head = "transition_date,transition_hour,line,line_name,town,number_of_passenger,number_of_passage"
    good = '2020-01-01,5,A,"L, ""A""",T,3,4'
    lines = [good, "2020-01-01,5,A,L,T,3", good + ",9", '2020-01-01,5,A,"L,T,3,4', "x,5,A,L,T,3,4", good, '2020-01-01,5,A,L,T,3,"4']
    with open(f"{path}/a.csv", "w") as f:
        f.write("\n".join([head, *lines]) + "\n")
    from ctxanomaly.operators.records import cast_records, valid_records
    from ctxanomaly.operators.reports import record_drop_reasons

    typed = cast_records(read_records(spark, path, malformed=True))
    got = {r["reason"]: r["row_count"] for r in record_drop_reasons(typed).collect()}
    assert got == {"malformed_line": 3, "null_or_bad_date": 1, "kept": 3}
    assert valid_records(typed).count() == 3 and "_malformed" not in valid_records(typed).columns
    by_file = cast_records(read_records(spark, path, by_file=True, malformed=True))
    assert record_drop_reasons(by_file).filter("reason = 'malformed_line'").first()["row_count"] == 3


def test_pool_is_one_scan_of_exactly_its_rows(spark, detection001):
    from dataclasses import replace

    rows = detection001.featured
    for size in (1, 300, 5029, 5030, 10**6):
        cfg = replace(detection001.cfg, pool_size=size)
        got = [(r["h_pool"], r["row_key"]) for r in training_pool(rows, cfg).select("h_pool", "row_key").collect()]
        every = sorted((r["h_pool"], r["row_key"]) for r in rows.select("h_pool", "row_key").collect())
        assert sorted(got) == every[:size]
    assert "featured" not in plan(training_pool(rows, replace(detection001.cfg, pool_size=300)).select("row_key"))


def test_sketch_threshold_of_months_and_of_all(spark, detection001):
    scored = detection001.scored
    units = sorted(r[0] for r in scored.select("iforest_path_units").collect())
    n = len(units)
    rank = n - threshold_rank(n, detection001.cfg.contamination) + 1
    for sketches in (score_sketches(scored), score_sketches(scored, by=())):
        got = sketch_threshold(sketches, detection001.cfg)
        low, high = sum(u < got for u in units), sum(u <= got for u in units)
        assert low <= rank + 0.0005 * n + 1 and high >= rank - 0.0005 * n - 1
    assert score_sketches(scored).count() == 12
    with pytest.raises(ValueError, match="no scored rows"):
        sketch_threshold(score_sketches(scored.limit(0)), detection001.cfg)


def test_all_features_have_moments(spark, detection001):
    got = feature_moments(detection001.featured).first()
    assert all(got[f"{c}_mean"] is not None and got[f"{c}_std"] > 0 for c in FEATURES)


def test_bernoulli_pool_is_reproducible_and_bounded(spark, detection001):
    from dataclasses import replace

    from ctxanomaly.operators.forest import bernoulli_pool, bernoulli_sample, fit

    rows, cfg = detection001.featured, replace(detection001.cfg, pool_size=1000, pool_mode="bernoulli")
    a, b = (sorted(r[0] for r in bernoulli_sample(rows.repartition(n), cfg).select("row_key").collect()) for n in (1, 13))
    assert a == b and 850 < len(a) < 1150
    pool = sorted(r[0] for r in bernoulli_pool(rows, cfg).select("row_key").collect())
    assert len(pool) == min(1000, len(a)) and set(pool) <= set(a)
    assert bernoulli_sample(rows, replace(cfg, pool_size=10**6)).count() == rows.count()
    assert fit(rows, cfg)["tree_id"].nunique() == cfg.num_trees
    with pytest.raises(ValueError, match="pool size"):
        bernoulli_sample(rows, detection001.cfg)
