"""Isolation forest over the scaled context features.

* rows: all of them, or (``pool_size``) those with the smallest hash(seed,
  "pool", row key), found by an exact distributed rank search;
* per tree: the ``max_samples`` rows with the smallest draw value, a cheap
  function of (row hash, tree).  Rows are filtered by a bound on that value
  in the scan, so only a few times ``max_samples`` rows a tree are ranked;
* fit: ``groupBy(tree_id).applyInPandas`` grows the trees in parallel (one
  bounded group per tree) into a node table;
* score: an Arrow iterator UDF walks compact node arrays (bounded by
  trees x (2 max_samples - 1) nodes) and returns the summed leaf path length in integer
  units; the score 2^(-avg_path / c(max_samples)) is a JVM expression;
* threshold: exact rank ceil((1 - contamination) N) of the score, or the
  original approxQuantile; flag = score >= threshold (ties flagged).

Neither rows nor draws depend on partitioning or row order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ctxanomaly.config import HOURLY_KEYS, SCALED_FEATURES, DetectConfig
from ctxanomaly.functions.expressions import HASH_BITS, c_factor_py, hash_int, hash_int_py, row_key
from ctxanomaly.functions.isotree import ForestArrays, grow_trees_pdf
from ctxanomaly.operators.quantile import value_at_rank
from ctxanomaly.schema import NODES, PATH_UNIT
from ctxanomaly.session import cut, cut_observed, ship_package

DRAW_PRIME = (1 << 31) - 1
DRAW_MARGIN = 4
#: Size parameter of the kept quantile sketches, and the share of the rows by
#: which a rank read from one may be off.
SKETCH_K = 8000
SKETCH_RANK_ERROR = 0.0005


def with_row_key(df: DataFrame, keys: Sequence[str] = HOURLY_KEYS) -> DataFrame:
    return df.withColumn("row_key", row_key(*keys))


def with_pool_hash(df: DataFrame, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    """Add ``h_pool`` = hash(seed, "pool", row_key): the pool order key."""
    return df.withColumn("h_pool", hash_int(F.lit(cfg.seed), F.lit("pool"), F.col("row_key")))


def _with_pool_hash(df: DataFrame, cfg: DetectConfig, features: Sequence[str]) -> DataFrame:
    if "h_pool" not in df.columns:
        df = with_pool_hash(df, cfg)
    return df.select("row_key", "h_pool", *features)


def training_pool(
    df: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    features: Sequence[str] = SCALED_FEATURES,
    total: int | None = None,
) -> DataFrame:
    """The rows that trees are drawn from: all, or exactly ``cfg.pool_size``
    of the smallest (h_pool, row_key).

    ``df`` needs ``row_key`` and the feature columns.  Hashes are uniform, so
    rows under a bound a tenth above the pool's share of all hashes are a few
    more than the pool: they leave one scan, are counted as they are written,
    and are ordered.  Should they be too few, the bound is doubled.  ``total``:
    the number of rows, if known.
    """
    keyed = _with_pool_hash(df, cfg, features)
    if cfg.pool_size is None:
        return keyed
    total = keyed.count() if total is None else total
    if total <= cfg.pool_size:
        return keyed
    every = 1 << HASH_BITS
    bound = min(every, every * (cfg.pool_size + cfg.pool_size // 10 + 100) // total)
    while True:
        low, seen = cut_observed(keyed.filter(F.col("h_pool") < F.lit(bound)), "pool_candidates", rows=F.count(F.lit(1)))
        if seen["rows"] >= cfg.pool_size or bound == every:
            return low.orderBy("h_pool", "row_key").limit(cfg.pool_size)
        bound = min(every, 2 * bound)


def bernoulli_sample(
    df: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    features: Sequence[str] = SCALED_FEATURES,
    total: int | None = None,
) -> DataFrame:
    """Every row with the same chance, the pool's share of all rows and a
    thousandth at least, each by its own hash: how many are drawn is left to
    chance, which rows is not."""
    if cfg.pool_size is None:
        raise ValueError("a sample needs a pool size")
    keyed = _with_pool_hash(df, cfg, features)
    total = keyed.count() if total is None else total
    every = 1 << HASH_BITS
    bound = every if total <= cfg.pool_size else max(every * cfg.pool_size // total, every // 1000)
    return keyed.filter(F.col("h_pool") < F.lit(bound))


def bernoulli_pool(
    df: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    features: Sequence[str] = SCALED_FEATURES,
    total: int | None = None,
) -> DataFrame:
    """The published method's pool: a Bernoulli sample, of which at most
    ``cfg.pool_size`` rows stay (the smallest hashes, where it takes the first
    that come)."""
    drawn = cut(bernoulli_sample(df, cfg, features, total), "bernoulli_sample")
    return drawn.orderBy("h_pool", "row_key").limit(cfg.pool_size)


def draw_factors(cfg: DetectConfig) -> list[tuple[int, int]]:
    """(a, b) of each tree: its draw value is (a h + b) mod (2^31 - 1)."""
    return [
        (1 + hash_int_py(cfg.seed, "tree-a", t) % (DRAW_PRIME - 1), hash_int_py(cfg.seed, "tree-b", t) % DRAW_PRIME)
        for t in range(cfg.num_trees)
    ]


def drawn_udf(factors: Sequence[tuple[int, int]], bound: int):
    """Arrow UDF: whether any tree's draw value of a row hash is under ``bound``."""

    @F.pandas_udf("boolean")
    def drawn(hashes: pd.Series) -> pd.Series:
        # an absent hash has no draw value
        return pd.Series(any_draw_below(hashes.to_numpy(dtype=np.int64, na_value=0), factors, bound) & hashes.notna().to_numpy())

    return drawn


def any_draw_below(hashes: np.ndarray, factors: Sequence[tuple[int, int]], bound: int) -> np.ndarray:
    """Whether (a h + b) mod (2^31 - 1) < ``bound`` for any (a, b), by rows.
    The remainder is taken by folding: 2^31 is 1 modulo 2^31 - 1."""
    h, hit = hashes % DRAW_PRIME, np.zeros(len(hashes), dtype=bool)
    for a, b in factors:
        v = h * a
        v += b
        for _ in range(2):
            high = v >> 31
            v &= DRAW_PRIME
            v += high
        # at most 2^31 now: remainders 0 and 1 may read 2^31 - 1 and 2^31
        hit |= (v < bound) | (v >= DRAW_PRIME) & (v < DRAW_PRIME + bound)
    return hit


def tree_samples(
    rows: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    features: Sequence[str] = SCALED_FEATURES,
    total: int | None = None,
) -> DataFrame:
    """Per-tree subsample without replacement: the ``max_samples`` rows with
    the smallest (draw value, row key) of each tree.

    A row's draw values come from its hash by one multiplication a tree, and
    only (row, tree) pairs under a bound leave the scan: expected are
    ``DRAW_MARGIN`` times ``max_samples`` a tree.  An Arrow UDF on the hash
    tells which rows have one; only theirs are written out per tree.  Should a tree get too few,
    the bound is raised for all and the scan repeated.  ``rows`` should be
    cheap to read (a cut).
    """
    rows = _with_pool_hash(rows, cfg, features)
    total = rows.count() if total is None else total
    if total == 0:
        raise ValueError("no rows to train on")
    wanted = min(cfg.max_samples, total)
    bound = min(DRAW_PRIME, math.ceil(DRAW_PRIME * DRAW_MARGIN * cfg.max_samples / total))
    ship_package(rows.sparkSession)
    h = F.col("h_pool") % DRAW_PRIME
    draws = F.array(
        *[
            F.struct(F.lit(t).alias("tree_id"), ((h * a + b) % DRAW_PRIME).alias("h_tree"))
            for t, (a, b) in enumerate(draw_factors(cfg))
        ]
    )
    while True:
        limit = F.lit(bound)
        low = F.filter(draws, lambda d: d["h_tree"] < limit)  # noqa: B023 (used at once)
        drawn = cut(
            rows.filter(drawn_udf(draw_factors(cfg), bound)("h_pool"))
            .select("row_key", *features, F.explode(low).alias("d"))
            .select("d.tree_id", "row_key", "d.h_tree", *features),
            "drawn",
        )
        counts = drawn.groupBy("tree_id").count().agg(F.count(F.lit(1)), F.min("count")).first()
        if bound == DRAW_PRIME or (counts[0] == cfg.num_trees and counts[1] >= wanted):
            break
        bound = min(DRAW_PRIME, 4 * bound)
    w = Window.partitionBy("tree_id").orderBy("h_tree", "row_key")
    return drawn.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= cfg.max_samples).drop("rn")


def fit_forest(
    samples: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    features: Sequence[str] = SCALED_FEATURES,
) -> DataFrame:
    """Node table of the forest, one ``applyInPandas`` group per tree."""
    feats = list(features)
    seed, depth = cfg.seed, cfg.max_depth
    ship_package(samples.sparkSession)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        return grow_trees_pdf(pdf, feats, seed, depth)

    return samples.select("tree_id", *feats).groupBy("tree_id").applyInPandas(grow, NODES)


def fit(
    featured: DataFrame,
    cfg: DetectConfig = DetectConfig(),
    features: Sequence[str] = SCALED_FEATURES,
    total: int | None = None,
) -> pd.DataFrame:
    """Grow the forest and return its node table (bounded: at most
    num_trees x (2^(max_depth+1) - 1) rows) as a local frame.  ``total``: the
    number of rows, if known (else counted)."""
    total = featured.count() if total is None else total
    n_pool = total if cfg.pool_size is None else min(total, cfg.pool_size)
    rows = featured
    if cfg.pool_size is not None and cfg.pool_mode == "bernoulli":
        rows, seen = cut_observed(bernoulli_pool(featured, cfg, features, total), "pool", rows=F.count(F.lit(1)))
        n_pool = seen["rows"]
    if n_pool < cfg.min_pool_rows:
        raise ValueError(
            f"training pool has {n_pool} rows; at least {cfg.min_pool_rows} are needed"
        )
    if cfg.pool_mode == "smallest" and n_pool < total:
        rows = cut(training_pool(featured, cfg, features, total), "pool")
    nodes = fit_forest(tree_samples(rows, cfg, features, n_pool), cfg, features)
    return nodes.toPandas()


def score_units_udf(arrays_bc, n_features: int, counter=None):
    """Arrow iterator UDF: summed leaf path units over all trees.

    ``counter``: optional accumulator receiving the number of rows scored
    (to measure how often the scorer runs).
    """

    @F.pandas_udf("long")
    def path_units(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        forest: ForestArrays = arrays_bc.value
        for cols in batches:
            x = np.column_stack([c.to_numpy(dtype=np.float64, na_value=0.0) for c in cols])
            if counter is not None:
                counter.add(len(x))
            yield pd.Series(forest.path_units(np.nan_to_num(x, nan=0.0)))

    return path_units


def score_expr(units: str, cfg: DetectConfig) -> F.Column:
    """2^(-average path / c(max_samples)); higher means more anomalous."""
    norm = c_factor_py(cfg.max_samples)
    avg = F.col(units).cast("double") / F.lit(float(PATH_UNIT)) / F.lit(float(cfg.num_trees))
    if norm == 0:
        return F.lit(0.0)
    return F.pow(F.lit(2.0), -avg / F.lit(norm))


def score_forest(
    df: DataFrame,
    nodes: pd.DataFrame,
    cfg: DetectConfig = DetectConfig(),
    features: Sequence[str] = SCALED_FEATURES,
    counter=None,
) -> DataFrame:
    """Add ``iforest_path_units`` and ``iforest_score``."""
    ship_package(df.sparkSession)
    arrays = ForestArrays(nodes, cfg.num_trees, cfg.max_depth)
    bc = df.sparkSession.sparkContext.broadcast(arrays)
    udf = score_units_udf(bc, len(features), counter)
    out = df.withColumn("iforest_path_units", udf(*[F.col(c) for c in features]))
    return out.withColumn("iforest_score", score_expr("iforest_path_units", cfg))


def top_by_score(df: DataFrame, n: int = 20, tie_keys: Sequence[str] = HOURLY_KEYS) -> DataFrame:
    """The n rows of highest forest score (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(F.col("iforest_score").desc(), *[F.col(k).asc_nulls_first() for k in tie_keys]).limit(n)


def threshold_rank(n: int, contamination: float) -> int:
    """1-based ascending rank of the (1 - contamination) discrete quantile:
    the first value whose cumulative share reaches the level."""
    level = 1 - Fraction(str(contamination))
    return max(1, min(n, math.ceil(level * n)))


def contamination_threshold(
    scored: DataFrame, cfg: DetectConfig = DetectConfig(), total: int | None = None
) -> tuple[float, int | None]:
    """(score threshold, path-unit threshold or None in approx mode).

    ``scored`` should be a cut: the scores are read, not recomputed.
    ``total``: its number of rows, if known.
    """
    if cfg.threshold_mode == "sketch":
        units = sketch_threshold(score_sketches(scored), cfg)
        return score_of_units(units, cfg), units
    if cfg.threshold_mode == "approx":
        q = scored.stat.approxQuantile("iforest_score", [1.0 - cfg.contamination], cfg.quantile_rel_error)
        return float(q[0]), None
    n = scored.count() if total is None else total
    if n == 0:
        raise ValueError("no scored rows")
    r = threshold_rank(n, cfg.contamination)
    # Score falls as path units grow: ascending-score rank r is
    # ascending-units rank n - r + 1.
    # Upper bound of a row's summed path: every tree ends at depth
    # max_depth in a leaf of at most max_samples rows.
    bound = cfg.num_trees * int(math.ceil((cfg.max_depth + c_factor_py(cfg.max_samples)) * PATH_UNIT + 1))
    units = value_at_rank(scored, "iforest_path_units", n - r + 1, bound.bit_length())
    return score_of_units(units, cfg), units


def score_of_units(units: int, cfg: DetectConfig) -> float:
    return 2.0 ** (-(units / PATH_UNIT / cfg.num_trees) / c_factor_py(cfg.max_samples))


def score_sketches(scored: DataFrame, by: Sequence[str] = ("month",)) -> DataFrame:
    """Per month (or other key): a KLL sketch of the path units and its number
    of rows.  Sketches are kept as a small table; a new month adds one row and
    old scores are not read again."""
    keys = [c for c in by if c in scored.columns]
    units = F.col("iforest_path_units")
    return scored.groupBy(*keys).agg(
        F.kll_sketch_agg_bigint(units, F.lit(SKETCH_K)).alias("sketch"), F.count(units).alias("rows")
    )


def sketch_threshold(sketches: DataFrame, cfg: DetectConfig = DetectConfig()) -> int:
    """Path units at the contamination rank, from the merged sketches.  The
    rank is off by at most ``SKETCH_RANK_ERROR`` of the rows (with 99 %
    confidence, KLL's bound for ``SKETCH_K``)."""
    n = sketches.agg(F.sum("rows")).first()[0]
    if not n:
        raise ValueError("no scored rows")
    share = F.lit((n - threshold_rank(n, cfg.contamination) + 1) / n)
    merged = sketches.agg(F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_K)).alias("s"))
    return int(merged.select(F.kll_sketch_get_quantile_bigint("s", share)).first()[0])


def flag_ge(scored: DataFrame, threshold: tuple[float, int | None]) -> DataFrame:
    """``iforest_anomaly`` = 1 when score >= threshold (ties flagged)."""
    score_thr, units_thr = threshold
    if units_thr is not None:
        hit = F.col("iforest_path_units") <= F.lit(units_thr)
    else:
        hit = F.col("iforest_score") >= F.lit(score_thr)
    flag = F.when(hit, F.lit(1)).otherwise(F.lit(0))
    return scored.withColumns({"iforest_anomaly": flag, "iforest_prediction": flag})
