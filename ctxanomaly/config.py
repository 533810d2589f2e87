"""Configuration of a detection run."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that must equal the original method for equal results:
# leave-one-out epsilon 1e-6, Euler's gamma 0.5772156649, z threshold 3.0
# (strict), minimum context size 5, contamination 0.011448, 50 trees,
# 256 samples per tree, published training pool of 50,000 rows, seed 42, at
# least 100 training rows, z-score sensitivity thresholds 2.0, 2.5, 3.0; report
# labels of the two methods, of the overlap categories and of the dataset
# summary properties.
EPS = 1e-6
EULER_GAMMA = 0.5772156649
SENSITIVITY_THRESHOLDS = (2.0, 2.5, 3.0)
METHOD_LABELS = {"zscore": "Z-score", "iforest": "Contextual Isolation Forest"}
OVERLAP_LABELS = ("Detected by Both", "Only Z-score", "Only Contextual Isolation Forest")
SUMMARY_PROPERTIES = ("Total rows", "Total columns", "Anomaly count", "Anomaly ratio")

PUBLISHED_POOL = 50_000
MAX_NODES = 10_000_000  # nodes of a forest, which every task holds

# Fixed output names: the hourly fact, its context and the ten features.
HOURLY_KEYS = ("datetime", "line", "line_name", "town")
CONTEXT_KEYS = ("line", "hour", "spark_dayofweek")
MEASURE = "total_passengers"

FEATURES = (
    "independent_context_residual",
    "abs_independent_context_residual",
    "relative_to_context_mean",
    "abs_relative_to_context_mean",
    "log_observed_expected_ratio",
    "abs_log_observed_expected_ratio",
    "passage_per_passenger_diff",
    "abs_passage_per_passenger_diff",
    "passenger_per_record_diff",
    "abs_passenger_per_record_diff",
)
#: Features are rounded to this many decimals: values that are equal but for
#: the last bits of their arithmetic are then equal, in any engine.
FEATURE_DIGITS = 10
SCALED_FEATURES = tuple(f"{c}_scaled" for c in FEATURES)


@dataclass(frozen=True)
class DetectConfig:
    """Parameters of :func:`ctxanomaly.plans.detect.detect`."""

    hourly_keys: tuple[str, ...] = HOURLY_KEYS
    context: tuple[str, ...] = CONTEXT_KEYS
    measure: str = MEASURE
    z_threshold: float = 3.0
    min_context_obs: int = 5
    contamination: float = 0.011448
    num_trees: int = 50
    max_samples: int = 256
    # Rows the trees are drawn from: all (None), or a hash-selected pool of at
    # most this many (the published method: PUBLISHED_POOL).
    pool_size: int | None = None
    seed: int = 42
    min_pool_rows: int = 100
    # "exact": value at rank ceil((1 - contamination) * N);
    # "approx": approxQuantile with ``quantile_rel_error`` (original tolerance).
    # "smallest" hashes, exactly that many, or "bernoulli": each row by
    # chance, then at most that many.
    pool_mode: str = "smallest"
    threshold_mode: str = "exact"
    quantile_rel_error: float = 0.001

    def __post_init__(self) -> None:
        if not 0.0 <= self.contamination < 1.0:
            raise ValueError("contamination must be in [0, 1)")
        if self.num_trees < 1 or self.max_samples < 2 or (self.pool_size is not None and self.pool_size < 1):
            raise ValueError("num_trees >= 1, max_samples >= 2 and pool_size >= 1 (or None) are required")
        if self.num_trees * 2 * self.max_samples > MAX_NODES:
            raise ValueError(f"num_trees x 2 max_samples must be at most {MAX_NODES}: the forest is broadcast")
        if self.min_context_obs < 2:
            raise ValueError("min_context_obs must be at least 2 (leave-one-out needs another row)")
        if self.pool_mode not in ("smallest", "bernoulli"):
            raise ValueError("pool_mode is 'smallest' or 'bernoulli'")
        if self.threshold_mode not in ("exact", "approx", "sketch"):
            raise ValueError("threshold_mode is 'exact', 'approx' or 'sketch'")
        if not self.context or not self.hourly_keys:
            raise ValueError("context and hourly_keys must not be empty")

    @property
    def max_depth(self) -> int:
        # ceil(log2(max_samples)), from the configured sample size.
        return max(1, (self.max_samples - 1).bit_length())
