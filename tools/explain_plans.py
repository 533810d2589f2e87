"""Print the formatted physical plans of the main stages at a given scale.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ctxanomaly.config import PUBLISHED_POOL, DetectConfig  # noqa: E402
from ctxanomaly.operators import reports as R  # noqa: E402
from ctxanomaly.operators.forest import score_forest, training_pool, tree_samples  # noqa: E402
from ctxanomaly.operators.zscore import zscore  # noqa: E402
from ctxanomaly.plans.detect import detect, featured_cells, hourly_cells  # noqa: E402
from ctxanomaly.sources import raw_lineitem  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    d = detect(raw_lineitem(spark, sf))
    plans = {
        "hourly cells (scan, pushdown, partial aggregate)": hourly_cells(raw_lineitem(spark, sf)),
        "z-score (context stats joined by Spark's own size check)": zscore(d.hourly, is_cut=True),
        "context features (second filter, profile join)": featured_cells(d.zscored, is_cut=True),
        "training pool of the published size": training_pool(d.featured, DetectConfig(pool_size=PUBLISHED_POOL)),
        "tree samples (drawn in the scan)": tree_samples(d.featured),
        "scoring (Arrow iterator UDF, map only)": score_forest(d.featured, d.nodes),
        "reports (one scan, grouping sets)": R.method_cube(d.scored),
    }
    for title, df in plans.items():
        print("=" * 100)
        print(title)
        print("=" * 100)
        df.explain("formatted")


if __name__ == "__main__":
    main()
