"""Time the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set below).

Each query is forced to completion through the ``noop`` sink: the whole
result is computed, nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans.catalog import QUERIES  # noqa: E402
from quarry.session import get_session  # noqa: E402

HEADLINE = [
    "chronological_split", "quality_summary", "null_counts", "column_roles", "moments",
    "iqr_outliers", "box_stats", "value_counts_top", "crosstab_norm", "corr_matrix",
    "target_corr_top8", "histogram", "scatter_bins", "trend_monthly", "group_avg",
    "feature_completion", "coerce_batch", "domain_check", "regression_metrics",
    "circular_metrics", "classification_report", "roc_curve", "roc_auc", "average_precision",
    "auc_ovr", "tournament", "batch_score", "perm_importance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = get_session(f"local[{cpus}]", app_name="quarry-bench", conf={
        "spark.sql.shuffle.partitions": str(max(8, int(cpus))),
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    })
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    extra = {}
    if "tournament" in times:
        extra["training_wall_s"] = times["tournament"]
    if "batch_score" in times and "tournament" in names[:names.index("batch_score")]:
        # models are fitted by the earlier tournament query, so this times scoring only;
        # scored rows = the test split of lineitem: n - int(n * 0.85)
        n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
        test_rows = n - int(n * 0.85)
        extra["batch_score_rows"] = test_rows
        extra["batch_score_rows_per_s"] = round(test_rows / times["batch_score"], 1)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "vs_baseline": extra,
    }))


if __name__ == "__main__":
    main()
