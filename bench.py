"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_QUERIES (comma-separated,
or `all`) other queries than the headline ones. Results go to the noop sink, so every column
of every row is computed. One small query warms the session up before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from veinwork.plans.catalog import REGISTERED  # noqa: E402
from veinwork.session import local_session  # noqa: E402

HEADLINE = (
    "coerce_schema", "coercion_report", "categorical_summary", "describe_numeric", "histogram",
    "duplicate_count", "missing_report", "dedup_keep_first", "validation_counts", "validity_filter",
    "cleaning_report", "imputation_log", "impute_median", "temporal_features", "quantile_bins",
    "stratified_sample", "train_val_test_split", "kfold_assign", "label_encode", "feature_matrix",
    "standard_scale", "association_rules", "correlation_matrix", "cramers_v", "gini_split",
    "tree_fit_predict", "tree_cross_validation", "kmeans_fit", "geo_regions", "silhouette",
    "davies_bouldin", "centroid_outliers", "cluster_profile", "knn", "lof_outliers",
    "outlier_consensus", "outlier_screening", "outlier_screening_sample", "outlier_screening_approximate",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTERED) if asked == "all" else asked.split(",") if asked else list(HEADLINE)
    spark = local_session(cpus)
    REGISTERED["table_shape"](spark, folder).collect()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        REGISTERED[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
