"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "describe_numeric",
    "null_counts",
    "duplicate_rows",
    "distinct_counts",
    "correlation_pearson",
    "correlation_spearman",
    "outliers_iqr_clip",
    "outliers_zscore",
    "impute_grouped_median",
    "impute_knn",
    "derived_features",
    "encode_target",
    "scale_standard",
    "scale_robust",
    "mutual_information",
    "geo_clusters",
    "gram_by_fold",
    "fit_ridge",
    "cv_four_models",
    "grid_search_all",
    "learning_curve",
    "metrics_all",
    "fold_balanced",
    "histogram_features",
    "feature_flow",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    from gramlark.catalog import QUERIES
    from gramlark.session import local_session, release_staged

    spark = local_session("bench", cpus)
    QUERIES["null_counts"].run(spark, sf_dir).collect()  # start the JVM's machinery
    times = {}
    for name in only or HEADLINE:
        start = time.time()
        # every row is computed, none is brought to the driver
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        release_staged(spark)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
