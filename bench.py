"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times (default 1); the median is reported. Results
are consumed in full by a no-op write.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "flagship_label_clusters", "cell_qc", "gene_qc", "top_gene_share", "filter_cells_then_genes", "downsample_per_sample",
    "normalize_and_log", "variable_genes_by_batch", "ulm_scores", "mlm_scores", "de_wilcoxon", "de_ttest",
    "score_ttest", "rank_sum_by_cluster", "fdr_correction", "chi_square", "marker_dot_table", "spatial_radius_interval",
    "spatial_knn", "graph_spectral", "neighborhood_composition", "cells_per_window", "kmeans_sweep", "silhouette",
    "expression_knn", "principal_components",
]


def main() -> None:
    from cellframe.session import local_session
    from checks import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds = {}
    for name in names:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
