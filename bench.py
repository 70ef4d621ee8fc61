"""Benchmark harness: runs the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma list, default all headline queries).
Every query is forced to completion with the no-op sink (full evaluation,
no collect to the driver); the time of each is wall clock in seconds.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.operators import encode, models  # noqa: E402
from tessera.plans import catalog, programs  # noqa: E402
from tessera.session import build_session, shared_dir  # noqa: E402
from tessera.sources import fixtures  # noqa: E402
from tessera.sources.csv import write_csv  # noqa: E402



def lineitem_logistic(spark, sf_dir):
    """Multinomial LR (10 iterations) on three columns of lineitem."""
    f = fixtures.lineitem_encode(spark, sf_dir)
    ds = encode.assemble(encode.index_label(f.df), f.features)
    return models.logistic_coefficients(spark, models.fit_logistic(ds, maxIter=10), f.features)


def csv_program_lineitem(spark, sf_dir):
    """lineitem written as headerless text, parsed once, landed, cleaned, two seeded trees."""
    f = fixtures.lineitem_encode(spark, sf_dir)
    path = shared_dir(spark, "bench_csv")
    write_csv(f.df.select(*f.features, f.label), path, header=False)
    return programs.tree_experiment(spark, None, seeds=[42, 123], source=programs.csv_source(spark, path, 4))


HEADLINE = {
    # the three programs end to end
    "tree_experiment": programs.tree_experiment,
    "baseline_comparison": programs.baseline_comparison,
    "tuned_logistic_experiment": programs.tuned_logistic_experiment,
    "selected_logistic_experiment": programs.selected_logistic_experiment,
    # operators over the larger tables
    "feature_profile": catalog.feature_profile,
    "impute_mean": catalog.impute_mean,
    "outlier_filter_sequential": catalog.outlier_filter_sequential,
    "clean_and_assemble": catalog.clean_and_assemble,
    "csv_typed_scan": catalog.csv_typed_scan,
    "scale_unit_std": catalog.scale_unit_std,
    "chi2_scores": catalog.chi2_scores,
    "chi2_select_binned": catalog.chi2_select_binned,
    "decision_tree_fit": catalog.decision_tree_fit,
    "lineitem_logistic": lineitem_logistic,
    "csv_program_lineitem": csv_program_lineitem,
    "label_frequency_index": catalog.label_frequency_index,
    "decision_tree_holdout": catalog.decision_tree_holdout,
    "logistic_holdout": catalog.logistic_holdout,
    "repeated_holdout": catalog.repeated_holdout,
    "cv_grid_metrics": catalog.cv_grid_metrics,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus), app_name="tessera-bench")
    # untimed JVM warm-up (class loading, JIT) on generated rows, so the first
    # measured query is not charged for it; no measured query or table is touched
    for _ in range(3):
        spark.range(100_000).selectExpr("sum(id)", "avg(id)", "stddev_samp(id)").collect()
    times: dict[str, float] = {}
    for name in chosen:
        t0 = time.perf_counter()
        HEADLINE[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
