"""Write the physical plans of representative queries to PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from tessera.operators import encode, evaluate, models, split  # noqa: E402
from tessera.plans import catalog  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources import fixtures as fx  # noqa: E402

NOTES = {
    "holdout_split": "key-hash split: one codegen projection over a one-column scan, no sort, no shuffle",
    "impute_mean": "means as literals in one projection (one codegen stage); only the used columns are read",
    "feature_profile": "all columns' count/mean/sd in one partial + final aggregate, unpivoted by inline",
    "outlier_filter_sequential": "all sequential bounds folded into one filter over the scan",
    "document_quality": "join left to the planner: AQE broadcasts the label side only under the size threshold",
    "metrics_by_split": "train and test accuracy/F1 from one confusion aggregate (partial aggregation map-side)",
    "label_frequency_index": "label counts with map-side combine, index from the fitted label list literal",
}


def plans(spark, sf):
    f = fx.orders_flags(spark, sf)
    ds = split.add_split(encode.assemble(encode.index_label(f.df), f.features), [f.key], 42)
    model = models.fit_tree(ds.where("split = 'train'"), seed=42)
    return {
        "holdout_split": catalog.holdout_split(spark, sf),
        "impute_mean": catalog.impute_mean(spark, sf),
        "feature_profile": catalog.feature_profile(spark, sf),
        "outlier_filter_sequential": catalog.outlier_filter_sequential(spark, sf),
        "document_quality": fx.document_quality(spark, sf).df,
        "metrics_by_split": evaluate.metrics(model.transform(ds), by=["split"]),
        "label_frequency_index": catalog.label_frequency_index(spark, sf),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    out = ["# Physical plans of representative queries", "",
           f"Generated by `tools/explain_plans.py` on `{sf}` (local[8], AQE on). Plans before AQE's runtime "
           "re-optimisation (`isFinalPlan=false`).", ""]
    for name, df in plans(spark, sf).items():
        out += [f"## {name}", "", NOTES[name], "", "```",
                df._jdf.queryExecution().executedPlan().toString().rstrip(), "```", ""]
    with open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
