"""Scoring and evaluating with fitted models on Structured Streaming input.

The classifier programs fit everything in batch; what carries over to a
stream is the *fitted* state: the imputation means, the sequential filter's
bounds, the label index and the model. All of them are projections with
literals or ``Model.transform``, which Structured Streaming runs unchanged,
so a stream is cleaned and scored with the same plan as a batch frame.
Running metrics are a streaming aggregate of confusion counts (state = one
row per (label, prediction) pair), from which the batch formulas give
accuracy and weighted F1 for any micro-batch snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame

from tessera.operators import clean, encode, evaluate


@dataclass
class FittedPreparation:
    """Batch-fitted cleaning state, reusable on batch or streaming frames."""
    features: list[str]
    means: dict[str, float | None]
    bounds: dict[str, tuple[float, float]]
    indexer: StringIndexerModel | None = None

    def apply(self, df: DataFrame, assemble: bool = True) -> DataFrame:
        out = clean.apply_means(df, self.means)
        if self.bounds:
            out = out.where(clean.bounds_predicate(self.bounds))
        if self.indexer is not None:
            out = self.indexer.transform(out)
        return encode.assemble(out, self.features) if assemble else out


def fit_preparation(df: DataFrame, features: Sequence[str], label_col: str | None = "label",
                    k: float = 3.0) -> FittedPreparation:
    """Fit means, sequential k-sigma bounds and the label index on a batch frame."""
    features = list(features)
    means = clean.fit_means(df, features)
    steps = clean.sequential_bounds(clean.apply_means(df, means), features, k)
    bounds = {s["column"]: (s["lo"], s["hi"]) for s in steps if s["applied"]}
    indexer = encode.fit_label_index(df, label_col, handle_invalid="keep") if label_col else None
    return FittedPreparation(features, means, bounds, indexer)


def score_stream(stream: DataFrame, prep: FittedPreparation, model: Model) -> DataFrame:
    """Clean, encode and predict a streaming (or batch) frame."""
    return model.transform(prep.apply(stream))


def running_confusion(scored: DataFrame, label_col: str = "label_indexed") -> DataFrame:
    """Streaming confusion counts (use output mode 'complete' or 'update')."""
    return evaluate.confusion(scored, label_col, "prediction")


def metrics_snapshot(confusion_table: DataFrame) -> DataFrame:
    """Accuracy and weighted F1 from a (batch) snapshot of confusion counts."""
    return evaluate.metrics_from_confusion(confusion_table)
