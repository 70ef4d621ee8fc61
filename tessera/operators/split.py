"""Hold-out splits and k-fold assignment as columns.

A split is a ``split`` column ('train' / 'test') computed from a key hash,
not a pair of sampled frames: it needs no sort or shuffle, it is the same on
every re-computation (executor loss, repartitioning, a different file
layout), and train and test of one seed are read in one scan. Spark's
``randomSplit`` (Bernoulli per row after a per-partition sort) stays
available for data without a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import fold_index, hash_unit, split_label


def add_split(df: DataFrame, keys: Sequence[str], seed: int, train_fraction: float = 0.7,
              col: str = "split", salt: str | None = None) -> DataFrame:
    return df.withColumn(col, split_label(seed, keys, train_fraction, salt))


def random_split(df: DataFrame, seed: int, weights: Sequence[float] = (0.7, 0.3)) -> list[DataFrame]:
    """Spark's Bernoulli split; depends on the partitioning of ``df``."""
    return df.randomSplit(list(weights), seed=seed)


def add_folds(df: DataFrame, keys: Sequence[str], seed: int, num_folds: int = 5, col: str = "fold") -> DataFrame:
    """Fold number 0..num_folds-1 per row (usable as ``CrossValidator.foldCol``)."""
    return df.withColumn(col, fold_index(seed, keys, num_folds))


def add_nested_split(df: DataFrame, keys: Sequence[str], seed: int, train_fraction: float = 0.7,
                     inner_fraction: float = 0.7, col: str = "part") -> DataFrame:
    """Split, then split the training part again with an independent hash
    ('train_train', 'train_test', 'test')."""
    outer = hash_unit(seed, keys) < F.lit(train_fraction)
    inner = hash_unit(seed, keys, salt="inner") < F.lit(inner_fraction)
    return df.withColumn(
        col,
        F.when(~outer, F.lit("test")).when(inner, F.lit("train_train")).otherwise(F.lit("train_test")),
    )
