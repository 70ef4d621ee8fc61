"""Deterministic per-row randomness from a key hash.

``randomSplit`` and ``CrossValidator`` draw a per-row random number that
depends on the partitioning of the input, so the same seed gives different
splits after a repartition, a lost executor or a changed file layout. These
expressions derive the number from the row's key instead: the same key and
seed always land in the same split or fold, on any cluster, and the value is
reproducible in plain SQL:

    conv(substr(md5(concat(seed[, ':', salt], part...)), 1, 8), 16, 10) / 2^32

where the part of a key value is ``:<length>:<value>``, and ``:-`` for NULL, so
NULLs, separators inside values and the borders of parts are all told apart.

Everything here is a JVM-side Column expression (inside whole-stage codegen);
no shuffle and no Python worker is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def key_text(keys: Sequence[str | Column]) -> Column:
    """The key values as one string that tells NULLs, separators and borders apart."""
    parts = []
    for k in keys:
        text = (F.col(k) if isinstance(k, str) else k).cast("string")
        size = F.length(text).cast("string")
        parts.append(F.coalesce(F.concat(F.lit(":"), size, F.lit(":"), text), F.lit(":-")))
    return F.concat(*parts)


def _key_string(seed: int, keys: Sequence[str | Column], salt: str | None) -> Column:
    return F.concat(F.lit(str(seed) if salt is None else f"{seed}:{salt}"), key_text(keys))


def hash_unit(seed: int, keys: Sequence[str | Column], salt: str | None = None) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of md5 of the seed, the salt and the key."""
    hex8 = F.substring(F.md5(_key_string(seed, keys, salt)), 1, 8)
    return F.conv(hex8, 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def split_label(seed: int, keys: Sequence[str | Column], train_fraction: float = 0.7,
                salt: str | None = None, train: str = "train", test: str = "test") -> Column:
    """'train' when hash_unit < train_fraction, else 'test'."""
    return F.when(hash_unit(seed, keys, salt) < F.lit(train_fraction), F.lit(train)).otherwise(F.lit(test))


def fold_index(seed: int, keys: Sequence[str | Column], num_folds: int, salt: str = "fold") -> Column:
    """Fold number 0..num_folds-1 (int), equal-width cut of hash_unit."""
    return F.floor(hash_unit(seed, keys, salt) * F.lit(float(num_folds))).cast("int")
