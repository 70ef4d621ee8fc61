"""Column-expression helpers: key hashing for splits and folds, vectors."""

from tessera.functions.hashing import fold_index, hash_unit, split_label
from tessera.functions.vectors import explode_vector, vector_sum

__all__ = ["fold_index", "hash_unit", "split_label", "explode_vector", "vector_sum"]
