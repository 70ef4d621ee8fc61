"""Vector column helpers (JVM side, no Python UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_vector(df: DataFrame, vector_col: str, keep: Sequence[str],
                   names: Sequence[str] | None = None, pos_col: str = "pos",
                   value_col: str = "value", name_col: str = "feature") -> DataFrame:
    """Long form ``keep..., pos, [feature,] value`` of an ML vector column.

    ``names`` (position -> feature name) is a literal array, so the lookup
    stays inside codegen; its size is the vector width, not the row count.
    """
    arr = vector_to_array(F.col(vector_col), dtype="float64")
    out = df.select(*keep, F.posexplode(arr).alias(pos_col, value_col))
    if names is not None:
        name_arr = F.array(*[F.lit(n) for n in names])
        out = out.withColumn(name_col, F.element_at(name_arr, F.col(pos_col) + 1))
    return out


def vector_sum(vector_col: str) -> "F.Column":
    """Sum of the elements of a vector (per row)."""
    arr = vector_to_array(F.col(vector_col), dtype="float64")
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)

