"""Semi-structured rows: JSON text held as variants, with a schema that the data give.

A variant is parsed once and read by path; a field that is missing or cannot be cast is NULL (1.5 read as a long is 1), and text that is no JSON is NULL as a whole and
counted as bad. The schema of all rows is an aggregate of the rows' schemas, merged like any partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse(df: DataFrame, col: str, out: str = "v") -> DataFrame:
    """``df`` with the variant ``out`` (NULL for NULL and for bad text) and ``<out>_bad``."""
    v = F.try_parse_json(col)
    return df.withColumn(out, v).withColumn(f"{out}_bad", F.col(col).isNotNull() & F.col(out).isNull())


def fields(df: DataFrame, paths: dict[str, tuple[str, str]], col: str = "v") -> DataFrame:
    """``df`` with a column for each name: (path, type); NULL where the value is missing or does not fit."""
    return df.withColumns({name: F.try_variant_get(col, path, kind) for name, (path, kind) in paths.items()})


def schema_of(df: DataFrame, col: str = "v") -> DataFrame:
    """One row: the merged schema of all variants."""
    return df.agg(F.schema_of_variant_agg(col).alias("schema"))


def explode_list(df: DataFrame, keep: list[str], path: str, kind: str, col: str = "v") -> DataFrame:
    """(keep..., pos, item): the items of a list in the variant, in order; rows without the list give none."""
    items = F.try_variant_get(col, path, f"array<{kind}>")
    return df.select(*keep, F.posexplode(items).alias("pos", "item"))
