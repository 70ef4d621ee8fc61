"""Delimited-text scans and sinks.

The scan is schema-on-read: the caller fixes the schema (:func:`labelled_schema`
of its column names, or of :func:`numbered` ones for files without a header),
nothing is inferred, and the default PERMISSIVE mode turns unparsable cells
and missing trailing fields into NULL. CSV is a row format without predicate
pushdown or a vectorised reader, so callers that scan the same text more than
once should land it as Parquet first (see :func:`land_as_parquet`).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def labelled_schema(numeric: Iterable[str], label: str = "label") -> StructType:
    """Schema of a labelled table: the given double columns in order, then a string label."""
    schema = StructType()
    for name in numeric:
        schema = schema.add(name, "double")
    if not len(schema):
        raise ValueError("a labelled table needs at least one numeric column")
    return schema.add(label, "string")


def numbered(count: int, stem: str = "feature_") -> tuple[str, ...]:
    """Column names of a file without a header: the stem and the column's position from 1."""
    return tuple(map(f"{stem}{{}}".format, range(1, count + 1)))


def read_typed_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
                   header: bool = False, mode: str = "PERMISSIVE",
                   corrupt_col: str | None = None) -> DataFrame:
    """Headerless (by default) delimited scan with a fixed schema.

    ``mode='PERMISSIVE'`` keeps every line; a cell that does not parse as its
    type becomes NULL. With ``corrupt_col`` the raw text of such lines is kept
    in an extra string column (added to the schema here).
    """
    reader = spark.read.format("csv").option("sep", sep).option("header", str(header).lower())
    reader = reader.option("mode", mode)
    if corrupt_col is not None:
        schema = StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(schema).load(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              single_file: bool = False) -> str:
    """Directory sink. ``single_file`` coalesces to one task: only for small
    result tables (tens of rows), never for data-sized frames. Errors raise."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", str(header).lower()).csv(path)
    return path


def land_as_parquet(df: DataFrame, path: str, row_id: str | None = None) -> DataFrame:
    """Write once as Parquet and return a scan of it: later passes get column
    pruning, predicate pushdown and the vectorised reader, and the lineage to
    the text scan is cut (the copy sits in shared storage, so it survives
    executor loss). With ``row_id`` every row gets a number of its own, which is
    fixed from then on because it is stored."""
    out = df if row_id is None else df.withColumn(row_id, F.monotonically_increasing_id())
    out.write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)
