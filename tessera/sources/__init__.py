"""Scans, sinks and test tables."""

from tessera.sources.csv import labelled_schema, land_as_parquet, numbered, read_typed_csv, write_csv
from tessera.sources.tables import table

__all__ = ["labelled_schema", "numbered", "land_as_parquet", "read_typed_csv", "write_csv", "table"]
