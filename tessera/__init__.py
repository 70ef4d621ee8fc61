"""tessera: tabular classification analytics on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``DataFrame ->
fitted model``) function built from ``pyspark.sql`` and ``pyspark.ml``.
Statistics, splits, folds and experiment results are ordinary tables, so
they compose with ``df.transform`` and can be checked with SQL.
"""

from tessera.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
