"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.

1. ``toxicity`` drops the documents that the string-kernel machine rejects;
2. ``ngram_join`` keeps one document of each near-duplicate class;
3. ``decontaminate`` drops the documents that are contaminated by the benchmark;
4. ``secrets`` masks the secrets it finds in the texts and keeps every document;
5. ``mix`` returns what each remaining document gives to the mix of the sources.

The stages include trained models and joins that SQL cannot express, so there is no oracle
SQL; the tests compare the result with a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontam, mixing, ngram_join, secrets, toxicity
from tessera.llm.components import collecting, discard, release, written
from tessera.llm.registry import find_package, read

ORACLE_SQL = None


def begin(spark: SparkSession) -> None:
    """What the stage before has left in shuffle files and plans is dropped."""
    find_package(spark)
    release(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    begin(spark)
    machine = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, machine)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    begin(spark)
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    begin(spark)
    return decontam.keep_uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    begin(spark)
    return secrets.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    begin(spark)
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written to the shared folder and reread. What a stage wrote for itself, and the
    result of the stage before, are removed as soon as its own result is written."""
    docs, before = read(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with collecting(before):
            out = stage(spark, docs, sf_dir)
        docs = written(out, f"stage-{name}")
        for table in before:
            discard(table)
        before = [docs]
    return docs
