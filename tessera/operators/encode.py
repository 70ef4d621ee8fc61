"""Label and feature encoders (pyspark.ml stages) and their table views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (StandardScaler, StandardScalerModel, StringIndexer, StringIndexerModel,
                                VectorAssembler)
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.select import ChiSqTopK


def fit_label_index(df: DataFrame, label_col: str = "label", output_col: str = "label_indexed",
                    handle_invalid: str = "error") -> StringIndexerModel:
    """Label -> 0.0, 1.0, ... by descending frequency, ties by label ascending."""
    return StringIndexer(inputCol=label_col, outputCol=output_col, handleInvalid=handle_invalid,
                         stringOrderType="frequencyDesc").fit(df)


def index_label(df: DataFrame, label_col: str = "label", output_col: str = "label_indexed") -> DataFrame:
    return fit_label_index(df, label_col, output_col).transform(df)


def label_frequency_index(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``(label, n, label_indexed)``: the indexer's mapping with label counts, from one grouped
    count. The numbering window runs over the class rows, so this is meant for class labels."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).alias("label")).agg(
        F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("n").desc(), "label")
    return counts.select("label", "n", (F.row_number().over(order) - 1).cast("double").alias("label_indexed"))


def assemble(df: DataFrame, cols: Sequence[str], output_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=output_col, handleInvalid=handle_invalid).transform(df)


def unit_std_scaler(input_col: str = "features", output_col: str = "scaled_features") -> StandardScaler:
    """Divide by the sample standard deviation, no centring (keeps sparsity)."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withStd=True, withMean=False)


def fit_scaler(df: DataFrame, input_col: str = "features", output_col: str = "scaled_features") -> StandardScalerModel:
    return unit_std_scaler(input_col, output_col).fit(df)


def chi2_scores(df: DataFrame, features_col: str = "features", label_col: str = "label_indexed",
                names: Sequence[str] | None = None) -> DataFrame:
    """Pearson chi-square independence test of every feature against the label.

    Returns ``(feature_index, [feature,] statistic, dof, p_value)``; the
    contingency counts are aggregated on the executors.
    """
    res = ChiSquareTest.test(df, features_col, label_col, flatten=True)
    out = res.select(
        F.col("featureIndex").alias("feature_index"),
        F.col("statistic"),
        F.col("degreesOfFreedom").cast("bigint").alias("dof"),
        F.col("pValue").alias("p_value"),
    )
    if names is not None:
        name_arr = F.array(*[F.lit(n) for n in names])
        out = out.withColumn("feature", F.element_at(name_arr, F.col("feature_index") + 1))
    return out


def chi2_selector(k: int, features_col: str = "features", output_col: str = "selected_features",
                  label_col: str = "label_indexed", bins: int | None = None) -> ChiSqTopK:
    """Top-k features by chi-square; with ``bins`` every slot is first cut into that many
    equal-width bins (for continuous columns), without it every distinct value is a category."""
    if k is None or k < 1:
        raise ValueError("chi-square selection needs the number of features to keep (k >= 1)")
    return ChiSqTopK(numTopFeatures=k, featuresCol=features_col, outputCol=output_col, labelCol=label_col, bins=bins or 0)


def chi2_select_topk(df: DataFrame, cols: Sequence[str], k: int, label_col: str = "label_indexed",
                     bins: int | None = None) -> list[str]:
    """Names of the k columns the chi-square selector keeps."""
    assembled = assemble(df, cols, "__chi2_features")
    model = chi2_selector(k, "__chi2_features", "__chi2_selected", label_col, bins).fit(assembled)
    return [cols[i] for i in model.selectedFeatures]
