"""Chi-square top-k feature selection.

:class:`ChiSqTopK` scores every slot of a vector against the label by Pearson's test and
keeps the k best; the model is a ``VectorSlicer``. Two things are explicit, so the same
table gives the same answer at every size:

* **Binning** is an argument. With ``bins`` = 0 every distinct value is a category, which is
  Spark's own semantics (its test refuses a slot of more than 10,000 values). With
  ``bins`` > 0 every slot is cut into that many equal-width bins between its minimum and maximum, which come
  from one aggregate; missing values form a bin of their own.
* **Rank.** p-values underflow to 0 on large tables and then tie. Slots are ranked by p-value, then by the
  statistic normalised for its degrees of freedom (Wilson-Hilferty), then by index; scores that
  agree to 9 digits count as equal, so rounding noise decides nothing.
"""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal_score(statistic: float, dof: int) -> float:
    """Standard-normal score of a chi-square statistic (Wilson-Hilferty); grows without underflow."""
    if dof <= 0:
        return -math.inf
    c = 2.0 / (9.0 * dof)
    return ((statistic / dof) ** (1.0 / 3.0) - (1.0 - c)) / math.sqrt(c)


def _digits(x: float, n: int = 9) -> float:
    return float(f"{x:.{n - 1}e}") if math.isfinite(x) else x


def rank_slots(rows: list[tuple[int, float, int, float]]) -> list[int]:
    """Slot indices, best first, of (index, p_value, dof, statistic) rows."""
    return [i for i, *_ in sorted(rows, key=lambda r: (_digits(r[1]), -_digits(normal_score(r[3], r[2])), r[0]))]


def bin_slots(arr: Column, low: list[float | None], high: list[float | None], bins: int) -> Column:
    """Array of bin numbers 0..bins-1 of an array column; missing values get bin ``bins``."""
    out = []
    for i, (lo, hi) in enumerate(zip(low, high)):
        x = F.nanvl(arr[i], F.lit(None).cast("double"))
        if lo is None or hi <= lo:
            cut = F.lit(0.0)
        else:
            cut = F.least(F.floor((x - F.lit(lo)) / F.lit((hi - lo) / bins)).cast("double"), F.lit(bins - 1.0))
        out.append(F.when(x.isNull(), F.lit(float(bins))).otherwise(cut))
    return F.array(*out)


class _ChiSqTopKParams(HasFeaturesCol, HasOutputCol, HasLabelCol):
    numTopFeatures = Param(Params._dummy(), "numTopFeatures", "number of features to keep",
                           typeConverter=TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "equal-width bins per slot; 0: every distinct value is a category",
                 typeConverter=TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(numTopFeatures=50, bins=0, featuresCol="features", outputCol="selected_features",
                         labelCol="label_indexed")


class ChiSqTopK(Estimator, _ChiSqTopKParams):
    @keyword_only
    def __init__(self, *, numTopFeatures: int = 50, featuresCol: str = "features",
                 outputCol: str = "selected_features", labelCol: str = "label_indexed", bins: int = 0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ChiSqTopKModel":
        label, bins = self.getLabelCol(), self.getOrDefault(self.bins)
        tested = df.select(F.col(self.getFeaturesCol()).alias("x"), F.col(label).alias("y"))
        if bins:
            arr = vector_to_array(F.col("x"), dtype="float64")
            width = len(tested.first()["x"])
            slot = [F.nanvl(arr[i], F.lit(None).cast("double")) for i in range(width)]
            ends = tested.agg(F.array(*map(F.min, slot)).alias("low"), F.array(*map(F.max, slot)).alias("high")).first()
            tested = tested.select(array_to_vector(bin_slots(arr, ends["low"], ends["high"], bins)).alias("x"), "y")
        scores = ChiSquareTest.test(tested, "x", "y", flatten=True).collect()  # one row per slot
        order = rank_slots([(r["featureIndex"], r["pValue"], r["degreesOfFreedom"], r["statistic"]) for r in scores])
        return self._copyValues(ChiSqTopKModel(sorted(order[:self.getOrDefault(self.numTopFeatures)])))


class ChiSqTopKModel(Model, _ChiSqTopKParams):
    def __init__(self, selected: list[int] | None = None):
        super().__init__()
        self.selectedFeatures = list(selected or [])

    def _transform(self, df: DataFrame) -> DataFrame:
        return VectorSlicer(inputCol=self.getFeaturesCol(), outputCol=self.getOutputCol(),
                            indices=self.selectedFeatures).transform(df)

    def copy(self, extra=None):
        that = super().copy(extra)
        that.selectedFeatures = list(self.selectedFeatures)
        return that
