"""Reference predictors: the train mean and the BTYD product."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from spendcast.operators.btyd import baseline_log_prediction


class MeanRegressor(Estimator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts the mean label of the rows it was fitted on."""

    @keyword_only
    def __init__(self, *, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MeanModel":
        mean = dataset.agg(F.avg(self.getLabelCol()).alias("mean")).first()["mean"]
        return MeanModel(mean=float(mean), predictionCol=self.getPredictionCol())


class MeanModel(Model, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    mean = Param(Params._dummy(), "mean", "fitted mean", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, mean: float = 0.0, predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(mean=0.0)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getPredictionCol(), F.lit(self.getOrDefault(self.mean)))


class PurchaseValueModel(Transformer, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """log1p of expected purchases times expected order value; nothing to fit."""

    @keyword_only
    def __init__(self, *, predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getPredictionCol(), baseline_log_prediction())
