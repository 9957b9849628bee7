"""Weighted mean of fitted models' log predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F


class EnsembleModel(Model, HasPredictionCol, MLReadable, MLWritable):
    """Chains its members' ``transform``, so all predictions are columns of one row: no join."""

    weights = Param(Params._dummy(), "weights", "one weight per member", TypeConverters.toListFloat)
    names = Param(Params._dummy(), "names", "member names", TypeConverters.toListString)

    def __init__(
        self, members: Sequence[Transformer] = (), weights: Sequence[float] = (), names: Sequence[str] = ()
    ):
        super().__init__()
        self.members = list(members)
        self._set(weights=list(weights), names=list(names), predictionCol="prediction")

    def copy(self, extra=None) -> "EnsembleModel":
        that = super().copy(extra)
        that.members = self.members
        return that

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = self.getOrDefault(self.weights)
        out = predict_columns(dataset, {f"_m{i}": m for i, m in enumerate(self.members)})
        mean = weighted_mean([F.col(f"_m{i}") for i in range(len(weights))], [F.lit(float(w)) for w in weights])
        return out.withColumn(self.getPredictionCol(), mean).select(
            *dataset.columns, self.getPredictionCol()
        )

    def write(self) -> MLWriter:
        return _EnsembleWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EnsembleReader()


def weighted_mean(values: Sequence[Column], weights: Sequence[Column]) -> Column:
    total = sum((v * w for v, w in zip(values, weights)), F.lit(0.0))
    return total / sum(weights, F.lit(0.0))


def predict_columns(df: DataFrame, models: dict[str, Transformer]) -> DataFrame:
    """One prediction column per model on the same row."""
    out = df
    for column, model in models.items():
        predicted = model.transform(out)
        out = predicted.select(*out.columns, F.col("prediction").alias(column))
    return out


class _EnsembleWriter(MLWriter):
    def __init__(self, instance: EnsembleModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(
            self.instance, path, self.sparkSession, extraMetadata={"members": len(self.instance.members)}
        )
        for i, member in enumerate(self.instance.members):
            member.write().save(f"{path}/member-{i}")


class _EnsembleReader(MLReader):
    def load(self, path: str) -> EnsembleModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        members = [
            DefaultParamsReader.loadParamsInstance(f"{path}/member-{i}", self.sparkSession)
            for i in range(metadata["members"])
        ]
        model = EnsembleModel(members)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
