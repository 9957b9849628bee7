"""Two-stage regressor for zero-inflated spend, as a Spark ML estimator."""

from __future__ import annotations

from dataclasses import replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, functions as F

from spendcast.config import SETTINGS
from spendcast.operators import isotonic
from spendcast.operators.evaluation import class_weights
from spendcast.operators.scoring import hurdle_dollars

MIN_POSITIVE = 5

class _HurdleParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    probCol = Param(Params._dummy(), "probCol", "output: calibrated P(spend > 0)", TypeConverters.toString)
    logMax = Param(Params._dummy(), "logMax", "upper clip of the log amount", TypeConverters.toFloat)
    threshold = Param(Params._dummy(), "threshold", "no spend below this probability", TypeConverters.toFloat)
    minDollars = Param(Params._dummy(), "minDollars", "no spend below this amount", TypeConverters.toFloat)

    def _defaults(self) -> None:
        self._setDefault(
            probCol="prob_spend",
            logMax=SETTINGS.log_pred_max,
            threshold=SETTINGS.churn_threshold,
            minDollars=SETTINGS.min_dollars,
        )


class HurdleRegressor(Estimator, _HurdleParams):
    """Classifier for ``label > 0``, isotonic calibration, regressor on the spenders.

    ``balance`` weights the classes: ``"balanced"`` gives n / (2 n_class) to each,
    ``"positive"`` gives max(1, n_neg / n_pos) to spenders, ``"none"`` nothing.
    ``calibrationFraction`` keeps that share of the rows (by hash) away from the classifier and
    calibrates on them; 0 calibrates on the training rows.
    """

    balance = Param(Params._dummy(), "balance", "balanced, positive or none", TypeConverters.toString)
    calibrationFraction = Param(Params._dummy(), "calibrationFraction", "held-out share", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self,
        *,
        classifier: Estimator,
        regressor: Estimator,
        featuresCol: str = "features",
        labelCol: str = "label",
        predictionCol: str = "prediction",
        balance: str = "none",
        calibrationFraction: float = 0.0,
        logMax: float = SETTINGS.log_pred_max,
    ):
        super().__init__()
        self._defaults()
        kwargs = dict(self._input_kwargs)
        self.classifier = kwargs.pop("classifier")
        self.regressor = kwargs.pop("regressor")
        self._setDefault(balance="none", calibrationFraction=0.0)
        self._set(**kwargs)

    def copy(self, extra=None) -> "HurdleRegressor":
        that = super().copy(extra)
        that.classifier = self.classifier.copy(extra or {})
        that.regressor = self.regressor.copy(extra or {})
        return that

    def _fit(self, dataset: DataFrame) -> "HurdleModel":
        label, features = self.getLabelCol(), self.getFeaturesCol()
        positives = F.count_if(F.col(label) > 0)
        weights = class_weights(self.getOrDefault(self.balance), F.count("*") - positives, positives)
        counts = dataset.agg(
            positives.alias("positives"),
            F.avg(F.when(F.col(label) > 0, F.col(label))).alias("mean_positive"),
            weights[0].alias("negative_weight"),
            weights[1].alias("positive_weight"),
        ).first()
        negative, positive = counts["negative_weight"], counts["positive_weight"]
        rows = dataset.withColumns(
            {
                "_spends": (F.col(label) > 0).cast("double"),
                "_weight": F.when(F.col(label) > 0, float(positive)).otherwise(float(negative)),
            }
        )
        held_out = self.getOrDefault(self.calibrationFraction)
        if held_out > 0:
            aside = F.pmod(F.xxhash64(features), F.lit(10_000)) < int(held_out * 10_000)
            fit_rows, calibration_rows = rows.filter(~aside), rows.filter(aside)
        else:
            fit_rows, calibration_rows = rows, rows
        classify = self.classifier.copy(
            {
                self.classifier.featuresCol: features,
                self.classifier.labelCol: "_spends",
                self.classifier.weightCol: "_weight",
                self.classifier.probabilityCol: "_probability",
                self.classifier.rawPredictionCol: "_raw",
                self.classifier.predictionCol: "_class",
            }
        )
        regress = self.regressor.copy(
            {
                self.regressor.featuresCol: features,
                self.regressor.labelCol: label,
                self.regressor.predictionCol: "_log_amount",
            }
        )
        fits = [(classify, fit_rows)]
        if counts["positives"] >= MIN_POSITIVE:
            fits.append((regress, rows.filter(F.col(label) > 0)))
        # The stages don't need each other and are fitted side by side.
        with ThreadPool(2) as pool:
            work = inheritable_thread_target(dataset.sparkSession)(lambda fit: fit[0].fit(fit[1]))
            classifier, regressor = [*pool.map(work, fits, chunksize=1), None][:2]
        model = HurdleModel(
            classifier=classifier,
            calibrator=_calibrate(classifier, calibration_rows),
            regressor=regressor,
            fallback=float(counts["mean_positive"] or 0.0),
        )
        return self._copyValues(model)


def _calibrate(classifier: Model, rows: DataFrame) -> Model:
    """Isotonic fit of the observed rate on the predicted probability. A fit that fails is an error: raw
    probabilities of weighted classes would pass for calibrated ones."""
    scored = classifier.transform(rows).select(vector_to_array("_probability")[1].alias("p"), F.col("_spends").alias("y"))
    found = isotonic.blocks(scored)
    if found.isEmpty():
        raise ValueError("no rows to calibrate the classifier on")
    return isotonic.model(found).setFeaturesCol("p").setPredictionCol("_calibrated")


class HurdleModel(Model, _HurdleParams, MLReadable, MLWritable):
    """Fitted hurdle. ``transform`` adds the probability and the log prediction."""

    fallback = Param(Params._dummy(), "fallback", "log amount without a regressor", TypeConverters.toFloat)

    def __init__(
        self,
        classifier: Transformer | None = None,
        calibrator: Transformer | None = None,
        regressor: Transformer | None = None,
        fallback: float = 0.0,
    ):
        super().__init__()
        self._defaults()
        self.classifier, self.calibrator, self.regressor = classifier, calibrator, regressor
        self._set(fallback=fallback)

    def copy(self, extra=None) -> "HurdleModel":
        that = super().copy(extra)
        that.classifier, that.calibrator, that.regressor = self.classifier, self.calibrator, self.regressor
        return that

    def _transform(self, dataset: DataFrame) -> DataFrame:
        prob = self.getOrDefault(self.probCol)
        out = self.classifier.transform(dataset).withColumn("p", vector_to_array("_probability")[1])
        if self.calibrator is not None:
            out = self.calibrator.transform(out).withColumn(prob, F.col("_calibrated"))
        else:
            out = out.withColumn(prob, F.col("p"))
        if self.regressor is not None:
            out = self.regressor.transform(out)
        else:
            out = out.withColumn("_log_amount", F.lit(self.getOrDefault(self.fallback)))
        limits = replace(
            SETTINGS,
            log_pred_max=self.getOrDefault(self.logMax) if self.regressor is not None else float("inf"),
            churn_threshold=self.getOrDefault(self.threshold),
            min_dollars=self.getOrDefault(self.minDollars),
        )
        amount = hurdle_dollars(F.col(prob), F.col("_log_amount"), limits)
        return out.withColumn(self.getPredictionCol(), F.log1p(amount)).select(*dataset.columns, prob, self.getPredictionCol())

    def write(self) -> MLWriter:
        return _HurdleWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _HurdleReader()


_PARTS = ("classifier", "calibrator", "regressor")


class _HurdleWriter(MLWriter):
    def __init__(self, instance: HurdleModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        present = [p for p in _PARTS if getattr(self.instance, p) is not None]
        DefaultParamsWriter.saveMetadata(
            self.instance, path, self.sparkSession, extraMetadata={"parts": present}
        )
        for part in present:
            getattr(self.instance, part).write().save(f"{path}/{part}")


class _HurdleReader(MLReader):
    def load(self, path: str) -> HurdleModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        parts = {
            p: DefaultParamsReader.loadParamsInstance(f"{path}/{p}", self.sparkSession) for p in metadata["parts"]
        }
        model = HurdleModel(**parts)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
