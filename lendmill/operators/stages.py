"""Preprocessing as stages of ``pyspark.ml`` pipelines.

``Preprocessor`` fits every preprocessing step; its model turns raw applications into a feature
vector and a label beside the kept columns, so it can stand before any learner in a ``Pipeline``
and is saved and loaded with it.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.config import PREP, PrepSpec
from lendmill.operators.prep import PrepModel, fit_prep


class _PrepParams(Params):
    targetCol = Param(Params._dummy(), "targetCol", "0/1 column to predict",
                      TypeConverters.toString)
    idCols = Param(Params._dummy(), "idCols", "columns that identify a row",
                   TypeConverters.toListString)
    keepCols = Param(Params._dummy(), "keepCols", "further columns to carry along",
                     TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector of features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label as double", TypeConverters.toString)
    outlierStd = Param(Params._dummy(), "outlierStd", "deviations that values are clipped to",
                       TypeConverters.toFloat)
    minVariance = Param(Params._dummy(), "minVariance", "least variance of a feature",
                        TypeConverters.toFloat)
    maxCorrelation = Param(Params._dummy(), "maxCorrelation", "largest correlation of two features",
                           TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(targetCol="default", idCols=["app_id"], keepCols=[], outputCol="features",
                         labelCol="label", outlierStd=PREP.outlier_std,
                         minVariance=PREP.min_variance, maxCorrelation=PREP.max_correlation)


class Preprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits imputation, clipping, encoding, scaling and the feature filters in order."""

    @keyword_only
    def __init__(self, *, targetCol="default", idCols=None, keepCols=None, outputCol="features",
                 labelCol="label", outlierStd=PREP.outlier_std, minVariance=PREP.min_variance,
                 maxCorrelation=PREP.max_correlation):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "PreprocessorModel":
        get = self.getOrDefault
        spec = PrepSpec(get("outlierStd"), get("minVariance"), get("maxCorrelation"),
                        PREP.literal_classes)
        model = PreprocessorModel(fit_prep(dataset, get("targetCol"), get("idCols"), spec))
        return self._copyValues(model)


class PreprocessorModel(Model, _PrepParams, MLWritable, MLReadable):
    """Kept columns, the label (where the target is present) and the feature vector."""

    def __init__(self, prep: PrepModel | None = None):
        super().__init__()
        self.prep = prep

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        target = get("targetCol")
        keep = [k for k in dict.fromkeys([*get("idCols"), target]) if k in dataset.columns]
        more = [k for k in get("keepCols") if k in dataset.columns and k not in keep]
        # a kept column may be a feature too: its copy travels beside the features
        copy = f"_{self.uid}"
        rows = dataset.withColumn(copy, F.struct(*more)) if more else dataset
        out = self.prep.transform(rows, keep=[*keep, copy])
        vector = array_to_vector(F.array(*[F.col(c).cast("double") for c in self.prep.features]))
        label = [F.col(target).cast("double").alias(get("labelCol"))] if target in keep else []
        kept = [*keep, *[F.col(f"{copy}.{k}").alias(k) for k in more]]
        return out.select(*kept, *label, vector.alias(get("outputCol")))

    @property
    def features(self) -> list[str]:
        return self.prep.features

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, instance: PreprocessorModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.prep.save(f"{path}/prep")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> PreprocessorModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(PrepModel.load(SparkSession.active(), f"{path}/prep"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
