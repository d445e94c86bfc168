"""The admission preprocessor: category groups, imputed height and weight, recomputed BMI.

`AdmissionPreprocessor` is an Estimator, its Model holds the scaler and the donor rows and can be
saved and loaded on its own or as a stage of a pipeline.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
    MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortica import fixed
from cohortica.functions import bmi
from cohortica.operators.clean import group_categories, nulls_for_nans
from cohortica.operators.knn import knn_impute
from cohortica.operators.running import materialize
from cohortica.operators.scale import encode_dummies, fit_levels, fit_scaler

_RAW = ["race", "admission_type", "admission_location"]


class _Settings(Params):
    neighbours = Param(Params._dummy(), "neighbours", "donors averaged per missing value", TypeConverters.toInt)
    tieBreak = Param(Params._dummy(), "tieBreak", "numeric column that orders equally near donors, or empty",
                     TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(neighbours=fixed.NEIGHBOURS, tieBreak="")


def _matching(df: DataFrame, levels: list[str]) -> tuple[DataFrame, list[str]]:
    encoded = encode_dummies(df, fixed.MATCHING_CATEGORY, levels)
    dummies = [f"{fixed.MATCHING_CATEGORY}_{v}" for v in levels[1:]]
    return encoded, [*fixed.MATCHING_NUMERIC, *dummies]


class AdmissionPreprocessor(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, neighbours: int = fixed.NEIGHBOURS, tieBreak: str = ""):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "AdmissionPreprocessorModel":
        df = nulls_for_nans(dataset)
        levels = fit_levels(df, fixed.MATCHING_CATEGORY)
        encoded, features = _matching(df, levels)
        stats = fit_scaler(encoded, features)
        tie = [self.getOrDefault("tieBreak")] if self.getOrDefault("tieBreak") else []
        donors = materialize(encoded.select(*[F.col(f"`{c}`") for c in [*features, *tie]]))
        return self._copyValues(AdmissionPreprocessorModel(levels, stats, donors))

    def fit_transform(self, dataset: DataFrame) -> DataFrame:
        return self.fit(dataset).transform(dataset)


class AdmissionPreprocessorModel(Model, _Settings, MLReadable, MLWritable):
    def __init__(self, levels: list[str] = (), stats: dict | None = None, donors: DataFrame | None = None):
        super().__init__()
        self.levels, self.stats, self.donors = list(levels), dict(stats or {}), donors

    @property
    def feature_cols(self) -> list[str]:
        return list(self.stats)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # Levels are the fitted ones, so a frame with a single gender is coded as at fit time.
        encoded, features = _matching(nulls_for_nans(group_categories(dataset)), self.levels)
        filled = knn_impute(encoded, self.donors, features, fixed.IMPUTED_COLUMNS, self.stats,
                            self.getOrDefault("neighbours"), self.getOrDefault("tieBreak") or None)
        filled = filled.withColumn("bmi", bmi(F.col("weight_kg"), F.col("height_cm")))
        return filled.drop(*_RAW, *[f for f in features if f not in dataset.columns])

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, instance: AdmissionPreprocessorModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        model = self.instance
        DefaultParamsWriter.saveMetadata(model, path, SparkSession.active(),
                                         extraMetadata={"levels": model.levels, "stats": model.stats})
        model.donors.write.mode("overwrite").parquet(f"{path}/donors")


class _ModelReader(MLReader):
    def load(self, path: str) -> AdmissionPreprocessorModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stats = {c: tuple(pair) for c, pair in metadata["stats"].items()}
        model = AdmissionPreprocessorModel(metadata["levels"], stats, spark.read.parquet(f"{path}/donors"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
