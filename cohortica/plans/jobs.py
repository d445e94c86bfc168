"""End-to-end jobs: cohort tables to train/test frames, and the drift report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortica import fixed
from cohortica.operators import drift
from cohortica.operators.clean import clean_data, select_features
from cohortica.operators.running import materialize
from cohortica.operators.split import stratified_split
from cohortica.plans.preprocess import AdmissionPreprocessor


def model_frame(wide: DataFrame, key: str = "hadm_id") -> DataFrame:
    """Cleaned model columns plus the key that identifies a row."""
    return select_features(clean_data(wide), [key, *fixed.FEATURES_TO_USE])


def prepare_train_test(wide: DataFrame, key: str = "hadm_id", neighbours: int = fixed.NEIGHBOURS):
    """(train, test, preprocessor): split first, fit on train only, transform both.

    The cleaned frame is checkpointed once; split, fit and both transforms read it.
    """
    frame = materialize(model_frame(wide, key))
    train, test = stratified_split(frame, fixed.LABEL_COLUMN, key)
    model = AdmissionPreprocessor(neighbours=neighbours, tieBreak=key).fit(train)
    return model.transform(train), model.transform(test), model


def get_drift_summary(reference: DataFrame, current: DataFrame, label: str, **tests) -> tuple[DataFrame, DataFrame]:
    """(summary row, per-feature rows) of the current period against the reference; `tests` as in drift_features."""
    features = materialize(drift.drift_features(reference, current, **tests))
    return drift.drift_summary(features, label), features.withColumn("period", F.lit(label))


def write_drift_report(summary: DataFrame, features: DataFrame, folder: str) -> None:
    summary.coalesce(1).write.mode("overwrite").parquet(f"{folder}/summary")
    features.coalesce(1).write.mode("overwrite").parquet(f"{folder}/features")
