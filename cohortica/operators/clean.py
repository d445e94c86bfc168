"""Cleaning of the wide row: one chain of column expressions, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortica import fixed
from cohortica.functions import (
    bmi, clean_number, group_admission_location, group_admission_type, group_race, nan_to_null,
    pair_part, plausible, presence_flag,
)


def nulls_for_nans(df: DataFrame) -> DataFrame:
    """Missing is NULL everywhere: turn NaN into NULL in every floating column."""
    return df.select(*[nan_to_null(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def clean_data(df: DataFrame, cols_to_drop: list[str] = fixed.COLUMNS_TO_DROP) -> DataFrame:
    """Fill, split, convert and flag the admission columns; derive the body-mass index."""
    height = plausible(clean_number(F.col("height_in")) * F.lit(fixed.CM_PER_INCH),
                       fixed.MIN_HEIGHT_CM_EXCLUSIVE)
    out = nulls_for_nans(df.drop(*cols_to_drop)).withColumns({
        "hematocrit_admit": F.coalesce("hematocrit_admit", "hematocrit_calculated_admit"),
        "marital_status": F.coalesce("marital_status", F.lit(fixed.MISSING_MARITAL_STATUS)),
        "systolic": clean_number(pair_part(F.col("blood_pressure"), 0)),
        "diastolic": clean_number(pair_part(F.col("blood_pressure"), 1)),
        "weight_kg": clean_number(F.col("weight_lb")) / F.lit(fixed.POUNDS_PER_KG),
        "height_cm": height,
        "alk_phos_ordered": presence_flag(F.col("alkaline_phosphatase_admit")),
        "ast_ordered": presence_flag(F.col("asparate_aminotransferase_ast_admit")),
    })
    out = out.drop("hematocrit_calculated_admit", "blood_pressure", "weight_lb", "height_in")
    return out.withColumn("bmi", bmi(F.col("weight_kg"), F.col("height_cm")))


def select_features(df: DataFrame, features: list[str] = fixed.FEATURES_TO_USE) -> DataFrame:
    """The model columns in order. An absent column is an error."""
    return df.select(*[F.col(f"`{name}`") for name in features])


def split_label(df: DataFrame, label: str = fixed.LABEL_COLUMN) -> tuple[DataFrame, DataFrame]:
    return df.drop(label), df.select(label)


def text_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold categories."""
    return [name for name, kind in df.dtypes if kind == "string"]


def group_categories(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "race_grouped": group_race(F.col("race")),
        "admit_type_grouped": group_admission_type(F.col("admission_type")),
        "admit_loc_grouped": group_admission_location(F.col("admission_location")),
    })
