"""The cohort as a chain of views that is bound late.

A view is kept as its SQL text and analysed anew by each query. Base views name Parquet folders, so rows added
to a folder are read by the next query, and Spark chooses joins by the sizes the tables have then; a base view
that is replaced changes all views above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortica import fixed
from cohortica.sources.schema import TABLES


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _any_like(column: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(f"{column} ILIKE {_text(p)}" for p in patterns) + ")"


def base_views(folder: str) -> dict[str, str]:
    """SQL text of each clinical table: the declared columns of its Parquet folder."""
    return {name: f"SELECT {', '.join(f'CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}' for f in schema)} "
                  f"FROM parquet.`{folder}/{name}`" for name, schema in TABLES.items()}


def derived_views() -> dict[str, str]:
    """SQL text of the four derived views, each over the ones before it."""
    labs = ",\n  ".join(f"max(CASE WHEN d.label = {_text(label)} THEN e.valuenum END) AS {name}"
                        for name, label in fixed.LAB_MEASURES.items())
    number = "nullif(try_cast(result_value AS double), double('NaN'))"
    seen = ",\n  ".join(
        f"max(CASE WHEN result_name ILIKE {_text(pattern)} THEN "
        f"{'result_value' if name in fixed.OBSERVATION_TEXT_MEASURES else number} END) AS {name}"
        for name, pattern in fixed.OBSERVATION_MEASURES.items())
    return {
        "d_nutrition_labs": f"""
SELECT * FROM d_labitems WHERE fluid ILIKE {_text(fixed.LAB_FLUID)} AND {_any_like('label', fixed.LAB_LABEL_PATTERNS)}""",
        "nutrition_lab_events": f"""
SELECT e.hadm_id,
  {labs}
FROM labevents e JOIN d_nutrition_labs d ON e.itemid = d.itemid JOIN admissions a ON e.hadm_id = a.hadm_id
WHERE e.charttime BETWEEN a.admittime AND a.admittime + INTERVAL {fixed.LAB_WINDOW_HOURS} HOURS
GROUP BY e.hadm_id""",
        "omr_admit_antho": f"""
SELECT subject_id,
  {seen}
FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, result_name ORDER BY chartdate, seq) AS place FROM omr)
WHERE place = 1 GROUP BY subject_id""",
        "mal_pt_data": f"""
SELECT a.subject_id, a.hadm_id, p.gender, p.anchor_age AS age, a.admission_type, a.admission_location,
  a.marital_status, a.race, l.hadm_id AS `hadm_id:1`, {', '.join(f'l.{c}' for c in fixed.LAB_MEASURES)},
  o.subject_id AS `subject_id:1`, {', '.join(f'o.{c}' for c in fixed.OBSERVATION_MEASURES)},
  CASE WHEN h.hadm_id IS NULL THEN 0 ELSE 1 END AS {fixed.LABEL_COLUMN}
FROM admissions a
  LEFT JOIN patients p ON a.subject_id = p.subject_id
  LEFT JOIN omr_admit_antho o ON a.subject_id = o.subject_id
  LEFT JOIN nutrition_lab_events l ON a.hadm_id = l.hadm_id
  LEFT JOIN (SELECT DISTINCT subject_id, hadm_id, icd_code FROM diagnoses_icd
             WHERE {_any_like('icd_code', fixed.LABEL_CODE_PATTERNS)}) h ON a.hadm_id = h.hadm_id""",
    }


def _create(spark: SparkSession, views: dict[str, str]) -> None:
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {text}")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Views over frames, then the derived ones; replacing a base view is seen by those above it."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    _create(tables["admissions"].sparkSession, derived_views())


def register_folder(spark: SparkSession, folder: str) -> None:
    """The chain over a folder of Parquet tables; rows added later are seen by the next query.

    A row of `mal_pt_data` repeats once per distinct matching code of its admission.
    """
    _create(spark, base_views(folder) | derived_views())
