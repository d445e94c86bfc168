import datetime as dt

import pytest

from cohortica import fixed
from cohortica.operators import cohort
from cohortica.sources.schema import TABLES, WIDE
from cohortica.sources.views import register_folder, register_views


def at(hours, seconds=0):
    return dt.datetime(2150, 3, 1, 8) + dt.timedelta(hours=hours, seconds=seconds)


@pytest.fixture(scope="module")
def tables(spark):
    data = {
        "d_labitems": [(1, "glucose", "Blood"), (2, "Glucose", "BLOOD"), (3, "Albumin", "Urine"), (4, "Prealbumin", "blood"),
                       (5, "Hematocrit, Calculated", "Blood"), (6, "C-Reactive Protein", "Blood"), (7, "Sodium", "Blood")],
        "admissions": [(10, 100, at(0), "URGENT", "EMERGENCY ROOM", None, "WHITE"),
                       (10, 101, at(500), "ELECTIVE", None, "MARRIED", "WHITE"),
                       (11, 102, at(0), "EW EMER.", "PACU", "SINGLE", "ASIAN"),
                       (12, 103, at(0), "OTHER", "WALK-IN", "SINGLE", None)],
        "patients": [(10, "F", 60), (11, "M", 41)],
        "labevents": [(100, 2, at(0), 90.0), (100, 2, at(24), 140.0), (100, 2, at(24, 1), 999.0), (100, 2, at(0, -1), 998.0),
                      (100, 1, at(1), 777.0), (100, 5, at(2), 33.0), (100, 5, at(3), None),
                      (102, 4, at(1), 20.0), (102, 7, at(1), 140.0), (103, 7, at(1), 140.0), (999, 2, at(1), 1.0)],
        "diagnoses_icd": [(10, 100, "E43"), (10, 100, "263.9"), (10, 100, "E43"), (11, 102, "e440"), (12, 103, "I10"),
                          (10, 101, "X263")],
        "omr": [(10, "Height (Inches)", "61", dt.date(2149, 1, 1), 2), (10, "Height (Inches)", "99", dt.date(2149, 1, 1), 3),
                (10, "Height (Inches)", "50", dt.date(2150, 1, 1), 1), (10, "HEIGHT", "9", dt.date(2150, 1, 1), 1),
                (10, "Weight (Lbs)", "abc", dt.date(2149, 1, 1), 1), (10, "Blood Pressure", "120/80", dt.date(2149, 1, 1), 1),
                (11, "BMI (kg/m2)", "21.5", dt.date(2149, 1, 1), 1)],
    }
    return {n: spark.createDataFrame(rows, TABLES[n]) for n, rows in data.items()}


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_label_filter_ignores_case_and_checks_category(tables):
    kept = {r["itemid"] for r in cohort.nutrition_labs(tables["d_labitems"]).collect()}
    assert kept == {1, 2, 4, 5, 6}


def test_window_is_inclusive_and_label_exact(tables):
    labs = by(cohort.nutrition_lab_events(tables["labevents"], tables["d_labitems"], tables["admissions"]), "hadm_id")
    assert set(labs) == {100, 102}
    assert labs[100]["glucose_admit"] == 140.0  # both ends kept, a second outside dropped, "glucose" is another label
    assert labs[100]["hematocrit_calculated_admit"] == 33.0
    assert all(labs[102][c] is None for c in fixed.LAB_MEASURES)  # only a non-pivoted label: a row of NULLs


def test_first_observation_uses_date_then_tie_break(tables):
    first = by(cohort.first_observations(tables["omr"]), "subject_id")
    assert first[10]["height_in"] == 61.0  # numeric maximum over the two height names
    assert first[10]["weight_lb"] is None and first[10]["blood_pressure"] == "120/80"
    assert first[11]["bmi"] == 21.5 and first[11]["height_in"] is None


def test_wide_row_layout_and_flags(tables):
    wide = cohort.build_cohort(tables)
    assert [f.name for f in wide.schema] == [f.name for f in WIDE] and len(wide.columns) == 29
    rows = by(wide, "hadm_id")
    assert len(rows) == 4 and wide.count() == 4
    assert {h: r[fixed.LABEL_COLUMN] for h, r in rows.items()} == {100: 1, 101: 0, 102: 1, 103: 0}
    assert rows[101]["height_in"] == 61.0 and rows[101]["hadm_id:1"] is None  # patient values repeat, labs do not
    assert rows[103]["gender"] is None and rows[103]["subject_id:1"] is None


def test_fan_out_repeats_per_code(tables):
    counts = {}
    for r in cohort.build_cohort(tables, dedupe=False).collect():
        counts[r["hadm_id"]] = counts.get(r["hadm_id"], 0) + 1
    assert counts == {100: 2, 101: 1, 102: 1, 103: 1}


def test_codes_hot_on_both_sides_repeat_the_same_rows(spark, tables):
    many = spark.range(300).selectExpr("10L subject_id", "100L hadm_id", "concat('E4', id) icd_code")
    crowd = spark.range(40).selectExpr("10L subject_id", "100L hadm_id", "timestamp'2150-03-01 08:00:00' admittime",
                                       "cast(id as string) admission_type", "'x' admission_location", "'y' marital_status", "'z' race")
    both = {**tables, "diagnoses_icd": tables["diagnoses_icd"].union(many), "admissions": tables["admissions"].union(crowd)}
    plain = cohort.build_cohort(both, dedupe=False)
    grid = cohort.build_cohort(both, dedupe=False, rows_per_task=20, fraction=1.0)
    assert grid.columns == plain.columns and plain.count() == 41 * 301 + 3  # E43 is one of the 300
    assert _as_rows(grid) == _as_rows(plain)


def test_views_can_be_queried(spark, tables):
    register_views(tables)
    assert spark.sql("select count(*) from mal_pt_data where has_malnutrition = 1").first()[0] == 3
    assert spark.sql("select max(glucose_admit) from nutrition_lab_events").first()[0] == 140.0
    assert spark.sql("select count(*) from d_nutrition_labs").first()[0] == 5
    assert spark.sql("select count(*) from omr_admit_antho").first()[0] == 2


def _as_rows(df):
    return sorted((str(sorted(r.asDict().items())) for r in df.collect()))


def test_view_chain_is_bound_late(spark, tables, tmp_path):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
    register_folder(spark, str(tmp_path))
    assert [(f.name, f.dataType) for f in spark.table("mal_pt_data").schema] == [(f.name, f.dataType) for f in WIDE]
    assert _as_rows(spark.table("mal_pt_data")) == _as_rows(cohort.build_cohort(tables, dedupe=False))
    query = "select a.hadm_id, p.gender from admissions a join patients p on a.subject_id = p.subject_id"
    plan = lambda: spark.sql(query)._jdf.queryExecution().executedPlan().toString()
    rows, before = spark.sql("select count(*) from mal_pt_data").first()[0], plan()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "30000")
        for name, more in (("admissions", ("id + 1000", "id + 1000", "timestamp'2150-03-01'", *["uuid()"] * 4)),
                           ("patients", ("id + 1000", "'F'", "50"))):
            grown = spark.range(20000).selectExpr(*[f"cast({e} as {f.dataType.simpleString()}) {f.name}"
                                                   for e, f in zip(more, TABLES[name])])
            grown.write.mode("append").parquet(f"{tmp_path}/{name}")
        after = plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert spark.sql("select count(*) from mal_pt_data").first()[0] == rows + 20000
    assert spark.sql("select count(*) from mal_pt_data where age = 50 and gender = 'F'").first()[0] == 20000
    assert "BroadcastHashJoin" in before and "SortMergeJoin" in after


def test_replacing_a_base_view_changes_those_above_it(spark, tables):
    register_views(tables)
    tables["d_labitems"].where("itemid <> 2").createOrReplaceTempView("d_labitems")
    assert spark.sql("select count(*) from d_nutrition_labs").first()[0] == 4
    assert spark.sql("select max(glucose_admit) from nutrition_lab_events").first()[0] is None


def test_first_rows_limits_before_the_shuffle(tables):
    plan = cohort.first_rows(tables["omr"], ["subject_id"], ["chartdate", "seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
