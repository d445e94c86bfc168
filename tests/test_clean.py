import pytest
from pyspark.sql import functions as F

from cohortica import fixed
from cohortica.functions import typed_value
from cohortica.operators.clean import clean_data, group_categories, select_features, split_label, text_columns

SCHEMA = ("n int, hematocrit_admit double, hematocrit_calculated_admit double, marital_status string, blood_pressure string, "
          "weight_lb double, height_in double, alkaline_phosphatase_admit double, "
          "asparate_aminotransferase_ast_admit double, extra_col int")


@pytest.fixture(scope="module")
def cleaned(spark):
    df = spark.createDataFrame([
        (0, None, 38.0, None, "120/80", 154.0, 67.0, 100.0, None, 1),
        (1, 35.0, 32.0, "MARRIED", "130/90", 220.0, 72.0, None, 45.0, 2),
        (2, 40.0, None, None, None, 110.0, 47.0, 200.0, 60.0, 3),
        (3, float("nan"), 31.0, None, "120", None, None, float("nan"), None, 4),
        (4, None, None, None, "abc/80", 100.0, float("nan"), None, None, 5),
        (5, None, None, None, "1/2/3", 100.0, 0.0, None, None, 6),
    ], SCHEMA)
    return {r["n"]: r for r in clean_data(df, ["extra_col", "not_there", "hadm_id:1"]).collect()}


def test_columns(cleaned):
    names = set(cleaned[0].__fields__)
    assert "extra_col" not in names and "hematocrit_calculated_admit" not in names
    assert not {"blood_pressure", "weight_lb", "height_in"} & names


def test_fills(cleaned):
    assert cleaned[0]["hematocrit_admit"] == 38.0 and cleaned[1]["hematocrit_admit"] == 35.0
    assert cleaned[3]["hematocrit_admit"] == 31.0
    assert cleaned[0]["marital_status"] == "UNKNOWN" and cleaned[1]["marital_status"] == "MARRIED"


def test_pressure(cleaned):
    assert [(cleaned[i]["systolic"], cleaned[i]["diastolic"]) for i in range(6)] == [
        (120.0, 80.0), (130.0, 90.0), (None, None), (120.0, None), (None, 80.0), (1.0, 2.0)]


def test_units_and_flags(cleaned):
    assert cleaned[0]["weight_kg"] == pytest.approx(154.0 / 2.2) and cleaned[0]["height_cm"] == pytest.approx(67 * 2.54)
    assert cleaned[2]["height_cm"] is None and cleaned[5]["height_cm"] is None
    assert cleaned[0]["bmi"] == pytest.approx(70.0 / (1.7018 ** 2)) and cleaned[2]["bmi"] is None
    assert [cleaned[i]["alk_phos_ordered"] for i in range(4)] == [1, 0, 1, 0]
    assert [cleaned[i]["ast_ordered"] for i in range(4)] == [0, 1, 1, 0]


def groups(spark, race=None, kind=None, place=None):
    df = spark.createDataFrame([(race, kind, place)], "race string, admission_type string, admission_location string")
    r = group_categories(df).first()
    return r["race_grouped"], r["admit_type_grouped"], r["admit_loc_grouped"]


def test_groups(spark):
    cases = {
        ("WHITE", "EMERGENCY", "WALK IN/SELF REFERRAL"): ("white", "emergency", "walkin"),
        ("BLACK OR AFRICAN AMERICAN", "ELECTIVE", "HOSPITAL TRANSFER"): ("black", "elective", "hospital"),
        ("HISPANIC OR LATINO", "URGENT", "PHYSICIAN REFERRAL"): ("hispanic", "urgent_care", "referral"),
        ("white - hispanic", "EU OBSERVATION URGENT", "SKILLED NURSING ROOM"): ("hispanic", "observation", "snf"),
        ("portuguese", "SURGICAL SAME DAY", "CLINIC REFERRAL"): ("white", "surgical_admit", "referral"),
        ("UNABLE TO OBTAIN", "NOT ELECTIVE", "PROCEDURE SITE"): ("unknown/declined", "other", "internal"),
        ("NOT WHITE", "elective", "walk in"): ("other", "other", "other_unknown"),
        (None, None, None): ("other", "other", "other_unknown"),
    }
    rows = spark.createDataFrame([(i, *k) for i, k in enumerate(cases)],
                                 "i int, race string, admission_type string, admission_location string")
    got = {r["i"]: (r["race_grouped"], r["admit_type_grouped"], r["admit_loc_grouped"]) for r in group_categories(rows).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_projection_and_label(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "has_malnutrition int, s string, v double")
    assert select_features(df, ["v", "has_malnutrition"]).columns == ["v", "has_malnutrition"]
    with pytest.raises(Exception):
        select_features(df, ["nope"])
    x, y = split_label(df)
    assert x.columns == ["s", "v"] and y.columns == [fixed.LABEL_COLUMN] and text_columns(df) == ["s"]


def test_typed_value(spark):
    texts = ["None", "-1", "0.5", "balanced", "1e3", "none", "12", "99999999999999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").select("v", typed_value(F.col("v")).alias("t")).select("v", "t.*")
    got = {r["v"]: (r["as_int"], r["as_double"], r["as_text"]) for r in df.collect()}
    assert got["None"] == got["none"] == (None, None, None)
    assert got["-1"] == (-1, None, None) and got["12"] == (12, None, None)
    assert got["0.5"] == (None, 0.5, None) and got["1e3"] == (None, 1000.0, None)
    assert got["balanced"] == (None, None, "balanced") and got["99999999999999999999"][1] == 1e20
