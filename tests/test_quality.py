import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortica.operators import quality


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame([(1.0, 4.0), (2.0, 5.0), (None, 6.0)], "a double, b double")


def test_report(sample):
    r = quality.check_data_quality(sample, ["a", "b", "absent"]).first()
    assert r.asDict() == {"total_rows": 3, "total_nulls": 1, "null_percentage": 16.67, "duplicate_rows": 0,
                          "a_min": 1.0, "a_max": 2.0, "b_min": 4.0, "b_max": 6.0}


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (2, 4)], "a int, b int")
    assert quality.check_data_quality(df, []).first()["duplicate_rows"] == 1
    df = spark.createDataFrame([(None, 3.0), (float("nan"), 3.0), (None, 3.0)], "a double, b double")
    r = quality.check_data_quality(df, ["a"]).first()
    assert r["duplicate_rows"] == 2 and r["total_nulls"] == 3 and r["a_min"] is None


def test_empty_input(spark, sample):
    r = quality.check_data_quality(sample.where("a > 9"), ["a"]).first()
    assert r["total_rows"] == 0 and r["null_percentage"] is None and r["duplicate_rows"] == 0


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"x": rng.integers(0, 7, 501).astype(float), "y": rng.normal(size=501)})
    pdf.loc[::9, "y"] = np.nan
    got = quality.describe_numeric(spark.createDataFrame(pdf), ["x", "y"]).toPandas().set_index("feature")
    want = pdf.describe().T
    for ours, theirs in [("n", "count"), ("mean", "mean"), ("std", "std"), ("min_value", "min"), ("q25", "25%"),
                         ("q50", "50%"), ("q75", "75%"), ("max_value", "max")]:
        np.testing.assert_allclose(got.loc[["x", "y"], ours].astype(float), want.loc[["x", "y"], theirs], rtol=1e-12)


def test_describe_column_without_values(spark, sample):
    r = quality.describe_numeric(sample.withColumn("a", F.lit(None).cast("double")), ["a", "b"]).toPandas().set_index("feature")
    assert r.loc["a", "n"] == 0 and np.isnan(r.loc["a", "q50"]) and r.loc["b", "q50"] == 5.0


def test_structure_and_ranges(sample):
    s = {r["column_name"]: r for r in quality.structure_summary(sample).collect()}
    assert s["a"]["non_null"] == 2 and s["a"]["total_rows"] == 3 and s["b"]["data_type"] == "double"
    assert [tuple(r) for r in quality.column_ranges(sample, ["a", "zzz"]).collect()] == [("a", 1.0, 2.0)]


def test_range_contract(spark):
    df = spark.createDataFrame([(18, 20.0), (99, None), (17, 5000.0), (None, 2000.0)], "age int, glucose_admit double")
    rules = {"age": (18, 99, False), "glucose_admit": (20, 2000, True)}
    assert {r["column_name"]: r["violations"] for r in quality.range_violations(df, rules).collect()} == {"age": 2, "glucose_admit": 1}
    assert quality.range_violations(df.where("age = 18"), rules).count() == 0
    with pytest.raises(ValueError, match="bmi"):
        quality.range_violations(df, {"bmi": (10, 80, False)})


def test_domain_contract(spark):
    df = spark.createDataFrame([("M", 1), ("F", 0), ("X", 0), (None, 2)], "gender string, has_malnutrition int")
    rules = {"gender": ["M", "F"], "has_malnutrition": [0, 1]}
    got = {(r["column_name"], r["value"], r["n"]) for r in quality.domain_violations(df, rules).collect()}
    assert got == {("gender", "X", 1), ("gender", None, 1), ("has_malnutrition", "2", 1)}
    decimals = df.withColumn("has_malnutrition", F.col("has_malnutrition").cast("double"))
    assert [r["value"] for r in quality.domain_violations(decimals, {"has_malnutrition": [0, 1]}).collect()] == ["2.0"]
    allowed = spark.createDataFrame([("M",), ("F",)], "gender string")
    assert {r[0] for r in quality.unexpected_values(df, "gender", allowed).collect()} == {"X", None}
    with pytest.raises(ValueError):
        quality.domain_violations(df, {"race_grouped": ["white"]})


def test_top_rows_and_counts(sample):
    assert [r["a"] for r in quality.top_rows(sample, "a", 3, ["b"]).collect()] == [2.0, 1.0, None]
    assert tuple(quality.count_matching(sample, F.col("a") > 1).first()) == (1, 3)


def test_repeated_rows_are_found_by_digest(spark):
    rows = [(i % 50, None if i % 3 else 1.5, "x" * (i % 5)) for i in range(400)] + [(7, -0.0, "z"), (7, 0.0, "z"), (7, float("nan"), None), (7, None, None)]
    df = spark.createDataFrame(rows, "a int, b double, c string")
    key = lambda r: (r[0], None if r[1] is None or r[1] != r[1] else r[1] + 0.0, r[2])
    report = quality.check_data_quality(df, ["a", "b"]).first()
    assert report["total_rows"] == 404 and report["duplicate_rows"] == 404 - len({key(r) for r in rows})
    assert report["b_min"] == 0.0 and report["total_nulls"] == sum(v is None for r in rows for v in key(r))
    none = quality.check_data_quality(df.limit(0), ["a"]).first()
    assert (none["total_rows"], none["duplicate_rows"], none["null_percentage"]) == (0, 0, None)
