import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from cohortica import fixed
from cohortica.operators import runs
from cohortica.operators.quality import domain_violations, range_violations
from cohortica.plans import train
from cohortica.plans.jobs import prepare_train_test
from cohortica.plans.preprocess import AdmissionPreprocessor, AdmissionPreprocessorModel
from cohortica.sources.schema import PROCESSED, WIDE

ADMIT = "age int, gender string, height_cm double, weight_kg double, race string, admission_type string, admission_location string"
QUICK = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "class_weight": "balanced"}


@pytest.fixture(scope="module")
def admits(spark):
    return spark.createDataFrame([
        (45, "M", 175.0, 80.0, "WHITE", "EMERGENCY", "WALK IN/SELF REFERRAL"),
        (62, "F", None, 70.0, "BLACK OR AFRICAN AMERICAN", "ELECTIVE", "HOSPITAL TRANSFER"),
        (30, "M", 160.0, None, "HISPANIC OR LATINO", "URGENT", "PHYSICIAN REFERRAL")], ADMIT)


@pytest.fixture(scope="module")
def fitted(admits):
    return AdmissionPreprocessor().fit(admits)


def by_age(df):
    return {r["age"]: r.asDict() for r in df.collect()}


def test_fit_state(fitted):
    assert fitted.feature_cols == ["age", "height_cm", "weight_kg", "gender_M"]
    assert fitted.stats["height_cm"] == (167.5, 7.5) and fitted.donors.count() == 3


def test_transform(fitted, admits):
    out = fitted.transform(admits)
    assert not {"race", "admission_type", "admission_location", "gender_M"} & set(out.columns)
    rows = by_age(out)
    for r in rows.values():
        assert r["height_cm"] and r["weight_kg"] and r["bmi"] == pytest.approx(r["weight_kg"] / (r["height_cm"] / 100) ** 2)
    assert rows[45]["height_cm"] == 175.0 and rows[62]["admit_loc_grouped"] == "hospital" and rows[30]["race_grouped"] == "hispanic"


def test_single_gender_frame_is_coded_as_fitted(fitted, admits):
    men = admits.withColumn("gender", F.lit("M"))
    got = by_age(fitted.transform(men))[62]["height_cm"]
    stats = fitted.stats
    z = lambda c, v: (v - stats[c][0]) / stats[c][1]
    def weight(age, kg):  # height is missing, so three of four dimensions are shared at most
        dims = [z("age", 62) - z("age", age)] + ([z("weight_kg", 70) - z("weight_kg", kg)] if kg else []) + [0.0]
        return 1 / math.sqrt(4 / len(dims) * sum(d * d for d in dims))
    w = [weight(45, 80), weight(30, None)]
    assert got == pytest.approx((175 * w[0] + 160 * w[1]) / sum(w))


def test_fit_transform_equals_fit_then_transform(fitted, admits):
    assert by_age(AdmissionPreprocessor().fit_transform(admits)) == by_age(fitted.transform(admits))


def test_save_and_load_alone_and_in_a_pipeline(fitted, admits, tmp_path):
    path = str(tmp_path / "model")
    fitted.write().overwrite().save(path)
    assert by_age(AdmissionPreprocessorModel.load(path).transform(admits)) == by_age(fitted.transform(admits))
    model = Pipeline(stages=[AdmissionPreprocessor(neighbours=1)]).fit(admits)
    model.write().overwrite().save(path + "2")
    again = PipelineModel.load(path + "2")
    assert again.stages[0].getOrDefault("neighbours") == 1
    assert by_age(again.transform(admits)) == by_age(model.transform(admits))


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(3)
    n = 240
    sick = rng.random(n) < 0.3
    rows = []
    for i in range(n):
        row = {f.name: None for f in WIDE}
        row.update({
            "subject_id": i, "hadm_id": 1000 + i, "gender": "MF"[i % 2], "age": int(rng.integers(20, 95)),
            "admission_type": ["URGENT", "ELECTIVE", "EW EMER."][i % 3], "admission_location": ["PACU", None][i % 2],
            "marital_status": [None, "MARRIED"][i % 2], "race": ["WHITE", "ASIAN", "BLACK/AFRICAN"][i % 3],
            "height_in": None if i % 7 == 0 else float(rng.normal(66, 3)), "weight_lb": None if i % 11 == 0 else float(rng.normal(130 if sick[i] else 190, 15)),
            "blood_pressure": "120/80" if i % 5 else None, "glucose_admit": float(rng.normal(120, 20)),
            "hemoglobin_admit": None if i % 6 == 0 else float(rng.normal(8 if sick[i] else 13, 1)), "has_malnutrition": int(sick[i])})
        rows.append(tuple(row[f.name] for f in WIDE))
    return spark.createDataFrame(rows, WIDE)


@pytest.fixture(scope="module")
def prepared(wide):
    train_df, test_df, model = prepare_train_test(wide)
    return train_df.persist(), test_df.persist(), model


def test_prepared_frames_keep_the_contracts(prepared):
    train_df, test_df, _ = prepared
    assert train_df.count() + test_df.count() == 240
    assert set(train_df.columns) == {f.name for f in PROCESSED} | {"hadm_id"}
    assert domain_violations(train_df).count() == 0
    rules = {c: r for c, r in fixed.RANGE_RULES.items() if c in ("age", "height_cm", "weight_kg", "bmi", "glucose_admit")}
    assert range_violations(train_df, rules).count() == 0


def test_train_evaluate_gate_and_importance(prepared, spark, tmp_path):
    train_df, test_df, _ = prepared
    model, metrics = train.train_model(train_df, "hadm_id", QUICK)
    train.require_quality(metrics, {"accuracy": 0.4, "recall": 0.4})
    with pytest.raises(ValueError, match="accuracy"):
        train.require_quality(metrics, {"accuracy": 1.1})
    train.save_model(model, str(tmp_path / "m"))
    loaded = train.load_model(str(tmp_path / "m"))
    assert train.evaluate_model(loaded, test_df).first() == train.evaluate_model(model, test_df).first()
    scored = train.score_rows(model, test_df)
    assert scored.where("prediction <> int(score > 0.5) or score < 0 or score > 1").count() == 0
    top = train.feature_importance(model, 3).collect()
    assert len(top) == 3 and top[0]["feature"] in ("hemoglobin_admit", "weight_kg", "bmi")  # the columns themselves
    assert {r["feature"] for r in train.feature_importance(model, None).collect()} == set(model.binning.features)


def test_category_with_many_levels_and_unseen_values(spark):
    df = spark.range(400).select(F.concat(F.lit("c"), F.col("id") % 90).alias("kind"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    model = train.fit_classifier(df, QUICK, "y")
    fresh = spark.createDataFrame([("never seen", 1), (None, 0)], "kind string, y int")
    assert train.score_rows(model, fresh).count() == 2


def test_draw_candidates():
    space = fixed.SEARCH_SPACE
    drawn = train.draw_candidates(space, 64)
    assert len(drawn) == 64 and len({tuple(sorted(d.items(), key=str)) for d in drawn}) == 64
    assert drawn == train.draw_candidates(space, 64) and all(d[c] in space[c] for d in drawn for c in space)
    assert math.prod(len(v) for v in space.values()) == 4_800_000
    assert len(train.draw_candidates({"a": [1, 2], "b": [3]}, 10)) == 2


def test_random_search(prepared, spark):
    frame = prepared[0]
    space = {"n_estimators": [2], "max_depth": [2, 3], "learning_rate": [0.3], "class_weight": [None, "balanced"], "num_leaves": [15]}
    model, metrics, log = train.random_search(frame, "hadm_id", space=space, n_iter=2, folds=2, parallelism=2)
    log = log.persist()
    assert log.count() == 3 and set(metrics.columns) == set(fixed.METRIC_NAMES)
    best = runs.top_runs(log, 1).first()
    assert best["parent_run_id"] is not None and "search_iteration" in best["tags"]
    parent = log.where("parent_run_id is null").first()
    assert float(parent["params"]["best_search_value"]) == best["metrics"]["f1_score"]
    assert {r["name"] for r in runs.best_params(log).collect()} >= {"max_depth", "n_estimators", "num_leaves", "random_state"}
    with pytest.raises(ValueError, match="scoring"):
        train.random_search(frame, "hadm_id", scoring="f3")
