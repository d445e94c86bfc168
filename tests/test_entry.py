"""Every registered query against its SQL at the smallest scale, and the plans of the large ones."""

import math

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if value is None:
        return ("null",)
    if isinstance(value, (int, float)):
        return ("nan",) if math.isnan(value) else ("number", round(float(value), 5) + 0.0)
    return ("text", str(value))


def test_entry_runs(spark):
    assert len(driver.entry(spark).columns) == 29


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = driver.queries()[name](spark, FOLDER)
    cursor = duck.execute(driver.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in cursor.fetchall())
    assert sorted(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()) == want


@pytest.mark.parametrize("name", ["cohort_wide", "knn_impute", "stratified_split", "stratified_folds", "threshold_sweep",
                                  "binary_metrics", "drift_wasserstein", "describe_numeric", "class_report", "finished_runs"])
def test_no_cross_joins(spark, name):
    plan = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = driver.queries()["cohort_pivot"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in plan and "l_tax" not in plan and "l_discount" not in plan
