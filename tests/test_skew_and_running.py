import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortica.operators import skew
from cohortica.operators.cohort import windowed_pivot
from cohortica.operators import running
from cohortica.operators.running import running_totals
from cohortica.operators.skew import hot_keys, is_small, lookup_join, salted_join, salted_star

EVERY = {"rows_per_task": 100, "fraction": 1.0}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows carry key 7, some have no key."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("k"), "id")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_hot_keys_finds_the_heavy_key_only(skewed):
    hot = {r["k"]: r["_salts"] for r in hot_keys(skewed, "k", **EVERY).collect()}
    assert list(hot) == [7] and hot[7] >= 10
    assert hot_keys(skewed, "k", rows_per_task=10_000, fraction=1.0) is None


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    right = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    right = right.unionByName(right.where("k < 10").withColumn("v", F.lit(-1)))  # several matches per key
    got = salted_join(skewed, right, "k", how, **EVERY)
    assert rows(got.select("k", "id", "v")) == rows(skewed.join(right, "k", how).select("k", "id", "v"))


def test_salted_rows_spread_over_tasks(spark, skewed):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        right = spark.range(400).select(F.col("id").alias("k"))
        joined = salted_join(skewed, right, "k", "inner", **EVERY)
        parts = joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert parts > 4


def test_many_hot_keys_and_missing_keys(spark):
    many = spark.range(20_000).select((F.col("id") % 5000).alias("k"), "id")
    assert hot_keys(many, "k", rows_per_task=2, fraction=1.0).count() == 5000
    half = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 700).alias("k"), "id")
    hot = {r["k"]: r["_salts"] for r in hot_keys(half, "k", **EVERY).collect()}
    assert hot == {None: 10}
    right = spark.range(400).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    right = right.unionByName(spark.createDataFrame([(None, 2)], "k long, v int"))
    for how in ("left", "inner"):
        got = salted_join(half, right, "k", how, **EVERY).select("k", "id", "v")
        assert rows(got) == rows(half.join(right, "k", how).select("k", "id", "v"))


def test_salted_star_and_other_kinds(spark, skewed):
    a = spark.range(400).select(F.col("id").alias("k"), F.lit("a").alias("a"))
    b = spark.range(5, 8).select(F.col("id").alias("k"), F.lit("b").alias("b"))
    got = salted_star(skewed, [a, b], "k", **EVERY).select("k", "id", "a", "b")
    assert rows(got) == rows(skewed.join(a, "k", "left").join(b, "k", "left").select("k", "id", "a", "b"))
    with pytest.raises(ValueError):
        salted_join(skewed, a, "k", "right")


def test_lookup_join_broadcasts_only_small_tables(spark, skewed):
    right = spark.range(400).select(F.col("id").alias("k"))
    assert is_small(right) and not is_small(right, max_rows=10) and not is_small(right, max_bytes=100)
    small = lookup_join(skewed, right, "k")
    assert "hint" in small._jdf.queryExecution().analyzed().toString().lower()
    big = lookup_join(skewed, right, "k", max_rows=10)
    assert "hint" not in big._jdf.queryExecution().analyzed().toString().lower()
    assert rows(small.select("k", "id")) == rows(big.select("k", "id"))


def test_pivot_with_hot_key_equals_plain(spark):
    events = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 90).alias("key"), (F.col("id") % 4).alias("item"),
        (F.lit("2150-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") % 60).cast("int"))).alias("at"),
        F.col("id").cast("double").alias("v"))
    dictionary = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "item long, label string")
    anchors = spark.range(90).select(F.col("id").alias("key"), (
        F.lit("2150-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") % 5).cast("int"))).alias("start"))
    args = dict(item="item", key="key", event_time="at", anchor_time="start", hours=24, label="label", value="v",
                measures={"x": "x", "y": "y"})
    plain = windowed_pivot(events, dictionary, anchors, **args)
    salted = windowed_pivot(events, dictionary, anchors, **args, max_rows=1, **EVERY)
    assert rows(plain) == rows(salted) and plain.count() > 20


@pytest.mark.parametrize("values", ["spread", "heavy"])
def test_running_totals(spark, values):
    rng = np.random.default_rng(2)
    v = rng.normal(size=2000).round(3) if values == "spread" else np.r_[np.zeros(900), rng.lognormal(3, 3, size=100)]
    pdf = pd.DataFrame({"g": np.where(np.arange(len(v)) % 5 == 0, "p", "q"), "v": v, "n": rng.integers(1, 9, len(v))})
    pdf = pdf.groupby(["g", "v"], as_index=False)["n"].sum()
    got = running_totals(spark.createDataFrame(pdf), "v", ["n"], ["g"], following="nxt").toPandas()
    got = got.sort_values(["g", "v"]).reset_index(drop=True)
    want = pdf.sort_values(["g", "v"]).reset_index(drop=True)
    groups = want.groupby("g")
    assert (got["before_n"] == groups["n"].cumsum() - want["n"]).all()
    assert (got["total_n"] == groups["n"].transform("sum")).all()
    np.testing.assert_array_equal(got["nxt"].to_numpy(float), groups["v"].shift(-1).to_numpy(float))


def test_running_totals_without_groups_and_empty(spark):
    df = spark.createDataFrame([(3.0, 1), (1.0, 2), (2.0, 4)], "v double, n long")
    got = {r["v"]: r["before_n"] for r in running_totals(df, "v", ["n"]).collect()}
    assert got == {1.0: 0, 2.0: 2, 3.0: 6}
    assert running_totals(df.where("v > 9"), "v", ["n"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_left", [True, False])
def test_grid_join_of_keys_that_are_hot_on_both_sides(spark, how, hot_left):
    left = spark.range(900 if hot_left else 60).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("k"),
                                                       F.lit("z").alias("kind"), F.col("id").alias("a"))
    right = spark.range(500).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 40).alias("k"),
                                    F.lit("z").alias("kind"), F.col("id").alias("b"))
    want = left.join(right, ["k", "kind"], how)
    got = skew.grid_join(left, right, ["k", "kind"], how, rows_per_task=50, fraction=1.0)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    plain = skew.grid_join(left, right.where("k <> 7"), ["k", "kind"], how, rows_per_task=50, fraction=1.0)
    assert plain.count() == left.join(right.where("k <> 7"), ["k", "kind"], how).count()


def test_a_task_of_a_grid_join_meets_a_part_of_either_side(spark):
    left, right = (spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias(c)) for n, c in ((400, "a"), (300, "b")))
    one = skew._spread(left.withColumns({"_n": F.lit(8), "_m": F.lit(6)}), ["k"], "_n", "_m")
    two = skew._spread(right.withColumns({"_n": F.lit(8), "_m": F.lit(6)}), ["k"], "_m", "_n")
    cells = one.groupBy("_n_part", "_m_part").count().collect(), two.groupBy("_n_part", "_m_part").count().collect()
    assert [len(c) for c in cells] == [48, 48]
    assert max(r["count"] for r in cells[0]) < 100 and max(r["count"] for r in cells[1]) < 100
    assert skew.grid_join(left, right, "k", "left", rows_per_task=50, fraction=1.0).count() == 120_000


def test_running_totals_with_missing_and_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    data = [(g, v, 1 + i) for g in (None, "a", "b") for i, v in enumerate([None, -inf, -2.5, 0.0, 7.0, inf, nan])]
    df = spark.createDataFrame(data, "g string, v double, n long").repartition(3)
    got = {(r["g"], str(r["v"])): (r["before_n"], r["total_n"]) for r in running_totals(df, "v", ["n"], ["g"]).collect()}
    assert got == {(g, str(v)): (sum(range(1, n)), 28) for g, v, n in data}


def test_running_totals_read_one_exchange_without_a_checkpoint(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") % 1000).cast("double").alias("v"))
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, "v", ["n"], ["g"])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "ExistingRDD" not in plan
    ranked.collect()
    final = ranked._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Exchange shufflepartitionidpassthrough") == 2 and final.count("ReusedExchange") == 1
    sizes = [r["count"] for r in running.bucketed(counts, "v", ["g"]).groupBy("_bucket").count().collect()]
    assert max(sizes) <= 2 * 3000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
