import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortica.functions.tails import chi_square_tail, normal_two_sided_tail
from cohortica.operators import drift
from cohortica.plans.jobs import get_drift_summary, write_drift_report


def counts(spark, a, b, kind="double"):
    x = spark.createDataFrame(pd.DataFrame({"v": a}))
    y = spark.createDataFrame(pd.DataFrame({"v": b}))
    return drift.side_counts(x, y, ["v"], kind)


def cdf_gap(a, b):
    grid = np.unique(np.r_[a, b])
    gap = np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b))
    return grid, gap


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(8)
    return rng.normal(size=700).round(2), rng.normal(0.3, 1.2, size=500).round(2)


def test_wasserstein_and_ks(spark, samples):
    a, b = samples
    grid, gap = cdf_gap(a, b)
    ranked = drift.ranked_counts(counts(spark, a, b))
    assert drift.wasserstein(ranked, normed=False).first()["distance"] == pytest.approx((gap[:-1] * np.diff(grid)).sum())
    assert drift.wasserstein(ranked).first()["distance"] == pytest.approx((gap[:-1] * np.diff(grid)).sum() / a.std())
    ks = drift.kolmogorov_smirnov(ranked).first()
    rate = -2 * gap.max() ** 2 * 700 * 500 / 1200
    p = 2 * sum((-1) ** (j - 1) * math.exp(rate * j * j) for j in range(1, 101))
    assert ks["distance"] == pytest.approx(gap.max()) and ks["p_value"] == pytest.approx(p)


def test_same_data_and_constant(spark, samples):
    a, _ = samples
    ranked = drift.ranked_counts(counts(spark, a, a))
    assert drift.wasserstein(ranked).first()["distance"] == 0 and drift.kolmogorov_smirnov(ranked).first()["p_value"] == 1.0
    flat = drift.ranked_counts(counts(spark, np.zeros(5), np.ones(5)))
    assert drift.wasserstein(flat).first()["distance"] == pytest.approx(1000.0)  # the scale has a floor


def test_jensen_shannon(spark):
    c = counts(spark, ["a", "a", "b"], ["a", "b", "b", "c"], "string")
    p, q = np.array([2 / 3, 1 / 3, 0]), np.array([0.25, 0.5, 0.25])
    m = (p + q) / 2
    want = math.sqrt(0.5 * sum(x * math.log(x / y) for x, y in zip(p, m) if x) + 0.5 * sum(x * math.log(x / y) for x, y in zip(q, m) if x))
    assert drift.jensen_shannon(c).first()["distance"] == pytest.approx(want)


def test_bins_cover_every_row(spark, samples):
    a, b = samples
    binned = drift.bin_counts(counts(spark, a, b)).toPandas()
    edges = np.histogram_bin_edges(np.r_[a, b], bins=int(np.ceil(np.log2(1200))) + 1)
    assert binned["a"].sum() == 700 and binned["b"].sum() == 500 and len(binned) <= len(edges) - 1


def test_chi_square(spark):
    c = counts(spark, ["a"] * 50 + ["b"] * 30 + ["c"] * 20, ["a"] * 30 + ["b"] * 40 + ["c"] * 30, "string")
    r = drift.chi_square(c).first()
    want = (30 - 50) ** 2 / 50 + (40 - 30) ** 2 / 30 + (30 - 20) ** 2 / 20
    assert r["statistic"] == pytest.approx(want) and r["degrees"] == 2 and r["p_value"] == pytest.approx(math.exp(-want / 2))
    fresh = drift.chi_square(counts(spark, ["a", "b"], ["a", "z"], "string")).first()
    assert fresh["new_values"] == 1 and fresh["p_value"] == 0.0


@pytest.mark.parametrize("x,k,p", [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05),
                                   (18.307038053275146, 10, 0.05), (0.0, 4, 1.0), (24.99579013972863, 15, 0.05)])
def test_chi_square_tail(spark, x, k, p):
    df = spark.createDataFrame([(x, k)], "x double, k long").select(chi_square_tail(F.col("x"), F.col("k")).alias("p"))
    assert df.first()["p"] == pytest.approx(p, rel=1e-9)


def finite_sum(x, k):
    """P(X >= x) as the sum that whole and half numbers of degrees allow."""
    half, terms = x / 2, [math.erfc(math.sqrt(x / 2)) if k % 2 else math.exp(-x / 2)]
    shape = 0.5 if k % 2 else 1.0
    while shape < k / 2:
        terms.append(math.exp(shape * math.log(half) - half - math.lgamma(shape + 1)))
        shape += 1
    return math.fsum(terms)


def test_chi_square_tail_at_all_sizes(spark):
    rows = [(k * f + d, k) for k in (1, 2, 3, 7, 24, 101, 1000, 10_001, 100_000, 1_000_000) for f in (0.5, 0.9, 1.0, 1.02, 1.5) for d in (0.0, 2.5)]
    df = spark.createDataFrame(rows + [(float("nan"), 3), (None, 3), (1.0, 0), (1.0, None), (-1.0, 2), (0.0, 5)], "x double, k long")
    tail = df.withColumn("p", chi_square_tail(F.col("x"), F.col("k")))
    assert "Python" not in tail._jdf.queryExecution().toString()
    got = [r["p"] for r in tail.collect()]
    for (x, k), p in zip(rows, got):
        assert p == pytest.approx(min(finite_sum(x, k), 1.0), rel=1e-6, abs=1e-12), (x, k)
    assert got[len(rows):] == [None, None, None, None, 1.0, 1.0]


def test_normal_tail(spark):
    zs = [0.0, 0.1, -1.0, 1.96, 3.5, -6.0, None]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select(normal_two_sided_tail(F.col("z")).alias("p")).collect()
    assert [r["p"] for r in got[:-1]] == pytest.approx([math.erfc(abs(z) / math.sqrt(2)) for z in zs[:-1]], rel=1e-9) and got[-1]["p"] is None


def test_proportion_z(spark):
    r = drift.proportion_z(counts(spark, [0.0] * 60 + [1.0] * 40, [0.0] * 30 + [1.0] * 70)).first()
    z = (0.6 - 0.3) / math.sqrt(0.45 * 0.55 * (1 / 100 + 1 / 100))
    assert r["z"] == pytest.approx(z) and r["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)))
    same = drift.proportion_z(counts(spark, [1.0] * 5, [1.0] * 5)).first()
    assert same["z"] == 0.0 and same["p_value"] == 1.0


def frame(n, shift, seed):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({
        "lab": rng.normal(10 + shift, 2, n), "steady": rng.normal(size=n), "flag": rng.integers(0, 2, n),
        "level": rng.integers(0, 4, n), "kind": rng.choice(["x", "y", "z"], n, p=[0.5, 0.3, 0.2] if not shift else [0.1, 0.2, 0.7]),
        "pair": rng.choice(["M", "F"], n), "only_here": 1.0})


NAMED = {"lab": "kolmogorov_smirnov", "steady": "kolmogorov_smirnov", "flag": "proportion_z", "level": "chi_square",
         "kind": "chi_square", "pair": "proportion_z"}
DEFAULT = {**dict.fromkeys(["lab", "steady", "flag", "level"], "wasserstein"), **dict.fromkeys(["kind", "pair"], "jensen_shannon")}


@pytest.mark.parametrize("n,methods", [(400, NAMED), (1500, NAMED), (1500, None)])
def test_named_tests_and_direction(spark, tmp_path, n, methods):
    """The same tests at every size: those named, else distances."""
    a, b = frame(n, 0, 1), frame(n, 3, 2).drop(columns="only_here")
    b.loc[:20, "lab"] = np.nan
    options = {"methods": methods} if methods else {}
    summary, features = get_drift_summary(spark.createDataFrame(a), spark.createDataFrame(b), "Q1", **options)
    got = {r["feature"]: r for r in features.collect()}
    assert {f: r["method"] for f, r in got.items()} == (methods or DEFAULT)
    assert {f for f, r in got.items() if r["drifted"]} == {"lab", "kind"}
    s = summary.first()
    assert (s["period"], s["total_features"], s["drifted_features"], s["drift_share"], s["dataset_drift"]) == ("Q1", 6, 2, 0.333, False)
    write_drift_report(summary, features, str(tmp_path / "new" / "report"))
    assert spark.read.parquet(str(tmp_path / "new" / "report" / "features")).count() == 6


@pytest.mark.parametrize("n", [20, 1200])
def test_a_period_without_values(spark, n):
    a = pd.DataFrame({"lab": np.arange(n, dtype=float), "kind": ["x", "y"] * (n // 2), "more": ["x", "y"] * (n // 2), "flag": [0.0, 1.0] * (n // 2)})
    b = spark.createDataFrame([(1.0,)] * 5, "z double").select(
        F.lit(None).cast("double").alias("lab"), F.lit(None).cast("string").alias("kind"), F.lit("x").alias("more"),
        F.lit(None).cast("double").alias("flag"))
    for x, y in [(spark.createDataFrame(a), b), (b, spark.createDataFrame(a))]:
        got = {r["feature"]: r for r in drift.drift_features(x, y).collect()}
        assert set(got) == set(a.columns)
        for f in ["lab", "kind", "flag"]:
            assert got[f]["drift_score"] is None and got[f]["drifted"] is False
        assert got["more"]["drift_score"] is not None


def test_no_shared_column_and_unfit_tests(spark):
    with pytest.raises(ValueError):
        drift.drift_features(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "b int"))
    text = spark.createDataFrame([("x",)], "a string")
    for options in ({"text": "wasserstein"}, {"text": "none"}, {"methods": {"b": "chi_square"}}):
        with pytest.raises(ValueError):
            drift.drift_features(text, text, **options)


def test_ks_p_value_near_one(spark):
    from cohortica.functions.tails import kolmogorov_tail

    rows = [(d, 5000, 5000) for d in (0.0, 0.0001, 0.0002, 0.0003, 0.001, 0.003, 0.004)] + [(0.02, 5000, 5000), (0.03, 5000, 5000)]
    df = spark.createDataFrame(rows, "d double, a long, b long")
    got = [r[0] for r in df.select(kolmogorov_tail(*[df[c] for c in "dab"])).collect()]
    for (d, a, b), p in zip(rows, got):
        size = math.sqrt(a * b / (a + b)) * d
        # the dual series converges where the other does not
        dual = 1.0 if size == 0 else 1 - math.sqrt(2 * math.pi) / size * sum(
            math.exp(-((2 * j - 1) * math.pi) ** 2 / (8 * size * size)) for j in range(1, 200))
        assert p == pytest.approx(dual, abs=1e-9)
