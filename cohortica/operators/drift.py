"""Distribution drift between a reference and a current period, for every shared column.

Both periods are counted per (feature, value) in one shuffle; all statistics work on those
counts. Missing values are left out of both sides. Features are columns, so per-feature tables
are as small as the schema and safe to broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from cohortica import fixed
from cohortica.functions import chi_square_tail, kolmogorov_tail, normal_two_sided_tail
from cohortica.operators.clean import nulls_for_nans
from cohortica.operators.running import bucketed, materialize, running_totals

_FEATURE = ["feature"]


def shared_columns(reference: DataFrame, current: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric, categorical) names found on both sides."""
    def numeric(df):
        return {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    both = [c for c in reference.columns if c in current.columns]
    num = numeric(reference) & numeric(current)
    return [c for c in both if c in num], [c for c in both if c not in num]


def side_counts(reference: DataFrame, current: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """(feature, value, a, b): rows of each value in the reference (a) and the current period (b)."""
    def cells(df, is_reference):
        df = nulls_for_nans(df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c in columns]))
        flags = [F.lit(int(is_reference)).alias("a"), F.lit(int(not is_reference)).alias("b")]
        rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value"), *flags) for c in columns])
        return df.select(F.inline(rows)).where("value is not null")

    return (cells(reference, True).unionByName(cells(current, False))
            .groupBy("feature", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))


def _totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("feature").agg(F.sum("a").alias("total_a"), F.sum("b").alias("total_b"))


def _with_totals(counts: DataFrame) -> DataFrame:
    return counts.join(F.broadcast(_totals(counts)), "feature")


def _both_sides():
    """Inside an aggregate per feature: does each period have values? Otherwise the score is NULL."""
    return (F.max("total_a") > 0) & (F.max("total_b") > 0)


def _cdf_gap():
    upto_a, upto_b = F.col("before_a") + F.col("a"), F.col("before_b") + F.col("b")
    return F.abs(F.try_divide(upto_a.cast("double"), F.col("total_a")) - F.try_divide(upto_b.cast("double"), F.col("total_b")))


def ranked_counts(counts: DataFrame) -> DataFrame:
    """Counts with earlier and total counts per feature, the following value and the deviation.

    The population deviation of the reference is taken in two passes over the counts of one
    exchange, around the mean.
    """
    ranged = bucketed(counts, "value", _FEATURE)
    rows = F.sum("a").cast("double")
    centre = ranged.groupBy("feature").agg(F.try_divide(F.sum(F.col("a") * F.col("value")), rows).alias("centre"))
    off = F.col("value") - F.col("centre")
    deviation = (ranged.join(F.broadcast(centre), "feature").groupBy("feature")
                 .agg(F.sqrt(F.try_divide(F.sum(F.col("a") * off * off), rows)).alias("deviation")))
    ranked = running_totals(ranged, "value", ["a", "b"], group=_FEATURE, following="next_value")
    return ranked.join(F.broadcast(deviation), "feature")


def wasserstein(ranked: DataFrame, normed: bool = True) -> DataFrame:
    """(feature, distance): area between the two distribution functions, over the reference deviation."""
    area = F.coalesce(F.sum(_cdf_gap() * (F.col("next_value") - F.col("value"))), F.lit(0.0))
    unit = F.greatest(F.max("deviation"), F.lit(fixed.DRIFT_MIN_SCALE)) if normed else F.lit(1.0)
    return ranked.groupBy("feature").agg(F.when(_both_sides(), area / unit).alias("distance"))


def kolmogorov_smirnov(ranked: DataFrame) -> DataFrame:
    """(feature, distance, p_value) of the two-sample test, asymptotic p-value."""
    return (ranked.groupBy("feature")
            .agg(F.max(_cdf_gap()).alias("distance"), F.max("total_a").alias("n_a"), F.max("total_b").alias("n_b"))
            .select("feature", "distance", F.when(
                F.col("distance").isNotNull(), kolmogorov_tail(F.col("distance"), F.col("n_a"), F.col("n_b"))).alias("p_value")))


def bin_counts(counts: DataFrame) -> DataFrame:
    """Numeric counts in equal-width bins over both periods; bins = ceil(log2(rows)) + 1."""
    span = counts.groupBy("feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"),
        (F.ceil(F.log2(F.sum(F.col("a") + F.col("b")).cast("double"))) + 1).cast("int").alias("bins"))
    place = F.when(F.col("hi") > F.col("lo"), F.least(
        F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("bins")), F.col("bins") - 1)).otherwise(0)
    return (counts.join(F.broadcast(span), "feature").groupBy("feature", place.alias("value"))
            .agg(F.sum("a").alias("a"), F.sum("b").alias("b")))


def jensen_shannon(counts: DataFrame) -> DataFrame:
    """(feature, distance): square root of the divergence in natural log."""
    p = F.try_divide(F.col("a").cast("double"), F.col("total_a"))
    q = F.try_divide(F.col("b").cast("double"), F.col("total_b"))
    middle = (p + q) / 2.0
    part = lambda share: F.when(share > 0, share * F.ln(share / middle)).otherwise(0.0)
    return (_with_totals(counts).groupBy("feature")
            .agg(F.when(_both_sides(), F.sqrt(F.greatest(F.sum(0.5 * part(p) + 0.5 * part(q)), F.lit(0.0))))
                 .alias("distance")))


def chi_square(counts: DataFrame) -> DataFrame:
    """(feature, statistic, degrees, new_values, p_value) of the current counts against reference shares.

    A value the reference never had makes the p-value zero.
    """
    expected = F.col("total_b") * F.try_divide(F.col("a").cast("double"), F.col("total_a"))
    gap = F.col("b") - expected
    part = F.when(F.col("a") > 0, F.try_divide(gap * gap, expected)).otherwise(0.0)
    stats = (_with_totals(counts).groupBy("feature").agg(
        F.when(_both_sides(), F.sum(part)).alias("statistic"),
        (F.count_if(F.col("a") > 0) - 1).alias("degrees"),
        F.count_if(F.col("a") == 0).alias("new_values")))
    tail = F.when(F.col("statistic").isNull(), None).when(F.col("new_values") > 0, 0.0).when(F.col("degrees") < 1, 1.0) \
        .otherwise(chi_square_tail(F.col("statistic"), F.col("degrees")))
    return stats.withColumn("p_value", tail)


def proportion_z(counts: DataFrame) -> DataFrame:
    """(feature, z, p_value) for the share of the smallest value of a two-valued feature."""
    firsts = counts.groupBy("feature").agg(
        F.min_by("a", "value").alias("x"), F.min_by("b", "value").alias("y"),
        F.sum("a").cast("double").alias("n_a"), F.sum("b").cast("double").alias("n_b"))
    pooled = F.try_divide(F.col("x") + F.col("y"), F.col("n_a") + F.col("n_b"))
    gap = F.try_divide(F.col("x"), F.col("n_a")) - F.try_divide(F.col("y"), F.col("n_b"))
    spread = F.sqrt(pooled * (1.0 - pooled) * (F.try_divide(F.lit(1.0), "n_a") + F.try_divide(F.lit(1.0), "n_b")))
    # A feature with one value on both sides has no spread and no gap; a missing side gives NULL.
    z = F.when(gap.isNotNull(), F.coalesce(F.try_divide(gap, spread), F.lit(0.0)))
    return firsts.select("feature", z.alias("z")).withColumn("p_value", normal_two_sided_tail(F.col("z")))


#: Score of each test; distances first, then p-values.
TESTS = {
    "wasserstein": lambda c: wasserstein(ranked_counts(c)).select("feature", F.col("distance").alias("score")),
    "jensen_shannon": lambda c: jensen_shannon(c).select("feature", F.col("distance").alias("score")),
    "kolmogorov_smirnov": lambda c: kolmogorov_smirnov(ranked_counts(c)).select("feature", F.col("p_value").alias("score")),
    "chi_square": lambda c: chi_square(c).select("feature", F.col("p_value").alias("score")),
    "proportion_z": lambda c: proportion_z(c).select("feature", F.col("p_value").alias("score")),
}
DISTANCES = ("wasserstein", "jensen_shannon")
NUMBERS_ONLY = ("wasserstein", "kolmogorov_smirnov")


def _scores(counts: DataFrame, chosen: dict[str, str]) -> DataFrame:
    """(feature, method, score) by the test chosen for each feature."""
    tests = list(dict.fromkeys(chosen.values()))
    if len(tests) > 1:
        counts = materialize(counts)

    def scored(test):
        rows = counts.where(F.col("feature").isin([f for f, t in chosen.items() if t == test]))
        return TESTS[test](rows).withColumn("method", F.lit(test))

    return reduce(DataFrame.unionByName, map(scored, tests))


def drift_features(reference: DataFrame, current: DataFrame, numeric: str = "wasserstein",
                   text: str = "jensen_shannon", methods: dict[str, str] | None = None) -> DataFrame:
    """(feature, method, threshold, drift_score, drifted) for every shared column.

    `numeric` and `text` name the test of each kind of column, `methods` that of single columns; the size of
    the data plays no part. Distances drift at or above the threshold, p-values below it. A column without
    values in one period has no score and is not called drifted; one without values in both has no row.
    """
    numbers, texts = shared_columns(reference, current)
    if not numbers and not texts:
        raise ValueError("the two periods share no column")
    chosen = {**dict.fromkeys(numbers, numeric), **dict.fromkeys(texts, text), **(methods or {})}
    for feature, test in chosen.items():
        if feature not in (*numbers, *texts):
            raise ValueError(f"the two periods do not share the column {feature!r}")
        if test not in TESTS or (feature in texts and test in NUMBERS_ONLY):
            raise ValueError(f"{test!r} is not a test for the column {feature!r}")
    parts = [_scores(side_counts(reference, current, columns, kind), {c: chosen[c] for c in columns})
             for columns, kind in ((numbers, "double"), (texts, "string")) if columns]
    scores = reduce(DataFrame.unionByName, parts)
    distance = F.col("method").isin(*DISTANCES)
    threshold = F.when(distance, fixed.DRIFT_DISTANCE_THRESHOLD).otherwise(fixed.DRIFT_P_THRESHOLD)
    drifted = F.when(distance, F.col("score") >= threshold).otherwise(F.col("score") < threshold)
    drifted = F.coalesce(drifted, F.lit(False))
    return scores.select("feature", "method", threshold.alias("threshold"),
                         F.round("score", 4).alias("drift_score"), drifted.alias("drifted"))


def drift_summary(features: DataFrame, period: str) -> DataFrame:
    """One row: features looked at, drifted ones, their share, and whether the dataset drifted."""
    share = F.try_divide(F.count_if("drifted"), F.count(F.lit(1)))
    return features.agg(
        F.count(F.lit(1)).alias("total_features"), F.count_if("drifted").alias("drifted_features"),
        F.round(share, 3).alias("drift_share"),
        (share >= fixed.DRIFT_DATASET_SHARE).alias("dataset_drift"),
    ).select(F.lit(period).alias("period"), "*")
