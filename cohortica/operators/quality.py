"""Data quality: nulls, duplicates, ranges, exact descriptive statistics, contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from cohortica import fixed
from cohortica.operators.clean import nulls_for_nans
from cohortica.operators.running import materialize, running_totals
from cohortica.operators.skew import lookup_join


def _quoted(name: str):
    return F.col(f"`{name}`")


def check_data_quality(df: DataFrame, numeric_columns: list[str]) -> DataFrame:
    """One row: row count, nulls, null share of all cells (percent), repeated rows, ranges.

    Counts and ranges are one aggregate. For repeated rows only a 128-bit digest of each row is shuffled; whole
    rows are compared where a digest occurs more than once. Columns that do not exist are skipped.
    """
    df = nulls_for_nans(df)
    columns = [_quoted(c) for c in df.columns]
    nulls = reduce(lambda a, b: a + b, [c.isNull().cast("int") for c in columns])
    keyed = df.withColumns({"_one": F.xxhash64(*columns), "_two": F.xxhash64(F.lit(1), *columns)})
    again = keyed.groupBy("_one", "_two").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_one", "_two")
    repeated = lookup_join(keyed, materialize(again), ["_one", "_two"], "inner")
    duplicates = repeated.groupBy(*columns).agg((F.count(F.lit(1)) - 1).alias("_more")).agg(F.coalesce(F.sum("_more"), F.lit(0)))
    present = [c for c in numeric_columns if c in df.columns]
    report = df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("total_nulls"),
        *[f(_quoted(c)).cast("double").alias(f"{c}_{n}")
          for c in present for f, n in ((F.min, "min"), (F.max, "max"))],
    )
    cells = F.col("total_rows").cast("double") * F.lit(float(len(df.columns)))
    share = F.round(F.try_divide(F.col("total_nulls").cast("double") * 100.0, cells), 2)
    return report.select("total_rows", "total_nulls", share.alias("null_percentage"), duplicates.scalar().alias("duplicate_rows"),
                         *[f"`{c}_{n}`" for c in present for n in ("min", "max")])


def column_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, min, max) ignoring missing values; absent columns are skipped. No shuffle of rows."""
    present = [c for c in columns if c in df.columns]
    df = nulls_for_nans(df.select(*[_quoted(c) for c in present]))
    one = df.agg(*[f(_quoted(c)).cast("double").alias(f"{i}{n}")
                   for i, c in enumerate(present) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{i}lo").alias("min_value"),
                              F.col(f"{i}hi").alias("max_value")) for i, c in enumerate(present)])
    return one.select(F.inline(rows))


def structure_summary(df: DataFrame) -> DataFrame:
    """(column, type, non-null count, rows) from one aggregate without a shuffle of rows."""
    df = nulls_for_nans(df)
    one = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count(_quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"c{i}").alias("non_null"), F.col("n").alias("total_rows"))
        for i, f in enumerate(df.schema)])
    return one.select(F.inline(rows))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, n) for numeric columns; missing values left out, pre-aggregated."""
    df = nulls_for_nans(df.select(*[_quoted(c).cast("double").alias(c) for c in columns]))
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), _quoted(c).alias("value")) for c in columns])
    return (df.select(F.inline(cells)).where("value is not null")
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per column.

    Values are counted first; their ranks come from distributed running totals.
    """
    counts = value_counts(df, columns)
    ranked = running_totals(counts, "value", ["n"], group=["feature"])
    first, last = F.col("before_n"), F.col("before_n") + F.col("n") - 1

    def at(position):
        return F.max(F.when((first <= position) & (position <= last), F.col("value")))

    parts, out = [], []
    for name, q in probabilities.items():
        position = (F.col("total_n") - 1).cast("double") * F.lit(float(q))
        low = F.floor(position)
        parts += [at(low).alias(f"{name}_lo"), at(F.least(low + 1, F.col("total_n") - 1)).alias(f"{name}_hi"),
                  F.max(position - low).alias(f"{name}_f")]
        out.append((F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * F.col(f"{name}_f")).alias(name))
    return ranked.groupBy("feature").agg(*parts).select("feature", *out)


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max of each column."""
    clean = nulls_for_nans(df.select(*[_quoted(c).cast("double").alias(c) for c in columns]))
    stats = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min_value": F.min, "max_value": F.max}
    one = clean.agg(*[f(_quoted(c)).alias(f"{i}_{s}") for i, c in enumerate(columns) for s, f in stats.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{i}_{s}").alias(s) for s in stats])
                     for i, c in enumerate(columns)])
    quartiles = exact_quantiles(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return (one.select(F.inline(rows)).join(quartiles, "feature", "left")
            .select("feature", "n", "mean", "std", "min_value", "q25", "q50", "q75", "max_value"))


def range_violations(df: DataFrame, rules: dict = fixed.RANGE_RULES) -> DataFrame:
    """(column, low, high, violations) for each rule with at least one bad value."""
    return range_check(df, rules).where("violations > 0")


def range_check(df: DataFrame, rules: dict = fixed.RANGE_RULES) -> DataFrame:
    """Bad values per rule: outside the inclusive range, or NULL where that is not allowed."""
    absent = [c for c in rules if c not in df.columns]
    if absent:
        raise ValueError(f"columns missing from the data: {absent}")
    df = nulls_for_nans(df.select(*[_quoted(c) for c in rules]))

    def bad(name, low, high, null_allowed):
        outside = ~_quoted(name).between(low, high)
        return F.count_if(F.coalesce(outside, F.lit(not null_allowed)))

    one = df.agg(*[bad(c, *rule).alias(f"v{i}") for i, (c, rule) in enumerate(rules.items())])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"),
                 F.col(f"v{i}").alias("violations"))
        for i, (c, (low, high, _)) in enumerate(rules.items())])
    return one.select(F.inline(rows))


def domain_violations(df: DataFrame, rules: dict = fixed.DOMAIN_RULES) -> DataFrame:
    """(column, value, n) for values outside the allowed list; a missing column is an error.

    NULL is not a value of the list and is reported as a value of its own.
    """
    absent = [c for c in rules if c not in df.columns]
    if absent:
        raise ValueError(f"columns missing from the data: {absent}")
    kinds = {f.name: f.dataType for f in df.schema}

    def allowed_value(name, allowed):
        """Numbers are compared as numbers, so that 1.0 is 1; everything else as text."""
        if isinstance(kinds[name], T.NumericType) and all(isinstance(v, (int, float)) for v in allowed):
            return _quoted(name).isin(list(allowed))
        return _quoted(name).cast("string").isin([str(v) for v in allowed])

    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), _quoted(c).cast("string").alias("value"),
                 F.coalesce(allowed_value(c, allowed), F.lit(False)).alias("ok"))
        for c, allowed in rules.items()])
    return (df.select(F.inline(cells)).where("not ok")
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def unexpected_values(observed: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Distinct observed values that the allowed table lacks (set difference)."""
    return observed.select(column).distinct().subtract(allowed.select(column))


def count_matching(df: DataFrame, condition) -> DataFrame:
    return df.agg(F.count_if(condition).alias("matching"), F.count(F.lit(1)).alias("total"))


def top_rows(df: DataFrame, by: str, n: int, tie_break: list[str]) -> DataFrame:
    """The n largest by one column, missing last, ties settled by the given columns."""
    return df.orderBy(F.desc_nulls_last(by), *tie_break).limit(n)


def head_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """A preview: the first n rows in the given order (a table itself has none)."""
    return df.orderBy(*order).limit(n)
