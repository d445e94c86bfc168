"""Standard scaling and dummy encoding with fitted state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortica.operators.clean import nulls_for_nans


def fit_scaler(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column ignoring missing values; zero deviation counts as 1."""
    clean = nulls_for_nans(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]))
    row = clean.agg(*[f(F.col(f"`{c}`")).alias(f"{n}{i}") for i, c in enumerate(columns)
                      for f, n in ((F.avg, "m"), (F.stddev_pop, "s"))]).first()
    stats = {}
    for i, c in enumerate(columns):
        if row[f"m{i}"] is None:
            raise ValueError(f"column {c!r} has no values to fit on")
        stats[c] = (float(row[f"m{i}"]), float(row[f"s{i}"]) or 1.0)
    return stats


def scale(df: DataFrame, stats: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s)
                           for c, (m, s) in stats.items()})


def unscale(df: DataFrame, stats: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": F.col(f"`{c}{suffix}`") * F.lit(s) + F.lit(m)
                           for c, (m, s) in stats.items()})


def fit_levels(df: DataFrame, column: str, max_levels: int = 1000) -> list[str]:
    """Sorted category levels seen at fit time."""
    rows = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v")).distinct() \
        .orderBy("v").limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"{column!r} has more than {max_levels} levels; not a category")
    return [r["v"] for r in rows]


def encode_dummies(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """One 0/1 column per fitted level but the first; NULL and unseen levels are all zero."""
    return df.withColumns({
        f"{column}_{level}": F.when(F.col(column).cast("string") == level, 1.0).otherwise(0.0)
        for level in levels[1:]})
