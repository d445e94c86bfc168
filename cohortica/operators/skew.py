"""Joins that stay balanced when one key holds a large share of the rows.

Two choices are made while the plan is built, both from counts that Spark computes:

* `lookup_join` broadcasts the right side only after measuring that it is small;
* `salted_join` spreads the rows of very frequent left keys over several tasks and repeats
  the matching right rows for each of them. No row is dropped and no key is capped;
* `grid_join` does the same where right keys are frequent too: left rows go to one of n parts, right rows to
  one of m, and each is repeated over the other's parts, so no task meets all rows of either side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024
ROWS_PER_TASK = 4_000_000
PROBE_FRACTION = 0.01

_SALT = "_salt"


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure rows and approximate bytes in one distributed aggregate."""
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
        if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))
        else F.lit(8)
        for f in df.schema.fields
    ]
    width = reduce(lambda a, b: a + b, widths) + F.lit(16)
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return size["n"] <= max_rows and size["b"] <= max_bytes


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "left",
                max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES, **probe_args) -> DataFrame:
    """Join to a table that may be small: broadcast if measured small, else with hot keys of both sides spread."""
    if is_small(right, max_rows, max_bytes):
        return left.join(F.broadcast(right), on, how)
    return grid_join(left, right, on, how, **probe_args)


def hot_keys(df: DataFrame, on, rows_per_task: int = ROWS_PER_TASK,
             fraction: float = PROBE_FRACTION) -> DataFrame | None:
    """All keys of more than `rows_per_task` rows, the missing key too, with the number of tasks to spread each over,
    or None if there are none.

    There are at most rows / `rows_per_task` of them, so what reaches the driver is a key per full task. The
    sample only steers balance, so its error cannot change results.
    """
    keys = [on] if isinstance(on, str) else list(on)
    probe = df.select(*keys)
    if fraction < 1.0:
        probe = probe.sample(fraction=fraction, seed=7)
    heavy = (
        probe.groupBy(*keys).agg((F.count(F.lit(1)) / F.lit(fraction)).alias("_rows"))
        .where(F.col("_rows") > rows_per_task)
        .select(*keys, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_salts"))
    )
    rows = heavy.collect()
    if not rows:
        return None
    return df.sparkSession.createDataFrame(rows, heavy.schema)


def salted_star(left: DataFrame, rights: list[DataFrame], on, how: str = "left",
                hot: DataFrame | None | str = "probe", **probe_args) -> DataFrame:
    """Join `left` to each right table on the same keys, salting the hot left keys once."""
    keys = [on] if isinstance(on, str) else list(on)
    if isinstance(hot, str):
        hot = hot_keys(left, keys, **probe_args)
    if hot is None:
        return reduce(lambda acc, right: acc.join(right, keys, how), rights, left)
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.col("_salts")).cast("int")
    # null-safe here: rows without a key match nothing, but they are spread as well
    named = hot.withColumnsRenamed({c: f"_hot_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_hot_{c}`")) for c in keys])
    out = (
        left.join(F.broadcast(named), same, "left")
        .withColumn(_SALT, F.coalesce(spread, F.lit(0))).drop("_salts", *[f"_hot_{c}" for c in keys])
    )
    for right in rights:
        copies = (
            right.join(F.broadcast(hot), keys, "left")
            .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
            .drop("_salts")
        )
        out = out.join(copies, [*keys, _SALT], how)
    return out.drop(_SALT)


def salted_join(left: DataFrame, right: DataFrame, on, how: str = "left",
                hot: DataFrame | None | str = "probe", **probe_args) -> DataFrame:
    """Equi-join (inner or left) with the hot left keys spread over several tasks."""
    if how not in ("inner", "left"):
        raise ValueError("salted joins keep every left row once: use inner or left")
    return salted_star(left, [right], on, how, hot, **probe_args)


def _spread(df: DataFrame, keys: list[str], own: str, other: str) -> DataFrame:
    """Rows with a part of their own side, by a hash of the row, repeated for every part of the other side."""
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c not in ("_n", "_m")]), F.col(own)).cast("int")
    return df.withColumn(f"{own}_part", part).withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), F.col(other) - 1))) \
        .drop("_n", "_m")


def grid_join(left: DataFrame, right: DataFrame, on, how: str = "left",
              hot: DataFrame | None | str = "probe", **probe_args) -> DataFrame:
    """Equi-join (inner or left) with the hot keys of both sides spread over a grid of tasks.

    `hot` gives the hot keys of the left side where they are known, so that a computed side need not be probed.

    Keys that are hot on the right exist there, so their left rows all find a match: they are joined inner, part by
    part, and repeats cannot make rows without a match. Everything else is a salted join.
    """
    if how not in ("inner", "left"):
        raise ValueError("grid joins keep every left row: use inner or left")
    keys = [on] if isinstance(on, str) else list(on)
    hot_left = hot_keys(left, keys, **probe_args) if isinstance(hot, str) else hot
    hot_right = hot_keys(right, keys, **probe_args)
    if hot_right is not None:
        hot_right = hot_right.dropna(subset=keys)
    if hot_right is None or hot_right.isEmpty():
        return salted_join(left, right, keys, how, hot_left)
    parts = hot_right.withColumnRenamed("_salts", "_m")
    parts = parts.withColumn("_n", F.lit(1)) if hot_left is None else \
        parts.join(hot_left.withColumnRenamed("_salts", "_n"), keys, "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    parts = F.broadcast(parts)
    cells = [_spread(df.join(parts, keys), keys, own, other).withColumnsRenamed({"_n_part": "_i", "_m_part": "_j"})
             for df, own, other in ((left, "_n", "_m"), (right, "_m", "_n"))]
    crowded = cells[0].join(cells[1], [*keys, "_i", "_j"]).drop("_i", "_j")
    rest = salted_join(left.join(parts, keys, "left_anti"), right.join(parts, keys, "left_anti"), keys, how, hot_left)
    return rest.unionByName(crowded)
