"""Running totals over a globally sorted column without a single-task window."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; fall back to a temporary one in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="cohortica-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later branches read the same rows, also after executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _bounds(df: DataFrame, order: str, group: list[str], parts: int) -> list[tuple]:
    """Ascending (group values, order value) bounds that cut the rows of `df` into about `parts` buckets.

    One aggregate: approximate percentiles per group, of which a group gets its share by its rows. Groups
    are few, so at most groups x parts numbers reach the driver, and parts + groups bounds remain.
    """
    shares = [i / parts for i in range(1, parts)] + [1.0]
    groups = df.groupBy(*group).agg(
        F.percentile_approx(order, shares, 100 * parts).alias("_cuts"), F.count(order).alias("_rows")).collect()
    rows = sum(g["_rows"] for g in groups)
    found = set()
    for g in groups:
        if g["_rows"]:
            step = max(1, rows // g["_rows"])  # every step-th percentile, the last one included
            found |= {(*[g[c] for c in group], cut) for cut in g["_cuts"][::-1][::step]}
    null_first = lambda bound: [(v is not None, v != v, 0 if v is None or v != v else v) for v in bound]
    return sorted(found, key=null_first)


def _bucket(df: DataFrame, keys: list[str], bounds: list[tuple]):
    """Number of bounds below a row's keys, by nested halving: a function of the row alone."""
    types = [df.schema[k].dataType for k in keys]
    place = F.struct(*[F.col(f"`{k}`").alias(f"_{i}") for i, k in enumerate(keys)])

    def halve(low, high):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        bound = F.struct(*[F.lit(v).cast(t).alias(f"_{i}") for i, (v, t) in enumerate(zip(bounds[middle], types))])
        return F.when(place <= bound, halve(low, middle)).otherwise(halve(middle + 1, high))

    return halve(0, len(bounds))


def bucketed(df: DataFrame, order: str, group: list[str] = ()) -> DataFrame:
    """Rows with `_bucket`, which ascends with (group, order); a bucket is one task of one exchange.

    The bounds are literals of the plan, so a retried task and every branch that reads the rows see the same
    buckets without a checkpoint, and branches of one plan share the exchange. NULL sorts first, NaN last.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(df, order, list(group), parts)
    return (df.withColumn("_bucket", _bucket(df, [*group, order], bounds))
            .repartitionById(len(bounds) + 1, F.col("_bucket")))


def running_totals(df: DataFrame, order: str, sums: list[str], group: list[str] = (),
                   following: str | None = None) -> DataFrame:
    """Add `before_<c>`, the sum of c over rows that sort earlier, and `total_<c>`, over all rows.

    `df` holds one row per (group, order) value, i.e. it is already aggregated; it may come from
    `bucketed`. `order` is numeric. `group` names columns with few values (a feature name). With `following`,
    also add the next order value.

    One exchange: rows go to ordered buckets; sums of buckets (at most buckets + groups rows) come from the
    same exchange and are broadcast as offsets to a running sum that is local to each bucket.
    """
    group = list(group)
    ranged = df if "_bucket" in df.columns else bucketed(df, order, group)
    edges = ranged.groupBy("_bucket", *group).agg(
        *[F.sum(c).alias(f"_sum_{c}") for c in sums], F.min(order).alias("_first"))
    whole = Window.partitionBy(*group)
    by_bucket = whole.orderBy("_bucket")
    prior = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    offsets = edges.select(
        F.col("_bucket").alias("_in"), *[F.col(f"`{g}`").alias(f"_of_{g}") for g in group],
        *[F.coalesce(F.sum(f"_sum_{c}").over(prior), F.lit(0)).alias(f"_off_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(whole).alias(f"total_{c}") for c in sums],
        F.lead("_first").over(by_bucket).alias("_next_first"),
    )
    local = Window.partitionBy("_bucket", *group).orderBy(order)
    local_prior = local.rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.select("*", *[F.coalesce(F.sum(c).over(local_prior), F.lit(0)).alias(f"_loc_{c}") for c in sums],
                        F.lead(order).over(local).alias("_next_local"))
    same = reduce(lambda a, b: a & b, [F.col(f"`{g}`").eqNullSafe(F.col(f"`_of_{g}`")) for g in group],
                  F.col("_bucket") == F.col("_in"))
    out = out.join(F.broadcast(offsets), same)
    added = [(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"before_{c}") for c in sums]
    if following:
        added.append(F.coalesce("_next_local", "_next_first").alias(following))
    return out.select(*[c for c in ranged.columns if c != "_bucket"], *added, *[f"total_{c}" for c in sums])
