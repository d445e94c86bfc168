"""Small helpers of the text operators: size-checked broadcasts, checkpoints, row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortica.operators.running import ensure_checkpoint_dir

#: A side is broadcast only when it was counted and holds no more rows than this (some tens of MB).
BROADCAST_ROWS = 200_000


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster shares; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it holds at most `rows` rows, else unchanged (Spark then shuffles).

    Counting stops at rows + 1. Use it on sides that are cheap to compute or already checkpointed.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def digest(text: Column) -> Column:
    """16 bytes that stand for a whole text; NULL counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
