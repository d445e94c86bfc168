"""Mixing sources to target weights: repetition rates per source, hash-seeded copies per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortica.llm.shared import BROADCAST_ROWS, checkpoint

WORDS = r"[^\x20\x09-\x0D]+"
MAX_REPEAT = 3
#: Weights of the sources in code point order, NULL last, repeated.
CYCLE = (1, 2, 3)


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def uniform(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) that depends on seed and values alone: 52 bits of an md5."""
    parts = [F.coalesce(c.cast("string"), F.lit("~")) for c in columns]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, source_size): words of each source, over all rows; combined before the shuffle."""
    return (docs.groupBy(F.col(source).alias("source")).agg(F.sum(word_count(F.col(text))).alias("source_size")))


def cycled_weights(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """Add `weight` to (source, source_size): the cycle along the sources in code point order, NULL last.

    The table has one row per source. Sources are numbered within ranges of the sorted names, and the
    numbers of rows of earlier ranges are added, so no task sees all of them.
    """
    ranged = checkpoint(sizes.repartitionByRange(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy("part").count()
    before = counts.select("part", (F.sum("count").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))  # a row per range
    number = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("source")))
    place = (number - 1 + F.coalesce("before", F.lit(0))) % len(cycle)
    weights = F.element_at(F.array(*map(F.lit, cycle)), (place + 1).cast("int"))
    return ranged.join(F.broadcast(before), "part").select("source", "source_size", weights.cast("double").alias("weight"))


def targets(weighted: DataFrame, most: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target): all sizes shared by weight, none above `most` times its source's size.

    While the level (words per weight) lifts some source above its limit, that source takes its limit and
    the rest is shared again; each round is one aggregate over the sources, and only three sums return.
    Sources without words have target 0; so have all if there are no words.
    """
    weighted = checkpoint(weighted)
    limit = F.col("source_size") * F.lit(float(most))
    level, total = 0.0, weighted.agg(F.sum("source_size")).first()[0] or 0
    while True:
        capped = F.col("weight") * F.lit(level) >= limit
        fixed, weight = weighted.agg(F.sum(F.when(capped, limit)), F.sum(F.when(~capped, F.col("weight")))).first()
        if not weight:  # no words, or all at their limits
            break
        again = (float(total) - (fixed or 0.0)) / weight
        if again <= level:
            break
        level = again
    target = F.least(F.col("weight") * F.lit(level), limit)
    return weighted.select("source", "source_size", target.alias("target"))


def with_copies(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 42,
                cycle: tuple[int, ...] = CYCLE, most: float = MAX_REPEAT) -> DataFrame:
    """(row, doc_id, size, source_size, target, copies): every document as a struct, with how often the mix takes it.

    A document comes floor(rate) times, rate = target / source_size, and once more if its hash falls below
    the fraction; the hash is of seed, doc_id and text, so reruns and retried tasks agree. Texts without words
    have size 0 and the rate of their source; a source without any words has rate 0. NULL sources are one
    source, the last. Repeated rows get equal numbers of copies. The table of targets holds one row per
    source; it is broadcast if counted small, else joined by shuffle, where Spark splits a hot source.
    """
    rates = targets(cycled_weights(source_sizes(docs, source, text), cycle), most)
    if rates.count() <= BROADCAST_ROWS:
        rates = F.broadcast(rates)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col(f"row.`{doc_id}`").alias("doc_id"), F.col(f"row.`{source}`").alias("from"),
                       word_count(F.col(f"row.`{text}`")).alias("size"),
                       uniform(seed, F.col(f"row.`{doc_id}`"), F.md5(F.col(f"row.`{text}`").cast("binary"))).alias("draw"))
    joined = rows.join(rates, F.col("from").eqNullSafe(rates["source"]))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    rate = F.coalesce(rate, F.lit(0.0))
    copies = F.floor(rate) + F.when(F.col("draw") < rate - F.floor(rate), 1).otherwise(0)
    return joined.select("row", "doc_id", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """`docs`, all its columns, each row repeated as often as the mix takes it (see with_copies)."""
    taken = with_copies(docs, **options).where("copies > 0")
    return taken.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
