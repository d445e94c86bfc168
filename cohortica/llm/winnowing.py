"""Benchmark decontamination by winnowing, in DataFrame functions only.

A document's fingerprints are the smallest k-gram hashes of each window of consecutive k-grams. A shared span
of k + window - 1 words holds one whole window, so both sides keep the same smallest hash of it: every
shared span of that length is found. Fingerprints are joined with those of the benchmark, and each hit is
extended to the word windows around it, which are compared as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cohortica.llm.shared import checkpoint, digest, small_side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 10
GRAM = 5


def words(text: Column) -> Column:
    """Array of the words of a text: A-Z lower-cased, runs of 0-9, a-z and characters beyond ASCII; NULL has none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, NOT_WORD), "")


def _span(start: Column, stop: Column) -> Column:
    """start..stop, empty if stop is below start."""
    return F.when(stop >= start, F.sequence(start, stop)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(df: DataFrame, k: int) -> DataFrame:
    return df.withColumn("grams", F.transform(_span(F.lit(1), F.size("words") - (k - 1)),
                                              lambda i: F.xxhash64(F.slice("words", i, k))))


def _fingerprints(df: DataFrame, k: int, window: int) -> Column:
    """Distinct smallest hashes over all windows of `window` k-grams of the column grams."""
    return F.array_distinct(F.transform(_span(F.lit(1), F.size("grams") - (window - 1)),
                                        lambda j: F.array_min(F.slice("grams", j, window))))


def _item_windows(items: DataFrame, item_id: str, text: str, span: int) -> DataFrame:
    """(item_id, length, window): every `span` words of an item in a row; an item of fewer words is one window."""
    split = items.select(F.col(item_id).cast("string").alias("item_id"), words(F.col(text)).alias("words"))
    split = split.withColumn("length", F.least(F.lit(span), F.size("words"))).where("length > 0")
    starts = _span(F.lit(1), F.size("words") - F.col("length") + 1)
    return split.select("item_id", "length", F.explode(F.transform(
        starts, lambda i: F.array_join(F.slice("words", i, F.col("length")), " "))).alias("window")).distinct()


def _hits(docs: DataFrame, windows: DataFrame, length: int, gram: int) -> DataFrame:
    """(digest, start, length, items_key) of each occurrence in `docs` of a benchmark window of `length` words."""
    k = min(gram, length)
    wide = length - k + 1
    text = windows.select(F.split("window", " ").alias("words"), "window", "items_key")
    prints = checkpoint(_gram_hashes(text.select("words"), k)
                        .select(F.explode(_fingerprints(text, k, wide)).alias("print")).distinct())
    prints = small_side(prints)
    # find: documents that keep a fingerprint of the benchmark
    split = docs.select("digest", words(F.col("text")).alias("words")).where(F.size("words") >= length)
    kept = _gram_hashes(split, k).select("digest", F.explode(_fingerprints(split, k, wide)).alias("print"))
    found = small_side(checkpoint(kept.join(prints, "print", "left_semi").select("digest").distinct()))
    # extend: the k-grams of those documents that hit, with all words a window around them can hold
    near = docs.join(found, "digest", "left_semi").dropDuplicates(["digest"]).select("digest", words(F.col("text")).alias("words"))
    first = lambda i: F.greatest(F.lit(1), i - (wide - 1))
    around = near.select("digest", "words", F.size("words").alias("n")).select("digest", F.inline(F.transform(
        _span(F.lit(1), F.col("n") - (k - 1)),
        lambda i: F.struct(F.xxhash64(F.slice("words", i, k)).alias("print"), first(i).alias("first"),
                           F.slice("words", first(i), i + (length - 1) - first(i) + 1).alias("near")))))
    around = around.join(prints, "print", "left_semi")
    placed = around.select("digest", F.inline(F.transform(
        _span(F.lit(0), F.size("near") - length),
        lambda o: F.struct((F.col("first") + o).alias("start"),
                           F.array_join(F.slice("near", o + 1, length), " ").alias("window")))))
    return (placed.join(small_side(windows.select("window", "items_key")), "window")
            .select("digest", "start", F.lit(length).alias("length"), "items_key").distinct())


def contaminated_words(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(digest, n_hit, n_items, items_sha256) of each different text with a hit; digest as in shared.digest.

    A text's rows are looked up by its digest, so copies are searched once. Items of fewer than `span` words
    have k-grams and windows fitted to their length, in one more pass for each such length.
    """
    windows = _item_windows(items, item_id, item_text, span)
    # windows with the same items share a key, so that a passage of many items is not repeated for each
    # occurrence; items without an id count as hits and are listed nowhere
    windows = windows.groupBy("length", "window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    windows = checkpoint(windows.withColumn("items_key", F.unhex(F.md5(F.to_json("items").cast("binary")))))
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most `span` values
    texts = docs.select(digest(F.col(text)).alias("digest"), F.col(text).alias("text"))
    parts = [_hits(texts, windows.where(F.col("length") == n), n, gram) for n in lengths]
    if not parts:
        return docs.sparkSession.createDataFrame([], "digest binary, n_hit long, n_items long, items_sha256 string")
    hits = checkpoint(reduce(DataFrame.union, parts))
    covered = F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1))))
    spans = hits.groupBy("digest").agg(F.size(covered).cast("long").alias("n_hit"))
    lists = windows.select("items_key", "items").dropDuplicates(["items_key"])
    listed = (hits.select("digest", "items_key").distinct().join(lists, "items_key")
              .select("digest", F.explode("items").alias("item")).groupBy("digest")
              .agg(F.array_join(F.sort_array(F.collect_set("item")), ",").alias("ids"), F.count_distinct("item").alias("n_items")))
    return spans.join(listed, "digest", "left").select(
        "digest", "n_hit", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")).cast("binary"), 256).alias("items_sha256"))


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of `docs`.

    NULL and wordless texts have no words and no hits. Rows with equal texts get equal results, repeated ids
    each have their row. An empty benchmark or table is fine. Other columns are left alone.
    """
    hit = contaminated_words(docs, items, text, item_id, item_text, span, gram)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.size(words(F.col(text))).cast("long").alias("n_words"),
                       digest(F.col(text)).alias("digest"))
    zero = F.lit(0).cast("long")
    return rows.join(hit, "digest", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """`docs`, all its columns, without the rows whose text has a hit."""
    hit = contaminated_words(docs, items, text, **options).select("digest")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("digest", digest(F.col(f"row.`{text}`")))
    return rows.join(hit, "digest", "left_anti").select("row.*")
