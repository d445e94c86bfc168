"""Secret scans with multipart linking, in DataFrame functions only.

Strong findings (assign, access, hex) are reported wherever they stand. Weak candidates (user names and key
names, bare 40-character keys, endpoints) are reported only when the parts that complete a credential
stand within the same scope: an interval join of identifiers, secrets and endpoints of one text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortica.llm.shared import checkpoint, digest

#: Kind, pattern, group whose length counts, least length. Weak kinds follow the strong ones.
STRONG = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
)
WEAK = (
    ("name", r"""(?i:(username|user|login|account|client_?id|key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]+)""", 2, 3),
    ("key", "[A-Za-z0-9+/]{40,}", 0, 40),
    ("endpoint", r"(?:https?|postgres|mysql|mongodb|redis|amqp|ftp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+", 0, 10),
)
KINDS = STRONG + WEAK
#: A weak kind is reported if, for each group listed, a span of one of its kinds stands within the scope.
COMPLEMENTS = {
    "name": (("assign", "hex", "key"),),
    "key": (("access", "name", "endpoint"),),
    "endpoint": (("access", "name"), ("assign", "hex", "key")),
}
#: Characters between two spans of one credential, at most.
SCOPE = 200


def _numbered(kinds: tuple[str, ...]) -> list[int]:
    return [i for i, kind in enumerate(KINDS) if kind[0] in kinds]


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """(digest, kind, start, end) of every span of every different text; kind is its number in KINDS, code points,
    end exclusive. A pattern's matches and the pieces between them alternate, so places are running sums of
    their lengths; texts without any match are passed over by one test.
    """
    some = reduce(Column.__or__, [F.col("text").rlike(pattern) for _, pattern, _, _ in KINDS])
    found = (docs.select(F.col(text).alias("text")).where(some).select("text", digest(F.col("text")).alias("digest"))
             .dropDuplicates(["digest"]))
    parts = [F.struct(F.lit(i).alias("kind"), F.split("text", pattern, -1).alias("between"),
                      F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("matches"),
                      F.regexp_extract_all("text", F.lit(pattern), F.lit(group)).alias("values"))
             for i, (_, pattern, group, _) in enumerate(KINDS)]
    each = found.select("digest", F.inline(F.array(*parts))).where(F.size("matches") > 0)
    rows = each.select("digest", "kind", F.posexplode(F.arrays_zip("matches", "values", "between"))).where(
        "col.matches is not null")  # the last piece follows the last match
    rows = rows.select("digest", "kind", "pos", F.length("col.between").alias("gap"), F.length("col.matches").alias("size"),
                       F.length("col.values").alias("counted"))
    upto = Window.partitionBy("digest", "kind").orderBy("pos")  # the matches of one kind in one text
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
    least = F.element_at(F.array(*[F.lit(kind[3]) for kind in KINDS]), F.col("kind") + 1)
    exact = (F.col("kind") != _numbered(("key",))[0]) | (F.col("size") == 40)
    return rows.where((F.col("counted") >= least) & exact).select(
        "digest", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans whose complements stand at most `scope` characters away, without overlap.

    Spans meet in buckets of characters, so that a text full of spans compares near ones only; partners are
    only asked for (semi-joins), never listed.
    """
    width = 2 * scope
    buckets = lambda low, high: F.sequence(F.floor(low / width), F.floor(high / width))
    kept = []
    for kind, groups in COMPLEMENTS.items():
        weak = spans.where(F.col("kind") == _numbered((kind,))[0])
        for group in groups:
            near = weak.withColumn("bucket", F.explode(buckets(F.col("start") - scope, F.col("end") + scope)))
            other = spans.where(F.col("kind").isin(_numbered(group))).select(
                "digest", F.col("start").alias("from"), F.col("end").alias("to"),
                F.explode(buckets(F.col("start"), F.col("end"))).alias("bucket"))
            meets = ((near.digest == other.digest) & (near.bucket == other.bucket)
                     & (((other["from"] >= near.end) & (other["from"] <= near.end + scope))
                        | ((other["to"] <= near.start) & (other["to"] >= near.start - scope))))
            weak = near.join(other, meets, "left_semi").drop("bucket").distinct()
        kept.append(weak)
    return reduce(DataFrame.union, kept)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(kind[0]) for kind in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans), one row per row of `docs`: the strong spans, and all spans,
    as kind:start:end joined by commas, by start and kind.

    NULL and empty texts have none. Texts are looked up by their digest, so copies are scanned once and
    repeated rows and ids each have their row. An empty table gives no rows. Other columns are left alone.
    """
    spans = checkpoint(candidates(docs, text))
    strong = spans.where(F.col("kind") < len(STRONG))
    reported = strong.union(linked(spans, scope))
    count = lambda i: F.count_if(F.col("kind") == i)
    place = F.struct("start", "kind", "end")
    by_text = reported.groupBy("digest").agg(
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        _joined(F.collect_list(F.when(F.col("kind") < len(STRONG), place))).alias("base"),
        _joined(F.collect_list(place)).alias("spans"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("digest"))
    zero = F.lit(0).cast("long")
    return rows.join(by_text, "digest", "left").select(
        "doc_id", *[F.coalesce(c, zero).alias(c) for c in ("n_assign", "n_access", "n_hex")],
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("base", "spans")])
