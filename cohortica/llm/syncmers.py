"""Document fingerprints from closed syncmers.

A k-mer is chosen when the smallest of its inner s-mers (by hash) is its first or its last one. The choice
depends on the k-mer alone, not on what surrounds it, so a passage keeps its anchors wherever it stands,
and anchors of two texts are matched by position. A fingerprint keeps the smallest anchor in each of 64
slots; the share of equal slots estimates how many anchors two texts have in common.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortica.llm.shared import partitions

K = 12
S = 5
SLOTS = 64
_BASE = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = 0xFFFF


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _gram_hashes(codes: np.ndarray, starts: np.ndarray | None, size: int) -> np.ndarray:
    """Hash of the `size` characters from each start on (from all starts if None)."""
    count = len(codes) - size + 1
    out = np.zeros(count if starts is None else len(starts), np.uint64)
    for i in range(size):
        out = out * _BASE + (codes[i:i + count] if starts is None else codes[starts + i])
    return _mix(out)


def _block_anchors(codes: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    inner = _gram_hashes(codes, None, s)
    wide = k - s + 1  # s-mers in a k-mer
    least, have = inner, 1
    while have < wide:  # the smallest of `have` s-mers from each place on
        step = min(have, wide - have)
        least, have = np.minimum(least[:-step], least[step:]), have + step
    at = np.flatnonzero((least == inner[:len(least)]) | (least == inner[wide - 1:]))
    return at, _gram_hashes(codes, at, k)


def anchors(text: str, k: int = K, s: int = S, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the closed syncmers of a whole text, in code points.

    A text of fewer than k characters, but not none, is one anchor. Long texts are taken in blocks that
    overlap by k - 1 characters, which changes nothing: the choice of a k-mer needs no neighbours.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(codes) < k:
        return np.zeros(1, np.int64), _gram_hashes(codes, None, len(codes))
    places, hashes = [], []
    for at in range(0, len(codes) - k + 1, block):
        place, found = _block_anchors(codes[at:at + block + k - 1], k, s)
        places.append(place + at)
        hashes.append(found)
    return np.concatenate(places), np.concatenate(hashes)


def sketch(hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """16 bits for each slot: those of the smallest anchor hash that falls into it; 0xFFFF if none does."""
    best = np.full(slots, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(best, (hashes % np.uint64(slots)).astype(np.int64), hashes)
    low = (best >> np.uint64(8)) & np.uint64(0xFFFF)
    return np.where(best == np.iinfo(np.uint64).max, _EMPTY, np.minimum(low, np.uint64(_EMPTY - 1))).astype(np.uint16)


def as_text(found: np.ndarray) -> str:
    """Lower-case hex, four digits a slot."""
    return found.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal slots among those that either text fills: 0 to 1. Two empty texts are alike."""
    filled = (a != _EMPTY) | (b != _EMPTY)
    return float(((a == b) & filled).sum() / filled.sum()) if filled.any() else 1.0


def matched_span(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n_chars: int,
                 k: int = K) -> tuple[int, int, int]:
    """(offset, first, characters) of two texts' anchors: the shift b - a on which most of them agree (ties: the
    smallest), with the first place in `a`, of n_chars characters, and the length that those anchors cover; (0, 0, 0) if
    none agree. Of an anchor that a text repeats the first place counts."""
    (at_a, hash_a), (at_b, hash_b) = a, b
    _, ia, ib = np.intersect1d(hash_a, hash_b, return_indices=True)
    if not len(ia):
        return 0, 0, 0
    moved = at_b[ib] - at_a[ia]
    shifts, counts = np.unique(moved, return_counts=True)
    best = shifts[np.argmax(counts)]
    own = at_a[ia][moved == best]
    return int(best), int(own.min()), int(min(own.max() + k, n_chars) - own.min())


def edited(text: str, other: str) -> str:
    """`text` with its last floor(n/2) characters replaced by the first as many (or all) of `other`."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


# ---- each document with the next one ------------------------------------------------------------------------------

def _buckets(ids: DataFrame, count: int) -> tuple[list, dict[int, int]]:
    """(ascending inner bounds of up to `count` buckets of ids, largest id of each bucket that has rows).

    Bucket 0 is for NULL; bucket b >= 1 holds ids above bounds[b - 2] and up to bounds[b - 1].
    """
    cuts = [i / count for i in range(1, count)]
    found = ids.agg(F.percentile_approx("doc_id", cuts, 10_000)).first()[0] if cuts else None
    bounds = sorted({b for b in found or []})

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, int] = {}
        for batch in batches:
            values = batch.column(0).to_numpy()
            for b in np.unique(where := np.searchsorted(bounds, values) + 1).tolist():
                best[b] = max(best.get(b, -(1 << 63)), int(values[where == b].max()))
        yield pa.RecordBatch.from_pydict({"b": pa.array(list(best), pa.int64()), "top": pa.array(list(best.values()), pa.int64())})

    rows = (ids.where("doc_id is not null").mapInArrow(tops, "b long, top long").groupBy("b").agg(F.max("top")).collect())
    return bounds, {r[0]: r[1] for r in rows}  # a row per bucket


def with_next(docs: DataFrame, doc_id: str, text: str, schema: str, each) -> DataFrame:
    """each(documents with their next ones) on every document in descending order of id, as rows of `schema`.

    The next document has the next smaller id; NULL ids follow, rows with one id are in order of their text,
    and after the last comes the first. `each` gets an iterator of (doc_id, text, text of the next) and
    gives record batches. Whole texts are shuffled once: ids are cut into ranges, and the first document of a
    range also goes, as a guest, to the range before it.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds, tops = _buckets(plain.select("doc_id"), partitions(docs))
    lowest = plain.where("doc_id is null").agg(F.min("text")).first()[0]  # the first of those without an id, if any
    ranks = sorted(tops, reverse=True) + ([0] if lowest is not None else [])
    before = {b: ranks[i - 1] for i, b in enumerate(ranks)}  # the bucket whose last document precedes b's first

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            missing = np.asarray(ids.is_null())
            values = ids.fill_null(0).to_numpy()
            bucket = np.where(missing, 0, np.searchsorted(bounds, values) + 1).astype(np.int64)
            guests = [i for i in range(len(values)) if (texts[i].as_py() == lowest if missing[i] else tops[bucket[i]] == values[i])]
            for rows, to, guest in ((None, bucket, 0), (guests, [before[b] for b in bucket[guests].tolist()], 1)):
                part = batch if rows is None else batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int64()), pa.array(np.full(part.num_rows, guest), pa.int32()), part.column(0), part.column(1)],
                    ["bucket", "guest", "doc_id", "text"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, place = None, None  # the document whose next one is awaited, and its bucket
        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for b, guest, key, t in zip(*columns, batch.column(3)):
                if b != place:
                    held, place = None, b
                if held is not None:
                    yield *held, t.as_py()
                held = None if guest else (key, t.as_py())

    order = [F.col("bucket"), F.col("guest"), F.desc_nulls_last("doc_id"), F.col("text")]
    dealt = plain.mapInArrow(deal, "bucket long, guest int, doc_id long, text string")
    # one bucket a task: buckets are numbered from 0 (NULL) to at most len(bounds) + 1
    spread = dealt.repartitionById(len(bounds) + 2, F.col("bucket").cast("int")).sortWithinPartitions(*order)
    return spread.mapInArrow(lambda batches: each(pairs(batches)), schema)


FINGERPRINTS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double, kept_chars long, next_offset long, next_first long, next_chars long")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, s: int = S,
                 slots: int = SLOTS, rows: int = 1000) -> DataFrame:
    """Fingerprints of every text and of its edited text (see edited), and how near they and the next document's are.

    kept_chars is the length of the span that the text shares with its edited text in one place; next_first and
    next_chars are the span that it shares with the next document, next_offset characters further on there (see
    matched_span); all are 0 where no anchor agrees. Very long texts are hashed in blocks; their anchors, about a
    quarter of the characters, are held for three texts at a time.

    NULL counts as the empty text, whose slots are all empty. One row per row of `docs`; repeated rows and ids
    each have theirs. A single document is its own next one. An empty table gives no rows. Other columns are
    left alone.
    """

    def measure(t: str) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        found = anchors(t, k, s)
        return found, sketch(found[1], slots)

    def each(documents: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        known: tuple = (None, None, None)  # the next document is measured once

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                              [f.split()[0] for f in FINGERPRINTS.split(", ")])

        for key, own, after in documents:
            places, mine = known[1:] if known[0] == own else measure(own)
            next_places, other = measure(after)
            changed = edited(own, after)
            new_places, new = measure(changed)
            out.append((key, len(own), hashlib.sha256(changed.encode()).hexdigest(), as_text(mine), as_text(new),
                        likeness(mine, new), likeness(mine, other), matched_span(places, new_places, len(own), k)[2],
                        *matched_span(places, next_places, len(own), k)))
            known = (after, next_places, other)
            if len(out) == rows:
                yield batch()
                out.clear()
        if out:
            yield batch()

    return with_next(docs, doc_id, text, FINGERPRINTS, each)
