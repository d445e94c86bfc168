"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits are cut into parts of correlated bits. Two fingerprints at distance <= tau agree,
in at least one part i, up to threshold[i] bits, whenever the thresholds sum to tau - parts + 1 (-1 leaves
a part out). Thresholds are chosen by dynamic programming on estimated probes and candidates; probes meet
exact part values in one shuffle, and every candidate is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from cohortica.llm.components import components
from cohortica.llm.shared import checkpoint, partitions

BITS = 64
SEED = 42
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


# ---- fingerprints -------------------------------------------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = 3, block: int = 1 << 18) -> int:
    """SimHash of the word shingles of a whole text: bit i is set if it is set in over half the shingle hashes.

    A-Z is lower-cased, words are runs without ASCII white space; fewer words than `shingle` make one
    shingle, none make fingerprint 0. Hashes are taken in blocks, so long texts need bounded memory.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    count = len(words) - width + 1
    ones = np.zeros(BITS, np.int64)
    of = xxhash.xxh64_intdigest
    for at in range(0, count, block):
        spans = zip(starts[at:min(at + block, count)].tolist(), ends[at + width - 1:at + width - 1 + block].tolist())
        hashes = np.array([of(joined[s:e], SEED) for s, e in spans], np.uint64).view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            ones[byte * 8:byte * 8 + 8] += np.bincount(hashes[:, byte], minlength=256) @ _BYTE_BITS
    return int(np.packbits(ones * 2 > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """Replace the column `text` by `fp`, its fingerprint's 64 bits as a long; one row per input row."""
    others = [c for c in docs.columns if c != text]
    schema = docs.select(*others).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(text)]
            column = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), column], [*others, "fp"])

    return docs.mapInArrow(run, schema)


# ---- plan of parts and thresholds ---------------------------------------------------------------------------------

def bit_statistics(nodes: DataFrame, column: str = "fp") -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for every two bits, how many have both set; over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            bits = ((values[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            both += (bits.T @ bits).astype(np.int64)
            total += len(values)
        if total:
            cells = np.append(both.ravel(), total)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    sums = dict(nodes.select(column).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect())
    both = np.array([sums.get(i, 0) for i in range(BITS * BITS)], np.float64).reshape(BITS, BITS)
    return sums.get(BITS * BITS, 0), both


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """`parts` groups of bits of near-equal size; each next bit is the one most correlated with its group."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    ties = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(ties, 0)
    left, groups = set(range(BITS)), []
    for part in range(parts):
        size = len(left) // (parts - part)
        group = [min(left, key=lambda b: (-ties[b, sorted(left)].sum(), b))]
        left.discard(group[0])
        while len(group) < size:
            best = min(left, key=lambda b: (-ties[b, group].sum(), b))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def _part_costs(n: int, both: np.ndarray, group: list[int], tau: int) -> list[float]:
    """Estimated rows dealt out plus candidate pairs of one part, for thresholds -1, 0, ..., tau."""
    p = both[group, group] / max(n, 1)
    near = np.array([1.0])  # distribution of the number of differing bits of two random fingerprints
    for differ in 2 * p * (1 - p):
        near = np.convolve(near, [1 - differ, differ])
    costs = [0.0]
    for t in range(tau + 1):
        probes = sum(comb(len(group), d) for d in range(1, t + 1)) / 2 + 1
        costs.append(n * probes + n * (n - 1) / 2 * near[:t + 1].sum())
    return costs


def allocate(n: int, both: np.ndarray, groups: list[list[int]], tau: int) -> tuple[float, list[int]]:
    """Thresholds (>= -1, sum tau - parts + 1) of least estimated cost, by dynamic programming over the parts."""
    best = {0: (0.0, [])}  # by the sum of (threshold + 1) so far
    for group in groups:
        costs, after = _part_costs(n, both, group, tau), {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, tau + 1):
                entry = (cost + costs[t + 1], [*chosen, t])
                if used + t + 1 <= tau + 1 and (used + t + 1 not in after or entry < after[used + t + 1]):
                    after[used + t + 1] = entry
        best = after
    return best[tau + 1]


def plan(n: int, both: np.ndarray, tau: int, parts: tuple[int, ...] = (2, 3, 4)) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part in use. Every choice finds the same pairs; only the cost differs."""
    options = []
    for count in parts:
        groups = group_bits(n, both, count)
        options.append((*allocate(n, both, groups, tau), groups))
    _, thresholds, groups = min(options, key=lambda o: o[0])
    return [(g, t) for g, t in zip(groups, thresholds) if t >= 0]


# ---- links --------------------------------------------------------------------------------------------------------

def _part_values(fps: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.uint64)
    for at, bit in enumerate(group):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(at)
    return out


def _deal(nodes: DataFrame, chosen: list[tuple[list[int], int]]) -> DataFrame:
    """(key, fp, probe): each fingerprint under its own part values, and as a probe under larger values nearby.

    Of two values that differ, only the smaller one's fingerprint probes the larger value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for part, (group, threshold) in enumerate(chosen):
                own = _part_values(fps, group)
                top = np.uint64(part) << np.uint64(60)
                for d in range(threshold + 1):
                    for flips in combinations(range(len(group)), d):
                        keys = own ^ np.uint64(sum(1 << f for f in flips))
                        keep = keys > own if d else np.ones(len(own), bool)
                        # bits of part and value lie apart for parts of up to 58 bits; parts have 32 at most
                        yield pa.RecordBatch.from_arrays(
                            [pa.array((keys[keep] | top).view(np.int64)), pa.array(fps[keep].view(np.int64)),
                             pa.array(np.full(int(keep.sum()), d > 0))], ["key", "fp", "probe"])

    return nodes.select("fp").mapInArrow(run, "key long, fp long, probe boolean")


class _Forest:
    """Union-find over the links of one batch; gives each member's smallest fingerprint."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def batch(self) -> pa.RecordBatch:
        pairs = [(x, self.root(x)) for x in self.up]
        pairs = [p for p in pairs if p[0] != p[1]]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def _run_links(fps: np.ndarray, probe: np.ndarray, tau: int, forest: _Forest, block: int = 1024) -> None:
    """Links within one key: blocks of its members against blocks of its exact members; pairs are never listed."""
    exact = fps[~probe]
    for i in range(0, len(fps), block):
        for j in range(0, len(exact), block):
            a, b = fps[i:i + block], exact[j:j + block]
            x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= tau)
            links = np.unique(np.stack([a[x], b[y]], 1).view(np.int64), axis=0)
            for p, q in links[links[:, 0] != links[:, 1]].tolist():
                forest.link(p, q)


def _verify(batches: Iterator[pa.RecordBatch], tau: int, short: int = 16) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key -> links (a, b) that connect what is linked within each key."""
    keys, fps, probe = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    pieces: list[tuple] = []  # of the key that is still open

    def solve(k: np.ndarray, f: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
        forest = _Forest()
        starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        sizes = np.diff(np.append(starts, len(k)))
        for lag in range(1, min(short, int(sizes.max(initial=0)))):
            near = (k[lag:] == k[:-lag]) & ~(p[lag:] & p[:-lag]) & (np.bitwise_count(f[lag:] ^ f[:-lag]) <= tau)
            for i in np.flatnonzero(near & (f[lag:] != f[:-lag])).tolist():
                forest.link(int(f[i].view(np.int64)), int(f[i + lag].view(np.int64)))
        for at, size in zip(starts[sizes > short].tolist(), sizes[sizes > short].tolist()):
            _run_links(f[at:at + size], p[at:at + size], tau, forest)
        return forest.batch()

    for batch in batches:
        keys = batch.column(0).to_numpy()
        if not len(keys):
            continue
        fps = batch.column(1).to_numpy().view(np.uint64)
        probe = batch.column(2).to_numpy(zero_copy_only=False)
        if pieces and pieces[-1][0][-1] != keys[0]:
            yield solve(*map(np.concatenate, zip(*pieces)))
            pieces = []
        cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
        if cut:
            yield solve(*map(np.concatenate, zip(*pieces, (keys[:cut], fps[:cut], probe[:cut]))))
            pieces = []
        pieces.append((keys[cut:], fps[cut:], probe[cut:]))
    if pieces:
        yield solve(*map(np.concatenate, zip(*pieces)))


def links(nodes: DataFrame, tau: int = 3) -> DataFrame:
    """Links (a, b) between different values of `nodes.fp` (distinct longs) whose classes are exactly those of
    all pairs at Hamming distance <= tau. Within a key only a spanning forest is written, so a large group of
    near copies makes as many links as members, not all pairs.
    """
    n, both = bit_statistics(nodes)
    dealt = _deal(nodes, plan(n, both, tau))
    return (dealt.repartition(partitions(nodes), "key").sortWithinPartitions("key")
            .mapInArrow(lambda batches: _verify(batches, tau), "a long, b long"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    tau: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, group, component_id), one row per row of `docs`: the SimHash group of each document.

    component_id is the smallest doc_id reachable over links of at most `tau` differing bits. NULL and
    wordless texts have fingerprint 0 and are linked like any other. NULL ids are never the smallest unless a
    group has no other. Repeated rows are members like any other. Other columns are left alone. An empty
    table gives an empty result. `text_hash` tells rows with one id apart; `group` (a fingerprint of the group)
    tells groups apart whose smallest ids are equal or NULL.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    hashed = fingerprints(plain.withColumn("text_hash", F.xxhash64("text")))
    rows = checkpoint(hashed)
    nodes = checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    joined = checkpoint(components(links(nodes, tau)))
    lows = (joined.join(nodes, joined.node == nodes.fp).groupBy("root").agg(F.min("low").alias("least_id")))
    linked = joined.join(lows, "root").select(F.col("node").alias("fp"), "root", "least_id")
    alone = F.col("root").isNull()
    groups = nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("group"), F.when(alone, F.col("low")).otherwise(F.col("least_id")).alias("component_id"))
    return rows.join(groups, "fp", "left").select("doc_id", "text_hash", "fp", "group", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, tau: int = 3) -> DataFrame:
    """`docs`, all its columns, with one row of each SimHash group: the one with the smallest doc_id
    (NULL ids last, then the smallest text hash). Of rows equal in both, the one with the smallest hash of its
    columns stays, so a retried task keeps the same one; columns of maps are not compared.
    """
    groups = near_duplicates(docs, doc_id, text, shingle, tau)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    kept = groups.groupBy("group").agg(F.min(order).alias("first")).select("first.doc_id", "first.text_hash")
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text_hash").alias("key")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col(f"row.`{doc_id}`").alias("doc_id"),
                       F.xxhash64(F.col(f"row.`{text}`")).alias("text_hash")).select(key, "row")
    mine = rows.join(kept.select(key), "key", "left_semi")
    compared = [F.col(f"row.`{f.name}`") for f in docs.schema if not isinstance(f.dataType, T.MapType)]
    return mine.groupBy("key").agg(F.min_by("row", F.xxhash64(*compared)).alias("row")).select("row.*")
