"""Near-duplicate embeddings by product quantisation.

Every different unit vector goes to the inverted list of its nearest coarse centre; what is left of it is coded
by subspaces, and the length of the coding error is kept. A vector probes each list that can hold a neighbour,
by its distance to the cells' borders, so the probes are sufficient and not a guess. Within a list, table
look-ups give the distance from a probe to each code; by the triangle inequality a true neighbour is at most the
coding error farther than the radius, and what passes is compared by the exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortica.llm.components import components
from cohortica.llm.shared import checkpoint, partitions, small_side
from cohortica.operators.skew import salted_join

COSINE = 0.98
LISTS = 64
SUBSPACES = 8
CODES = 256
#: Centres and codebooks are fitted on at most so many different vectors, chosen by a hash.
FIT_VECTORS = 16_384
#: Members of a list that one task compares with their probes; longer lists are dealt over several tasks.
BLOCK = 1024
_SLACK = 1e-6


# ---- vectors -------------------------------------------------------------------------------------------------------

def comparable(vector: Column) -> Column:
    """Whether a vector has entries, all finite numbers, and not all zero."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda c: c != 0), F.lit(False))


def _padded(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a batch as rows of doubles, shorter ones filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


# ---- quantiser -----------------------------------------------------------------------------------------------------

def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0.0)


def _centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means; starts from rows spread over the sample, and centres that lose all rows stay where they are."""
    centres = x[np.unique(np.linspace(0, len(x) - 1, min(k, len(x))).astype(int))].copy()
    for _ in range(rounds):
        near = _squared(x, centres).argmin(1)
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


@dataclass
class Quantiser:
    """Coarse centres, and for every subspace its first and last dimension and codewords for what is left."""

    centres: np.ndarray
    cuts: list[tuple[int, int]]
    books: list[np.ndarray]

    @classmethod
    def fit(cls, units: np.ndarray, lists: int, subspaces: int, codes: int) -> Quantiser:
        centres = _centres(units, lists)
        rest = units - centres[_squared(units, centres).argmin(1)]
        edges = np.unique(np.linspace(0, units.shape[1], min(subspaces, units.shape[1]) + 1).astype(int))
        cuts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        return cls(centres, cuts, [_centres(rest[:, a:b], codes) for a, b in cuts])

    def assign(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, coding error, squared distances to all centres)."""
        far = _squared(units, self.centres)
        own = far.argmin(1)
        rest = units - self.centres[own]
        codes = np.stack([_squared(rest[:, a:b], book).argmin(1) for (a, b), book in zip(self.cuts, self.books)], 1)
        coded = np.hstack([book[codes[:, s]] for s, book in enumerate(self.books)])
        return own, codes.astype(np.uint8), np.sqrt(((rest - coded) ** 2).sum(1)), far

    def borders(self, own: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Distance from each vector to the plane between its own cell and every other one; 0 for its own cell."""
        between = np.sqrt(_squared(self.centres, self.centres))[own]
        gap = far - far[np.arange(len(own)), own][:, None]
        # centres that coincide have no plane between them: the cell of either may hold the neighbour
        return np.divide(gap, 2 * between, out=np.zeros_like(gap), where=between > _SLACK)

    def tables(self, units: np.ndarray, of_list: int) -> list[np.ndarray]:
        """Squared distance from each probe's part to every codeword, one table a subspace."""
        rest = units - self.centres[of_list]
        return [_squared(rest[:, a:b], book) for (a, b), book in zip(self.cuts, self.books)]


def fit(nodes: DataFrame, width: int, lists: int, subspaces: int, codes: int, most: int) -> Quantiser:
    """Quantiser of a sample of at most `most` different vectors, the first by a hash."""
    chosen = nodes.orderBy(F.xxhash64("id")).limit(most).select("vector").toArrow()
    units = np.concatenate([_units(_padded(batch.column(0), width)) for batch in chosen.to_batches() if len(batch)])
    return Quantiser.fit(units, lists, subspaces, codes)


# ---- inverted lists ------------------------------------------------------------------------------------------------

def index(nodes: DataFrame, quantiser: Quantiser, width: int, radius: float) -> DataFrame:
    """Every node with its list, codes, coding error, and the later lists that it has to probe.

    Of two vectors in different lists, the one in the earlier list probes the later one.
    """
    added = T.StructType.fromDDL("list int, code binary, error double, probes array<int>")
    schema = T.StructType([*nodes.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            own, codes, error, far = quantiser.assign(_units(_padded(batch.column("vector"), width)))
            near = quantiser.borders(own, far) <= radius + _SLACK
            near &= np.arange(near.shape[1]) > own[:, None]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(error), pa.array([np.flatnonzero(p).astype(np.int32) for p in near], pa.list_(pa.int32()))],
                schema.names)

    return nodes.mapInArrow(run, schema)


def deal(indexed: DataFrame, block: int) -> DataFrame:
    """Members and probes of every list; lists longer than `block` are dealt over blocks.

    A member stands in one block, and as a probe of its own list in the later ones; probes from other lists
    go to every block.
    """
    sizes = indexed.groupBy("label", "length", "list").agg(F.count("*").alias("n")).where(F.col("n") > block)
    long = small_side(checkpoint(sizes.select("label", "length", "list", F.ceil(F.col("n") / block).cast("int").alias("blocks"))))
    facts = ["label", "length", "id", "copies", "vector", "code", "error"]
    entries = indexed.select(*facts, F.col("list").alias("own"),
                             F.explode(F.concat(F.array("list"), "probes")).alias("list"))
    entries = entries.join(long, ["label", "length", "list"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    home = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    entries = entries.withColumn("home", F.when(F.col("own") == F.col("list"), home)).withColumn(
        "block", F.explode(F.sequence(F.coalesce("home", F.lit(0)), F.col("blocks") - 1)))
    return entries.select(*facts, "list", "block", F.coalesce(F.col("home") != F.col("block"), F.lit(True)).alias("probe"))


class _Block:
    """Members of one block of a list; compares probes with them and keeps track of what is connected."""

    def __init__(self, quantiser: Quantiser, of_list: int, batch: pa.Table, width: int, least: float, radius: float):
        self.quantiser, self.of_list, self.least, self.radius = quantiser, of_list, least, radius
        self.ids, self.copies = batch["id"].to_numpy(), batch["copies"].to_numpy()
        self.units = _units(_padded(batch["vector"].combine_chunks(), width))
        self.error = batch["error"].to_numpy()
        self.codes = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(len(self.ids), -1)
        self.root = np.arange(len(self.ids))

    def compare(self, ids: np.ndarray, copies: np.ndarray, units: np.ndarray, inside: int | None = None,
                pairs: int = 1 << 15) -> Iterator[pa.RecordBatch]:
        """Counts and connecting links of some probes; `inside`: they are the members from this place on."""
        far = np.zeros((len(ids), len(self.ids)))
        for s, table in enumerate(self.quantiser.tables(units, self.of_list)):
            far += table[:, self.codes[:, s]]
        maybe = far <= (self.radius + self.error + 1e-7) ** 2
        if inside is not None:  # every pair once: members against later members
            maybe &= np.arange(len(self.ids)) > inside + np.arange(len(ids))[:, None]
        at, to = np.nonzero(maybe)
        linked = np.concatenate([np.einsum("ij,ij->i", units[at[i:i + pairs]], self.units[to[i:i + pairs]]) >= self.least
                                 for i in range(0, len(at), pairs)]) if len(at) else np.zeros(0, bool)
        at, to = at[linked], to[linked]
        if not len(at):
            return
        mine = np.bincount(at, self.copies[to], len(ids)).astype(np.int64)
        theirs = np.bincount(to, copies[at], len(self.ids)).astype(np.int64)
        yield self._rows(np.concatenate((ids[mine > 0], self.ids[theirs > 0])), None, np.concatenate((mine[mine > 0], theirs[theirs > 0])))
        links = [[], []]
        starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        for probe, found in zip(at[starts].tolist(), np.split(to, starts[1:])):
            roots = np.unique(self.root[found])
            if inside is None:
                links[0].append(ids[probe])
                links[1].append(self.ids[roots[0]])
            else:
                roots = np.unique(np.append(roots, self.root[inside + probe]))
            for other in roots[1:].tolist():
                links[0].append(self.ids[other])
                links[1].append(self.ids[roots[0]])
                self.root[self.root == other] = roots[0]
        if links[0]:
            yield self._rows(np.array(links[0]), np.array(links[1]), None)

    @staticmethod
    def _rows(ids: np.ndarray, other: np.ndarray | None, found: np.ndarray | None) -> pa.RecordBatch:
        empty = pa.nulls(len(ids), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), empty if other is None else pa.array(other, pa.int64()),
             empty if found is None else pa.array(found, pa.int64())], ["id", "other", "links"])


def search(dealt: DataFrame, quantiser: Quantiser, width: int, least: float, radius: float, at_once: int = 256) -> DataFrame:
    """(id, other, links): partial counts of links (no `other`), and links that connect what is connected (no count).

    A block's members come first and stay in memory, probes are streamed past them. Pairs are not listed: a probe
    gives one link, and members are linked only when a probe joins them for the first time.
    """
    keys = ["label", "length", "list", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, members = None, None, []

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal block, members
            if members:
                block = _Block(quantiser, key[2], pa.Table.from_batches(members), width, least, radius)
                members = []
                for i in range(0, len(block.ids), at_once):
                    to = i + at_once
                    yield from block.compare(block.ids[i:to], block.copies[i:to], block.units[i:to], inside=i)

        for batch in batches:
            values = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "probe")]
            changed = np.any([v[1:] != v[:-1] for v in values], axis=0) if len(batch) else np.zeros(0, bool)
            edges = [0, *(np.flatnonzero(changed) + 1).tolist(), len(batch)]
            for i, j in zip(edges[:-1], edges[1:]):
                if i == j:
                    continue
                here = tuple(v[i] for v in values[:-1])
                if here != key:
                    yield from closed()
                    key, block = here, None
                if not values[-1][i]:
                    members.append(batch.slice(i, j - i))
                    continue
                yield from closed()
                if block is None:  # a list without members
                    continue
                for a in range(i, j, at_once):
                    part = batch.slice(a, min(at_once, j - a))
                    yield from block.compare(part.column("id").to_numpy(), part.column("copies").to_numpy(),
                                             _units(_padded(part.column("vector"), width)))
        yield from closed()

    spread = dealt.repartition(partitions(dealt), *keys).sortWithinPartitions(*keys, "probe")
    return spread.mapInArrow(run, "id long, other long, links long")


# ---- operator ------------------------------------------------------------------------------------------------------

def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    least: float = COSINE, lists: int = LISTS, subspaces: int = SUBSPACES, codes: int = CODES,
                    fit_vectors: int = FIT_VECTORS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of `vectors`: how many other rows with an equal label have
    a cosine of at least `least`, and the smallest vec_id reachable over such links. No link is missed.

    Vectors that are NULL, empty, zero or hold NULL or non-finite entries, and those without a label, link with
    nothing and are their own component. Vectors of different lengths never link. Equal vectors are one vector
    with a number of copies, so a large group of copies costs one comparison. Rows with a NULL vec_id link like
    any other, but are the smallest of a component only if it has no id at all, which is then NULL; they are
    never kept. Repeated ids are rows of their own. An empty table gives no rows. Other columns are left alone.
    Near but unequal copies are compared pair by pair, in blocks, as their links must be counted.
    """
    if not 0 < least <= 1 or not 1 <= codes <= 256:
        raise ValueError("the least cosine lies in (0, 1], and a code is one byte")
    radius = float(np.sqrt(max(2 - 2 * least, 0.0)))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    linkable = comparable(F.col("vector")) & F.col("label").isNotNull()
    rows = rows.withColumn("vector", F.when(linkable, F.transform("vector", lambda c: F.when(c == 0, F.abs(c)).otherwise(c))))
    known = rows.where("vector is not null")
    key = [F.xxhash64("label", "vector").alias("one"), F.xxhash64(F.lit(1), "vector", "label").alias("two")]
    nodes = checkpoint(known.select(*key, "vec_id", "label", "vector").groupBy("one", "two").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("low"), F.any_value("label").alias("label"),
        F.any_value("vector").alias("vector")).withColumn("id", F.monotonically_increasing_id()))
    width = nodes.agg(F.max(F.size("vector"))).first()[0]
    named = rows.select("vec_id", *[F.when(F.col("vector").isNotNull(), k).alias(n) for k, n in zip(key, ("one", "two"))])
    if width is None:
        return _result(named.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("least_id")))
    quantiser = fit(nodes, width, lists, subspaces, codes, fit_vectors)
    slim = nodes.select(F.col("label").cast("string").alias("label"), F.size("vector").alias("length"), "id", "copies", "vector")
    indexed = checkpoint(index(slim, quantiser, width, radius))
    found = checkpoint(search(deal(indexed, block), quantiser, width, least, radius))
    counts = found.where("other is null").groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null").select("id", "other"))
    rooted = nodes.select("one", "two", "id", "copies", "low").join(joined.withColumnRenamed("node", "id"), "id", "left") \
        .join(counts, "id", "left").withColumn("root", F.coalesce("root", "id"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("least_id"))
    facts = rooted.join(lows, "root").select("one", "two", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                             "least_id", F.lit(True).alias("linkable"))
    out = salted_join(named, checkpoint(facts), ["one", "two"], "left")
    alone = F.col("linkable").isNull()
    return _result(out.select("vec_id", F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
                              F.when(alone, F.col("vec_id")).otherwise(F.col("least_id")).alias("least_id")))


def _result(out: DataFrame) -> DataFrame:
    return out.select("vec_id", "n_links", F.col("least_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.col("least_id"), F.lit(False)).alias("kept"))
