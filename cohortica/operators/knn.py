"""Nearest-neighbour imputation, exact, as a partitioned join.

Distances are Euclidean over the dimensions present on both sides, scaled by
sqrt(all dimensions / shared dimensions). The k nearest donors count with weight 1/distance;
donors at distance zero, if any, share all the weight.

How the work is spread:

1. Donors with the same coordinates are at the same distance from everybody, so only the first k
   of them (by tie-break) can matter. Receivers with the same coordinates get the same answer.
   Both sides shrink to distinct points before any distance is computed.
2. Donor space is cut into boxes along medians of a sample, and boxes that hold too many donors are
   cut again by a sample of their own, until all fit. The k-th nearest sample point
   in a receiver's own box bounds its true k-th distance, so only boxes within that bound can
   hold one of its neighbours.
3. Receivers are sent to those boxes and meet the donors there; each box returns at most k
   candidates per receiver, and the k best over all boxes are kept.

Boxes hold about `BOX_POINTS` donors. Boxes that draw many receivers are split into chunks.
No pair of rows is ever written out beyond those k candidates.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from cohortica.operators.running import materialize
from cohortica.operators.skew import salted_join

# Send these functions to the workers themselves, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOX_POINTS = 4000
BOX_SAMPLE = 64
#: Points that one round of fitting boxes brings to the driver.
SAMPLE_LIMIT = 1_000_000
CHUNK_RECEIVERS = 50_000
_BLOCK = 2_000_000
_DIGITS = 9
_SLACK = 1e-7


def _split_points(points: np.ndarray, dims: list[int], k: int, capacity: int) -> list[tuple]:
    """Median splits of a point sample as a list of nodes.

    A node is (dim, cut, left, right), or (None, sample rows, box number, None) for a box. Every
    box keeps at least k sample points, unless the whole sample has fewer.
    """
    nodes: list[tuple] = []
    boxes = 0

    def grow(members):
        nonlocal boxes
        at = len(nodes)
        nodes.append(None)
        if len(members) >= max(2 * k, capacity):
            for d in sorted(dims, key=lambda d: -np.ptp(points[members, d])):
                values = points[members, d]
                cut = np.median(values)
                if cut == values.max() and cut > values.min():
                    cut = values[values < cut].max()
                left = values <= cut
                if min(left.sum(), (~left).sum()) >= k:
                    nodes[at] = (d, float(cut), grow(members[left]), grow(members[~left]))
                    return at
        nodes[at] = (None, members, boxes, None)
        boxes += 1
        return at

    grow(np.arange(len(points)))
    return nodes


class _Boxes:
    """Finds boxes, and bounds on neighbour distances, for batches of points.

    `low` and `high` are the extent of all donors of the space.
    """

    def __init__(self, points: np.ndarray, nodes: list[tuple], low: np.ndarray, high: np.ndarray, k: int):
        self.points, self.nodes, self.low, self.high, self.k = points, nodes, low, high, k

    def _homes(self, points):
        """(rows, sample rows, box number) for each box that holds some of the points."""
        todo, found = [(np.arange(len(points)), 0)], []
        while todo:
            rows, at = todo.pop()
            d, cut, left, right = self.nodes[at]
            if d is None:
                found.append((rows, cut, left))
            elif len(rows):
                under = points[rows, d] <= cut
                todo += [(rows[under], left), (rows[~under], right)]
        return [f for f in found if len(f[0])]

    def own_boxes(self, points):
        box = np.zeros(len(points), dtype=np.int32)
        for rows, _, number in self._homes(points):
            box[rows] = number
        return box

    def bounds(self, points):
        """k-th distance to the sample points of the own box; infinite if it has fewer."""
        bound = np.full(len(points), np.inf)
        for rows, members, _ in self._homes(points):
            if len(members) >= self.k:
                near = self.points[members]
                for part in np.array_split(rows, len(rows) * len(near) // _BLOCK + 1):
                    bound[part] = np.partition(distances(points[part], near), self.k - 1, axis=1)[:, self.k - 1]
        return bound

    def touched(self, points, radius):
        """(row, box) for every box no further from the row than its radius.

        The distance to a box grows dimension by dimension on the way down, so far-away points
        are pruned by their true distance to the box.
        """
        apart = np.maximum(np.maximum(self.low - points, points - self.high), 0.0)
        todo, rows_out, boxes_out = [(np.arange(len(points)), apart, 0)], [], []
        while todo:
            rows, apart, at = todo.pop()
            near = (apart * apart).sum(axis=1) <= radius[rows] ** 2
            rows, apart = rows[near], apart[near]
            if not len(rows):
                continue
            d, cut, left, right = self.nodes[at]
            if d is None:
                rows_out.append(rows)
                boxes_out.append(np.full(len(rows), left, dtype=np.int32))
                continue
            gap = points[rows, d] - cut
            for child, beyond in ((left, gap), (right, -gap)):
                further = apart.copy()
                further[:, d] = np.maximum(further[:, d], beyond)
                todo.append((rows, further, child))
        if not rows_out:
            return np.zeros(0, dtype=int), np.zeros(0, dtype=np.int32)
        return np.concatenate(rows_out), np.concatenate(boxes_out)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        gap = a[:, d][:, None] - b[:, d][None, :]
        total += gap * gap
    return np.sqrt(total)


def _nearest(receivers: np.ndarray, radius: np.ndarray, donors: np.ndarray, ties: np.ndarray,
             factor: float, k: int):
    """(receiver row, donor row, distance) of the k nearest within the radius, ties in order."""
    out = []
    for rows in np.array_split(np.arange(len(receivers)), len(receivers) * len(donors) // _BLOCK + 1):
        gap = np.round(distances(receivers[rows], donors) * factor, _DIGITS)
        limit = radius[rows] + _SLACK
        if len(donors) > k:
            limit = np.minimum(limit, np.partition(gap, k - 1, axis=1)[:, k - 1])
        r, d = np.nonzero(gap <= limit[:, None])
        order = np.lexsort((ties[d], gap[r, d], r))
        r, d = r[order], d[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        keep = rank < k
        out.append((rows[r[keep]], d[keep], gap[r[keep], d[keep]]))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def _bits(names: list[str]):
    return reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(names)])


def _members(mask: int, width: int) -> list[int]:
    return [i for i in range(width) if mask >> i & 1]


def _spaces(wanted: list[int], offered: list[int], targets: list[int]) -> list[tuple]:
    """Every (target, receiver mask, shared mask) with donors; at most targets * 4^width of them."""
    return sorted({(t, r, r & d) for t in targets for r in wanted for d in offered
                   if not r >> t & 1 and d >> t & 1 and r & d})


def _donor_points(pool: DataFrame, spaces: list[tuple], zs: list[str], k: int) -> DataFrame:
    """Distinct donor points per space, each with its first k donors by tie-break."""
    kinds = F.array(*[F.struct(F.lit(i).alias("space"), F.lit(t).alias("t"), F.lit(1 << t).alias("bit"),
                               F.lit(r).alias("want"), F.lit(s).alias("share"))
                      for i, (t, r, s) in enumerate(spaces)])
    fits = F.filter(kinds, lambda x: (F.col("mask").bitwiseAND(x["bit"]) != 0)
                    & (F.col("mask").bitwiseAND(x["want"]) == x["share"]))
    value = F.element_at(F.array(*[f"x{i}" for i in range(len(zs))]), F.col("in.t") + 1)
    points = pool.withColumn("in", F.explode(fits)).select(
        F.col("in.space").alias("space"),
        *[F.when(F.col("in.share").bitwiseAND(1 << i) != 0, F.col(z)).otherwise(0.0).alias(z) for i, z in enumerate(zs)],
        (F.col("tie") if "tie" in pool.columns else value).alias("tie"), value.alias("y"))
    first = Window.partitionBy("space", *zs).orderBy("tie", "y")
    return points.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= k).drop("rn")


def _in_boxes(points: DataFrame, zs: list[str], trees) -> DataFrame:
    """Donor points with the number of their box; `trees` is a broadcast of the trees by space."""

    def place(batches):
        for batch in batches:
            for space, rows in batch.groupby("space"):
                yield rows.assign(box=_Boxes(*trees.value[space]).own_boxes(rows[zs].to_numpy(dtype=float)))

    z_ddl = ", ".join(f"{z} double" for z in zs)
    return points.mapInPandas(place, f"space int, {z_ddl}, tie double, y double, box int")


def _graft(tree: tuple, box: int, got: np.ndarray, nodes: list[tuple]) -> tuple:
    """The tree with box `box` replaced by `nodes`, a subtree over the sample `got`; its first box keeps the number."""
    points, old, *rest = tree
    at = next(i for i, (d, _, number, _) in enumerate(old) if d is None and number == box)
    boxes = sum(d is None for d, *_ in old)
    shift, put = len(points), lambda n: at if n == 0 else len(old) + n - 1
    moved = [(None, members + shift, box if left == 0 else boxes + left - 1, None) if d is None else (d, members, put(left), put(right))
             for d, members, left, right in nodes]
    return np.concatenate((points, got)), [*old[:at], moved[0], *old[at + 1:], *moved[1:]], *rest


def _fit_boxes(points: DataFrame, spaces: list[tuple], zs: list[str], k: int, box_points: int, sample_limit: int) -> dict[int, tuple]:
    """A tree of boxes for every space, none with more than 2 * `box_points` donors if its points can be told apart.

    The first trees come from a sample of all donors. Boxes that turn out too full are split again by a sample
    of their own donors, round by round; a round brings about `sample_limit` points to the driver, so the limit sets
    the number of rounds and not the number of boxes. A box whose sample is all one place is sampled more densely
    the next time, equal points counting once.
    """
    context = points.sparkSession.sparkContext
    extent = [f(z).alias(f"{n}{z}") for z in zs for f, n in ((F.min, "low_"), (F.max, "high_"))]
    known = {r["space"]: r for r in points.groupBy("space").agg(F.count(F.lit(1)).alias("count"), *extent).collect()}
    sizes = {i: r["count"] for i, r in known.items()}
    most = max(sample_limit // len(sizes), 4 * k)
    shares = {i: min(1.0, min(most, max(4 * BOX_SAMPLE, BOX_SAMPLE * n // box_points)) / n) for i, n in sizes.items()}
    sample = points.sampleBy("space", shares, seed=11).select("space", *zs).toPandas().drop_duplicates()
    trees = {}
    for i, (_, _, share) in enumerate(spaces):
        got = sample.loc[sample["space"] == i, zs].to_numpy(dtype=float)
        capacity = BOX_SAMPLE if sizes[i] > box_points else 2 * len(got) + 2 * k
        low, high = (np.array([known[i][f"{n}{z}"] for z in zs]) for n in ("low_", "high_"))
        trees[i] = (got, _split_points(got, _members(share, len(zs)), k, capacity), low, high, k)
    wider: dict[tuple[int, int], int] = {}  # boxes that a sample could not split: how much more to take
    whole = set()  # boxes that all their points cannot split
    seed = 11
    while True:
        shared = context.broadcast(trees)
        placed = _in_boxes(points, zs, shared)
        full = [(r["space"], r["box"], r["count"]) for r in placed.groupBy("space", "box").count()
                .where(F.col("count") > 2 * box_points).collect() if (r["space"], r["box"]) not in whole]
        if not full:
            return trees
        taken, left = {}, sample_limit
        for space, box, n in sorted(full, key=lambda f: -f[2]):
            more = wider.get((space, box), 1)
            want = max(4 * k, BOX_SAMPLE * n // box_points)
            if taken and want > left:
                continue
            taken[space, box] = min(1.0, max(min(want, left), 4 * k) * more / n)
            left -= want
        seed += 1
        chosen = points.sparkSession.createDataFrame([(*at, share) for at, share in taken.items()], "space int, box int, share double")
        draw = F.pmod(F.xxhash64(F.lit(seed), *zs), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sample = (placed.join(F.broadcast(chosen), ["space", "box"]).where(draw < F.col("share"))
                  .select("space", "box", *zs).distinct().toPandas())
        for (space, box), share in taken.items():
            got = sample.loc[(sample["space"] == space) & (sample["box"] == box), zs].to_numpy(dtype=float)
            capacity = max(2 * k, round(box_points * share))
            nodes = _split_points(got, _members(spaces[space][2], len(zs)), k, capacity)
            if len(nodes) > 1:
                trees[space] = _graft(trees[space], box, got, nodes)
                wider.pop((space, box), None)
            elif share >= 1.0:
                whole.add((space, box))
            else:
                wider[space, box] = 4 * wider.get((space, box), 1)


def _nearest_values(receivers: DataFrame, pool: DataFrame, width: int, targets: list[int], k: int,
                    box_points: int, chunk_receivers: int, sample_limit: int) -> DataFrame | None:
    """(t, mask, z..., value): the imputed value of target t for each distinct receiver point."""
    spark = receivers.sparkSession
    zs = [f"z{i}" for i in range(width)]
    # At most 2^width masks on either side.
    masks = receivers.select("mask", F.lit(True).alias("asks")).unionByName(
        pool.select("mask", F.lit(False).alias("asks"))).distinct().collect()
    spaces = _spaces([m["mask"] for m in masks if m["asks"]], [m["mask"] for m in masks if not m["asks"]], targets)
    if not spaces:
        return None
    points = materialize(_donor_points(pool, spaces, zs, k))

    trees = _fit_boxes(points, spaces, zs, k, box_points, sample_limit)
    shared_trees = spark.sparkContext.broadcast(trees)

    def project(space, z):
        """Coordinates on the shared dimensions, and the factor for the missing ones."""
        share = spaces[space][2]
        inside = np.zeros(width)
        inside[_members(share, width)] = 1.0
        return z * inside, float(np.sqrt(width / bin(share).count("1")))

    def place_receivers(batches):
        for batch in batches:
            for mask, rows in batch.groupby("mask"):
                z = rows[zs].to_numpy(dtype=float)
                for target in targets:
                    mine = [i for i, (t, r, _) in enumerate(spaces) if t == target and r == mask]
                    bound = np.full(len(rows), np.inf)
                    for i in mine:
                        at, factor = project(i, z)
                        bound = np.minimum(bound, _Boxes(*shared_trees.value[i]).bounds(at) * factor)
                    for i in mine:
                        at, factor = project(i, z)
                        row, box = _Boxes(*shared_trees.value[i]).touched(at, bound / factor + _SLACK)
                        yield rows.iloc[row].assign(t=target, space=i, box=box, radius=bound[row])

    z_ddl = ", ".join(f"{z} double" for z in zs)
    placed = _in_boxes(points, zs, shared_trees)
    asked = materialize(receivers.select("mask", *zs).mapInPandas(
        place_receivers, f"mask int, {z_ddl}, t int, space int, box int, radius double"))

    # Crowded boxes are met in several chunks of receivers. At most one row per box.
    crowded = (asked.groupBy("space", "box").count().where(F.col("count") > chunk_receivers)
               .select("space", "box", F.ceil(F.col("count") / chunk_receivers).cast("int").alias("chunks")).collect())
    if crowded:
        def with_chunks(df):
            chunks = spark.createDataFrame(crowded, "space int, box int, chunks int")
            return df.join(F.broadcast(chunks), ["space", "box"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        asked = with_chunks(asked).withColumn("chunk", F.pmod(F.xxhash64("mask", *zs), F.col("chunks")).cast("int"))
        placed = with_chunks(placed).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    else:
        asked, placed = asked.withColumn("chunk", F.lit(0)), placed.withColumn("chunk", F.lit(0))

    def meet(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=["t", "mask", *zs, "gap", "tie", "y"])
        at, factor = project(int(key[0]), left[zs].to_numpy(dtype=float))
        r, d, gap = _nearest(at, left["radius"].to_numpy(), right[zs].to_numpy(dtype=float),
                             right["tie"].to_numpy(), factor, k)
        out = left.iloc[r][["t", "mask", *zs]].reset_index(drop=True)
        return out.assign(gap=gap, tie=right["tie"].to_numpy()[d], y=right["y"].to_numpy()[d])

    met = ["space", "box", "chunk"]
    near = asked.groupBy(*met).cogroup(placed.groupBy(*met)).applyInPandas(
        meet, f"t int, mask int, {z_ddl}, gap double, tie double, y double")
    nearest = Window.partitionBy("t", "mask", *zs).orderBy("gap", "tie", "y")
    near = near.withColumn("rn", F.row_number().over(nearest)).where(F.col("rn") <= k)
    exact, weight = F.col("gap") == 0, F.when(F.col("gap") > 0, F.lit(1.0) / F.col("gap"))
    return near.groupBy("t", "mask", *zs).agg(
        F.coalesce(F.avg(F.when(exact, F.col("y"))),
                   F.sum(F.col("y") * weight) / F.sum(weight)).alias("value"))


def points_of(df: DataFrame, features: list[str], stats: dict) -> DataFrame:
    """Add mask (which features are present) and standardized z0.. with 0 where missing."""
    masked = df.withColumn("mask", _bits(features).cast("int"))
    return masked.withColumns({
        f"z{i}": F.coalesce((F.col(c).cast("double") - F.lit(stats[c][0])) / F.lit(stats[c][1]), F.lit(0.0))
        for i, c in enumerate(features)})


def knn_impute(df: DataFrame, donors: DataFrame, features: list[str], targets: list[str],
               stats: dict[str, tuple[float, float]], k: int = 5, tie_break: str | None = None,
               box_points: int = BOX_POINTS, chunk_receivers: int = CHUNK_RECEIVERS,
               sample_limit: int = SAMPLE_LIMIT) -> DataFrame:
    """Fill missing targets of `df` from the donors; observed values stay as they are.

    `tie_break` is a numeric donor column that settles equal distances (default: the donor's
    value). Rows with nothing missing never enter a shuffle.
    """
    width = len(features)
    zs = [f"z{i}" for i in range(width)]
    pool = points_of(donors, features, stats).select(
        "mask", *zs, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
        *([F.col(tie_break).cast("double").alias("tie")] if tie_break else []))
    lacking = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in targets])
    gaps = points_of(df.where(lacking), features, stats)
    points = materialize(gaps.select("mask", *zs).distinct())

    places = {t: features.index(t) for t in targets}
    answers = _nearest_values(points, pool, width, list(places.values()), k, box_points, chunk_receivers, sample_limit)
    if answers is None:
        filled = gaps.withColumns({f"_new_{t}": F.lit(None).cast("double") for t in targets})
    else:
        wide = answers.groupBy("mask", *zs).agg(
            *[F.max(F.when(F.col("t") == i, F.col("value"))).alias(f"_new_{t}") for t, i in places.items()])
        filled = salted_join(gaps, wide, ["mask", *zs], "left")
    filled = filled.select(*[
        F.coalesce(F.col(c).cast("double"), F.col(f"_new_{c}"), F.lit(stats[c][0])).alias(c) if c in targets
        else F.col(f"`{c}`") for c in df.columns])
    whole = df.where(~lacking).select(*[
        F.col(c).cast("double").alias(c) if c in targets else F.col(f"`{c}`") for c in df.columns])
    return whole.unionByName(filled)
