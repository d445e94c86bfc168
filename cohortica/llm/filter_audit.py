"""How a chain of filters behaves in every order, from decision diagrams of failure masks.

Each document fails some of the filters: its mask. Masks are counted per part, in one shuffle with map-side
combine. Each part's few counts become a diagram with one level per filter and the counts below every node;
swapping adjacent levels turns it into the diagram of the next order, so all orders are walked without
counting again. On the path on which everything passes, a node's failing branch is what its filter removes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cohortica.llm.shared import checkpoint
from cohortica.operators.skew import lookup_join

LETTERS = "ABCDE"
_SPACE = r"[\x20\x09-\x0D]+"
_RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
           "good_lost long, toxic_lost long, shapley long")


# ---- failures ------------------------------------------------------------------------------------------------------

def text_failures(text: Column) -> dict[str, Column]:
    """Whether a whole text fails filters A to D: too short, too repetitive, too many capitals, odd signs."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {"A": n < 50, "B": distinct.cast("long") * 100 < n.cast("long") * 65,
            "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 5, "D": text.rlike(r"[#$%&*|]")}


def failures(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             part: str = "source") -> DataFrame:
    """(part, mask, good, toxic), one row per document: bit i of `mask` is set if it fails filter LETTERS[i].

    Filter E, copies, fails a text that some smaller doc_id has anywhere in the table. The smallest id of each
    text is a combined aggregate; only texts that occur twice are joined back, hot ones in shares.
    """
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    bits = [F.when(failed, 1 << LETTERS.index(letter)).otherwise(0) for letter, failed in text_failures(F.col("text")).items()]
    mask = list(accumulate(bits, lambda a, b: a + b))[-1]
    slim = checkpoint(whole.select("doc_id", "part", mask.cast("int").alias("mask"),
                                   F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")))
    lows = slim.groupBy("digest").agg(F.min("doc_id").alias("low"), F.count("*").alias("times"))
    marked = lookup_join(slim, checkpoint(lows.where("times > 1 and low is not null").select("digest", "low")), "digest")
    copy = F.coalesce(F.col("low") < F.col("doc_id"), F.lit(False))
    marked = marked.select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << LETTERS.index("E")).otherwise(0)).alias("mask"))
    known = checkpoint(labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic")))
    return lookup_join(marked, known, "doc_id").select(
        "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def mask_counts(failed: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): at most 32 rows a part, whatever its number of documents."""
    return failed.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


# ---- diagrams ------------------------------------------------------------------------------------------------------

class Diagram:
    """Decision diagram over the filters in `order`; every node carries the counts of the documents below it.

    A node is (filter, passing child, failing child) or, below the last level, a tuple of counts; equal nodes
    are stored once. A level is never skipped: counts need every filter's split.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], order: str = LETTERS):
        self.order, self.nodes, self.sums, self._numbers = order, [], [], {}
        self._zero = tuple(0 for _ in next(iter(counts.values()), (0,)))
        self.root = self._build(counts, 0, 0)

    def _number(self, node: tuple, total: tuple[int, ...]) -> int:
        if node not in self._numbers:
            self._numbers[node] = len(self.nodes)
            self.nodes.append(node)
            self.sums.append(total)
        return self._numbers[node]

    def _node(self, letter: str, passing: int, failing: int) -> int:
        total = tuple(a + b for a, b in zip(self.sums[passing], self.sums[failing]))
        return self._number((letter, passing, failing), total)

    def _build(self, counts: dict, level: int, mask: int) -> int:
        if level == len(self.order):
            leaf = counts.get(mask, self._zero)
            return self._number(leaf, leaf)
        letter = self.order[level]
        bit = 1 << LETTERS.index(letter)
        return self._node(letter, self._build(counts, level + 1, mask), self._build(counts, level + 1, mask | bit))

    def swap(self, level: int) -> None:
        """Exchange the filters of `level` and the next one; nodes above are rebuilt, nodes below are kept."""
        upper, lower = self.order[level], self.order[level + 1]
        done: dict[int, int] = {}

        def turned(number: int, depth: int) -> int:
            if number not in done:
                letter, passing, failing = self.nodes[number]
                if depth < level:
                    done[number] = self._node(letter, turned(passing, depth + 1), turned(failing, depth + 1))
                else:
                    (_, pp, pf), (_, fp, ff) = self.nodes[passing], self.nodes[failing]
                    done[number] = self._node(lower, self._node(upper, pp, fp), self._node(upper, pf, ff))
            return done[number]

        self.root = turned(self.root, 0)
        self.order = self.order[:level] + lower + upper + self.order[level + 2:]

    def all_pass(self) -> Iterator[tuple[str, tuple[int, ...], tuple[int, ...]]]:
        """(filter, counts that stay, counts that it removes) along the path on which everything passes."""
        at = self.root
        for letter in self.order:
            _, passing, failing = self.nodes[at]
            yield letter, self.sums[passing], self.sums[failing]
            at = passing


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after the other, so that all orders of n filters are met once."""
    if n < 2:
        return
    down = True
    rest = adjacent_swaps(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        inner = next(rest, None)
        if inner is None:
            return
        yield inner + 1 if down else inner  # the moving filter stands first, or last
        down = not down


def orders(counts: dict[int, tuple[int, int, int]]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order and step."""
    diagram, paths = Diagram(counts), {}
    paths[diagram.order] = list(diagram.all_pass())
    for level in adjacent_swaps(len(LETTERS)):
        diagram.swap(level)
        paths[diagram.order] = list(diagram.all_pass())
    fails = {path[0][0]: path[0][2][0] for path in paths.values()}  # as the first filter it removes all it fails
    alone = {path[-1][0]: path[-1][2][0] for path in paths.values()}  # as the last one, what no other removes
    shapley = {letter: 0 for letter in LETTERS}
    for path in paths.values():
        for letter, _, removed in path:
            shapley[letter] += removed[0]
    return [(order, step, kept[0], removed[0], fails[letter] - removed[0], alone[letter], removed[1], removed[2], shapley[letter])
            for order, path in paths.items() for step, (letter, kept, removed) in enumerate(path, 1)]


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, zeros included: what stays, what the step's filter
    removes there, what it would have removed but for earlier ones, what only it fails, the good and toxic
    documents it removes, and its removals over all orders.

    NULL texts are empty; empty texts fail A only (and E from the second on). NULL parts are the part "". Rows
    with a NULL doc_id never fail E and are no one's smaller copy; repeated rows and ids are documents of their
    own, and rows with one id are not each other's smaller copy. Several labels of an id count as good or toxic
    if any is; labels without an id are no one's. Very long texts are read whole. No documents: no rows. Other
    columns are left alone.
    """

    def of_part(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(rows["mask"], rows["n"], rows["good"], rows["toxic"])}
        return pd.DataFrame([(key[0], *row) for row in orders(counts)], columns=[f.split()[0] for f in _RESULT.split(", ")])

    counts = mask_counts(failures(docs, labels, doc_id, text, part))
    return counts.groupBy("part").applyInPandas(of_part, _RESULT)
