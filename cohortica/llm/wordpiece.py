"""Token counts by a linear longest-match automaton.

The vocabulary is a trie. Each node has a failure link, to where matching goes on after the longest tokens of
its string are taken, and the number of tokens taken on the way. Walking a word's symbols then takes each
symbol once and adds counts; no piece is ever built. Pieces that may only end a word end in a symbol of their
own, so they match nowhere else, and other pieces never reach a word's end.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write visible Latin-1 characters for themselves, other bytes as U+0100 and on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


#: A byte that ends its word is the symbol so much above the byte.
LAST = 256


def symbols(word: bytes) -> tuple[int, ...]:
    """The symbols of a word: its bytes, the last one marked."""
    return (*word[:-1], word[-1] + LAST) if word else ()


def load_vocabulary(path: str) -> list[tuple[int, ...]]:
    """The pieces of a byte-level vocabulary file with word-end marks, as symbols."""
    of = _byte_of_symbol()
    with open(path, encoding="utf-8") as source:
        names = json.load(source)["model"]["vocab"]
    inside = {tuple(of[c] for c in n) for n in names if not n.endswith(WORD_END) and set(n) <= set(of)}
    closing = {symbols(bytes(of[c] for c in n.removesuffix(WORD_END))) for n in names if n.endswith(WORD_END)}
    return sorted((inside | closing) - {()})


class Automaton:
    """Greedy longest-match over `pieces`; a word that cannot be cut into pieces is one unknown token."""

    def __init__(self, pieces: Iterable[Sequence[int]]):
        pieces = {tuple(p) for p in pieces if len(p)}
        self.edges: list[dict[int, int]] = [{}]
        self.fail: list[int] = [-1]  # -1: nothing can be taken off
        self.pops: list[int] = [0]
        ends = set()
        for piece in sorted(pieces):
            node = 0
            for byte in piece:
                step = self.edges[node].get(byte)
                if step is None:
                    step = len(self.edges)
                    self.edges[node][byte] = step
                    self.edges.append({})
                    self.fail.append(-1)
                    self.pops.append(0)
                node = step
            ends.add(node)
        level = [(0, byte, node) for byte, node in self.edges[0].items()]
        while level:  # by depth: a node's link rests on its parent's
            after = []
            for parent, byte, node in level:
                if node in ends:
                    self.fail[node], self.pops[node] = 0, 1
                elif parent:
                    at, taken = self.fail[parent], self.pops[parent]
                    while at >= 0 and byte not in self.edges[at]:
                        at, taken = (self.fail[at], taken + self.pops[at]) if at else (-1, 0)
                    if at >= 0:
                        self.fail[node], self.pops[node] = self.edges[at][byte], taken
                after += [(node, b, n) for b, n in self.edges[node].items()]
            level = after

    def count(self, word: Sequence[int]) -> int:
        """Number of tokens of one word; 0 for the empty word."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node = total = 0
        for byte in word:
            step = edges[node].get(byte)
            while step is None:
                if fail[node] < 0:
                    return 1  # no cut: one unknown token
                total += pops[node]
                node = fail[node]
                step = edges[node].get(byte)
            node = step
        while node:
            if fail[node] < 0:
                return 1
            total += pops[node]
            node = fail[node]
        return total


_READY: dict[str, tuple[Automaton, dict[bytes, int]]] = {}


def _ready(path: str) -> tuple[Automaton, dict[bytes, int]]:
    """Automaton and counts of words seen, one pair per Python worker."""
    if path not in _READY:
        _READY[path] = Automaton(load_vocabulary(path)), {}
    return _READY[path]


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
                 cache: int = 500_000) -> DataFrame:
    """(doc_id, n_words, n_tokens, longest), one row per row of `docs`, from whole texts.

    Words are runs without ASCII white space, A-Z lower-cased; n_tokens sums their greedy longest-match
    pieces, where a piece with a word-end mark ends its word and no other piece does, and longest is the most tokens in one word. NULL and empty texts have 0 of each. Repeated rows
    and ids each have their row; an empty table gives no rows; other columns are left alone. Each worker
    remembers up to about `cache` words, so memory is bounded.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = plain.select("doc_id").schema.add("n_words", "long").add("n_tokens", "long").add("longest", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = _ready(path)
        for batch in batches:
            sizes = []
            for t in batch.column(1):
                words = (t.as_py() or "").encode().lower().split()
                counts = list(map(known.get, words))
                if None in counts:
                    for i, word in enumerate(words):
                        if counts[i] is None:
                            counts[i] = known[word] = automaton.count(symbols(word))
                sizes.append((len(words), sum(counts), max(counts, default=0)))
                if len(known) > cache:
                    known.clear()
            numbers = np.array(sizes, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(numbers[:, i]) for i in range(3))],
                                             ["doc_id", "n_words", "n_tokens", "longest"])

    return plain.mapInArrow(run, schema)
