import re
from itertools import combinations

import numpy as np
import xxhash

from cohortica.llm import simhash


def _plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _classes(rows, near):
    up = list(range(len(rows)))
    for _ in rows:
        for i, j in combinations(range(len(rows)), 2):
            if near(rows[i], rows[j]):
                up[i] = up[j] = min(up[i], up[j])
    return up


def test_groups_equal_brute_force(odd, small):
    for docs in (odd, small):
        texts = [(r.doc_id, _plain(r.text)) for r in docs.select("doc_id", "text").collect()]
        classes = _classes(texts, lambda a, b: (a[1] ^ b[1]).bit_count() <= 3)
        least = {}
        for (key, _), c in zip(texts, classes):
            if key is not None:
                least[c] = min(key, least.get(c, key))
        want = sorted(((k is None, k, f, least.get(c)) for (k, f), c in zip(texts, classes)), key=str)
        got = simhash.near_duplicates(docs).collect()
        assert sorted(((r.doc_id is None, r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want


def test_keep_one(odd, none):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and simhash.keep_one(none).count() == 0
    rows = kept.collect()
    texts = [_plain(r.text) for r in rows]
    assert all((a ^ b).bit_count() > 3 for a, b in combinations(texts, 2))
    assert {_plain(r.text) for r in odd.collect()} >= set(texts)
    ids = [r.doc_id for r in rows]
    assert 1 in ids and 2 not in ids and ids.count(8) == 2 and ids.count(None) == 2  # 5, 6 and a NULL row hold no word
    assert 5 in ids and 6 not in ids


def test_chains_and_dense_groups(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(1 << 62))
    dense = {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (3000, 2))}
    chain, at = set(), int(rng.integers(1 << 62))
    for i in range(60):
        at ^= 7 << (i % 20) * 3
        chain.add(at)
    alone = {int(x) for x in rng.integers(0, 1 << 62, 500)}
    values = sorted(dense | chain | alone)
    links = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long").repartition(4))
    rows = links.collect()
    assert all((r.a ^ r.b) >= 0 for r in rows) and len(rows) < 60 * len(values)
    up = {v: v for v in values}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for r in rows:
        a, b = root(r.a), root(r.b)
        up[max(a, b)] = min(a, b)
    array = np.array(values)
    want = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        labels = np.array([want[v] for v in values])
        for i, v in enumerate(values):
            low = int(labels[np.bitwise_count(array ^ v) <= 3].min())
            if low < want[v]:
                want[v], changed = low, True
    assert {v: root(v) for v in values} == want


def test_thresholds_cover_every_pair():
    both = np.full((64, 64), 250.0)
    np.fill_diagonal(both, 500)
    for n in (10, 10**4, 10**7, 10**10):
        for tau in (0, 3, 5):
            parts = simhash.plan(n, both, tau)
            bits = sorted(b for group, _ in parts for b in group)
            assert bits == sorted(set(bits))
            # whichever way tau differing bits fall on the parts, one part is within its threshold
            assert sum(t + 1 for _, t in parts) >= tau + 1
