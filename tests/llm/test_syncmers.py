import hashlib
from collections import Counter

import numpy as np
import pytest

from cohortica.llm import syncmers


def _anchors(text, k, s):
    """Closed syncmers by their definition, with the operator's hash of each s-mer."""
    codes = np.array([ord(c) for c in text], np.uint64)
    of = [int(x) for x in syncmers._gram_hashes(codes, None, s)]
    out = [0] if 0 < len(text) < k else []
    for i in range(len(text) - k + 1):
        inner = of[i:i + k - s + 1]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


def _sketch(text):
    return syncmers.sketch(syncmers.anchors(text)[1])


def _span(a, b):
    """The shift on which most anchors agree, by the text at each anchor's first place."""
    k, first = syncmers.K, []
    for text in (a, b):
        places = {}
        for at in syncmers.anchors(text)[0].tolist():
            places.setdefault(text[at:at + k], at)
        first.append(places)
    shifts = Counter(first[1][t] - at for t, at in first[0].items() if t in first[1])
    if not shifts:
        return 0, 0, 0
    best = min(shifts, key=lambda d: (-shifts[d], d))
    own = [at for t, at in first[0].items() if t in first[1] and first[1][t] - at == best]
    return best, min(own), min(max(own) + k, len(a)) - min(own)


def test_anchors_by_definition_and_in_blocks(small):
    for r in small.limit(20).collect():
        places, hashes = syncmers.anchors(r.text)
        assert places.tolist() == _anchors(r.text, syncmers.K, syncmers.S)
        again = syncmers.anchors(r.text, block=50)
        assert (again[0] == places).all() and (again[1] == hashes).all()


def test_anchors_are_context_free():
    passage = "a passage that stands in two documents, at other places"
    a, b = "first words before " + passage + " tail", "x" + passage + " and other words after it"
    shift, first, size = syncmers.matched_span(syncmers.anchors(a), syncmers.anchors(b), len(a))
    assert shift == 1 - len("first words before ") and a[first:first + size] in passage + " "


def _brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        a, b, c = map(_sketch, (text, changed, after))
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), syncmers.as_text(a), syncmers.as_text(b),
                    syncmers.likeness(a, b), syncmers.likeness(a, c), _span(text, changed)[2], *_span(text, after)))
    return sorted(out, key=str)


def test_equals_brute_force(spark, odd, small, none):
    for docs in (odd, small, odd.limit(1), odd.where("doc_id is null"), odd.where("doc_id is null").limit(1), odd.where("doc_id = 8")):
        docs = docs.cache()
        got = sorted(map(tuple, syncmers.fingerprints(docs, rows=7).collect()), key=str)
        assert got == _brute([(r.doc_id, r.text) for r in docs.collect()])
    assert syncmers.fingerprints(none).count() == 0


def test_likeness(small):
    rows = syncmers.fingerprints(small).collect()
    assert np.mean([r.near_edited for r in rows]) > 0.25 and np.mean([r.near_next for r in rows]) < 0.1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert syncmers.likeness(_sketch(""), _sketch("")) == 1
    assert syncmers.likeness(_sketch("ab"), _sketch("ab")) == 1
    assert syncmers.likeness(_sketch("ab"), _sketch("cd")) == pytest.approx(0)
    kept = [r.kept_chars / r.n_chars for r in rows if r.n_chars > 200]
    assert np.mean(kept) > 0.4 and np.median(kept) < 0.7  # about the half that stays


def test_a_bucket_a_task(spark):
    docs = spark.range(20_000).selectExpr("id * 7 doc_id", "concat('text of some words ', id) text").repartition(5)
    sizes = syncmers.fingerprints(docs).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    filled = sorted(n for n in sizes if n)
    assert sum(filled) == 20_000 and len(filled) == syncmers.partitions(docs) and filled[-1] <= 2 * filled[len(filled) // 2]
