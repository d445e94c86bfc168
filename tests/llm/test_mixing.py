import re

import pytest
from pyspark.sql import functions as F

from cohortica.llm import mixing


def test_targets_by_resharing(odd):
    rows = mixing.with_copies(odd).collect()
    sizes = {}
    for r in odd.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s)), [1, 2, 3] * len(sizes)))
    want, free, rest = {}, set(sizes), sum(sizes.values())
    while free:
        share = {s: rest * weights[s] / sum(weights[f] for f in free) for f in [0] for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            want |= share
            break
        want |= {s: 3 * sizes[s] for s in over}
        free -= over
        rest -= sum(3 * sizes[s] for s in over)
    for r in rows:
        assert r.target == pytest.approx(want[r.row.source]) and r.source_size == sizes[r.row.source]
        rate = min(3, want[r.row.source] / sizes[r.row.source]) if sizes[r.row.source] else 0
        assert r.copies in (int(rate), int(rate) + 1) and r.copies <= 3


def test_reruns_agree_and_stay_near(small):
    a, b = (sorted((r.doc_id, r.copies) for r in mixing.with_copies(small.repartition(n)).collect()) for n in (2, 5))
    assert a == b
    by = mixing.with_copies(small).groupBy("row.source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("t"))
    assert by.agg(F.sum("taken") / F.sum("t")).first()[0] == pytest.approx(1, abs=0.25)


def test_mix_keeps_columns(odd, none):
    out = mixing.mix(odd)
    assert out.columns == odd.columns
    assert out.count() == mixing.with_copies(odd).agg(F.sum("copies")).first()[0]
    assert mixing.mix(none).count() == 0
    assert mixing.mix(odd.where("text is null")).count() == 0
