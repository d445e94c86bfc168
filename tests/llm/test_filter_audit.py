from itertools import permutations
import random
import re

import pytest

from cohortica.llm import filter_audit
from cohortica.llm.queries import op13_filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """docs: (doc_id, text, part); labels: (doc_id, quality, toxic). Filters are run one after the other in every order."""
    rows = []
    for i, (doc_id, text, part) in enumerate(docs):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == text for o in docs):
            fails.add("E")
        mine = [l for l in labels if l[0] is not None and l[0] == doc_id]
        rows.append((part or "", fails, any(l[1] == 1 for l in mine), any(l[2] == 1 for l in mine)))
    out = []
    for part in {r[0] for r in rows}:
        here, removals, lines = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removals[f] += len(gone)
                lines.append((f, part, "".join(order), step, len(left), len(gone), sum(f in r[1] for r in here) - len(gone),
                              sum(r[1] == {f} for r in here), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(*line[1:], removals[line[0]]) for line in lines]
    return sorted(out)


def collected(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def test_equals_filters_run_in_every_order(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert collected(op13_filter_audit(spark, d)) == brute(docs, labels)


def test_odd_rows(spark, odd, none):
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (8, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, text string")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    assert collected(filter_audit.audit(odd, table)) == brute(docs, labels)
    assert collected(filter_audit.audit(odd, table.limit(0))) == brute(docs, [])
    assert filter_audit.audit(none, table).count() == 0


def test_all_copies_in_one_group(spark):
    rows = [(i, "same text " * 30, "p" if i % 3 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(0, 1, 1)], "doc_id long, quality int, toxic int")
    assert collected(filter_audit.audit(df, labels)) == brute(rows, [(0, 1, 1)])


def test_swaps_meet_every_order_once():
    for n in range(1, 6):
        letters = list(range(n))
        seen = {tuple(letters)}
        for level in filter_audit.adjacent_swaps(n):
            letters[level], letters[level + 1] = letters[level + 1], letters[level]
            assert tuple(letters) not in seen
            seen.add(tuple(letters))
        assert len(seen) == len(list(permutations(range(n))))


@pytest.mark.parametrize("seed", range(5))
def test_swapped_diagram_equals_one_built_in_that_order(seed):
    draw = random.Random(seed)
    counts = {m: (draw.randrange(5), draw.randrange(3)) for m in range(32) if draw.random() < 0.6}
    diagram = filter_audit.Diagram(counts)
    for level in filter_audit.adjacent_swaps(5):
        diagram.swap(level)
        fresh = filter_audit.Diagram(counts, diagram.order)
        assert list(diagram.all_pass()) == list(fresh.all_pass())
