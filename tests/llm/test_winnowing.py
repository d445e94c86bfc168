import hashlib
import re

from cohortica.llm import winnowing


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _brute(docs, items):
    wins = {}
    for key, text in items:
        words = _words(text)
        n = min(10, len(words))
        for s in range(len(words) - n + 1) if n else ():
            wins.setdefault(tuple(words[s:s + n]), set()).add(key)
    out = []
    for key, text in docs:
        words, hit, ids = _words(text), set(), set()
        for n in {len(w) for w in wins}:
            for s in range(len(words) - n + 1):
                found = wins.get(tuple(words[s:s + n]))
                if found:
                    hit |= set(range(s, s + n))
                    ids |= {str(i) for i in found if i is not None}
        out.append((key, len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_equals_brute_force(spark, odd, small, none):
    items = [(1, "brown fox jumps over the lazy dog and runs away into the dark forest"), (2, "fox JUMPS"), (2, "same id, word word"),
             (3, "brown fox jumps over the lazy dog and runs away into the dark forest"), (None, "faulen Hund all rights"),
             (4, None), (5, ""), (6, "word " * 40), (7, "über den"), (8, "한국어"), (10, "zorro " * 3)]
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, digest string")
    for docs, bench in ((odd, table), (small, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))):
        got = sorted(map(tuple, winnowing.contamination(docs, bench).collect()), key=str)
        want = _brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
        assert got == want
    assert winnowing.contamination(none, table).count() == 0
    assert winnowing.contamination(odd, table.limit(0)).where("contaminated").count() == 0


def test_drop(spark, odd):
    table = spark.createDataFrame([(1, "brown fox jumps over the lazy dog and runs away into")], "item_id long, text string")
    kept = winnowing.drop_contaminated(odd, table)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    assert kept.where("doc_id in (1, 2)").count() == 0


def test_native_plan(spark, odd, small):
    table = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = winnowing.contamination(small, table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
