import re

from cohortica.llm import secrets


def _spans(text):
    out = []
    for i, (kind, pattern, group, least) in enumerate(secrets.KINDS):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m.group(group)) >= least and (kind != "key" or len(m.group()) == 40):
                out.append((m.start(), i, m.end()))
    return out


def _linked(spans, scope=200):
    names = [k[0] for k in secrets.KINDS]
    near = lambda a, b: a[2] <= b[0] <= a[2] + scope or b[2] <= a[0] <= b[2] + scope
    return [s for s in spans if s[1] >= 3 and all(
        any(near(s, o) for o in spans if names[o[1]] in group) for group in secrets.COMPLEMENTS[names[s[1]]])]


def _text(spans):
    return ",".join(f"{secrets.KINDS[k][0]}:{s}:{e}" for s, k, e in sorted(spans))


def _brute(rows):
    out = []
    for key, text in rows:
        spans = _spans(text)
        strong = [s for s in spans if s[1] < 3]
        out.append((key, *(sum(s[1] == i for s in spans) for i in range(3)), _text(strong), _text(strong + _linked(spans))))
    return sorted(out, key=str)


def test_equals_brute_force(spark, odd, small, none):
    texts = [
        "user=alice password: hunter2hunter at https://db.example.org/x", "user=alice at https://db.example.org/x", "login = bob",
        "password=token: secret = 'abcdef'", "PassWord=abc api-key:ABCDEFGH apikey:ABCDEFGH ſecret=abcdefg", "AKIA1234 AKIA" + "Z" * 16,
        "AKIA" + "9" * 30 + " " + "aB3/" * 10 + " " + "aB3/" * 11, "é😀 password=ünicode passwd:'abc.def-' 😀" + "ab12" * 6 + "g",
        ("user=abc " + "x" * 190) * 30 + "token=abcdef", "deadbeef" * 3 + "." + "https://h/" + "a" * 900 + " user:bob",
        "user=u1 secret=s1s1s1 https://a.b/c " * 40, "client_id=me" + " " * 199 + "f" * 24, "client_id=me" + " " * 201 + "f" * 24]
    planted = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for docs in (odd, planted, small):
        got = sorted(map(tuple, secrets.scan(docs).collect()), key=str)
        want = _brute([(r.doc_id, r.text) for r in docs.collect()])
        assert got == want
    assert any("endpoint" in w[5] and "name" in w[5] for w in _brute([(0, t) for t in texts]))
    assert secrets.scan(none).count() == 0


def test_native_plan(small):
    plan = secrets.scan(small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
