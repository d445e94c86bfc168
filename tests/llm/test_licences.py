import math
import os
import re
from collections import Counter

import pytest

from cohortica.llm import licences

_words = re.compile("[a-z0-9]+").findall


def _brute(rows):
    """Cosines over full vectors with the frequencies of all words, and a walk up the directories of each file."""
    bags = [(n, Counter(_words(t.lower()))) for n, t in licences.TEMPLATES]
    df = Counter(t for _, _, text in rows for t in set(_words((text or "").lower())))

    def vector(bag):
        return {t: n * (math.log((1 + len(rows)) / (1 + df[t])) + 1) for t, n in bag.items()}

    def norm(v):
        return math.sqrt(sum(x * x for x in v.values()))

    vectors = [vector(b) for _, b in bags]
    heavy = sorted(range(len(bags)), key=lambda i: (round(norm(vectors[i]), 9), -i))

    def hits(words, unit, place):
        v = vector(Counter(words))
        for last in (False, True):
            cosines = [(round(sum(x * v.get(t, 0) for t, x in vectors[i].items()) / norm(vectors[i]), 9), -i)
                       for i, (n, _) in enumerate(bags) if (n == "proprietary") == last]
            dot, i = max(cosines)
            if words and round(dot / norm(v), 9) >= licences.LEAST:
                yield not last, heavy.index(-i), round(dot / norm(v), 9), unit, -place, bags[-i][0]

    own, holds = [], {}
    for _, path, text in rows:
        lines = [_words(line.lower()) for line in (text or "").split("\n")]
        found, block = [], []
        for at, line in enumerate([*lines, []]):
            found += hits(line, 0, at)
            if line:
                block.append(line)
            else:
                found += hits(sum(block, []), 1, at) if len(block) > 1 else []
                block = []
        whole = list(hits(sum(lines, []), 2, 0))
        best = max([*found, *whole], default=(None, 0, 0.0, 0, 0, None))
        own.append((best[5], best[2], bool(whole)))
        if best[5] and path is not None and (whole or re.match(licences.LICENCE_FILE, path.split("/")[-1])):
            d = path.rpartition("/")[0]
            new = (best[0], best[2], path, best[5])
            holds[d] = max(holds.get(d, new), new)
    holds = {d: h[1:] for d, h in holds.items()}
    out = []
    for (key, path, _), (name, score, is_file) in zip(rows, own):
        row = (key, path, name, score, ("file" if is_file else "header") if name else "none", None)
        if not name and path is not None:
            d = path.rpartition("/")[0]
            while True:
                if d in holds:
                    row = (key, path, holds[d][2], holds[d][0], "inherited", d)
                if d in holds or d == "":
                    break
                d = d.rpartition("/")[0]
        out.append(row)
    return out


def test_equals_brute_force(spark, odd, small, none):
    made = [(1, "LICENSE", "All rights reserved."), (2, "a/b/c/x.txt", "no licence here"), (3, "a/LICENSE.md", "Intro\nReleased under the MIT License.\nmore"),
            (4, "a/b/COPYING", "nothing of note"), (5, "a/b/y.txt", None), (6, "z/w", "words"), (7, None, "words"), (8, "a/b/c/notice", "Licensed under CC BY-NC 4.0."),
            (8, "a/b/c/LICENCE", "Licensed under the Apache License, Version 2.0."), (9, "a/b/c/d/e", ""), (10, "q/big", "the licence of words " * 3000),
            (12, "m/COPYING", "Copyright someone. All rights reserved.\n\nAll rights reserved.\n * Licensed under the Apache\n * License, Version 2.0.\n *\nend"),
            (13, "m/NOTICE", "All rights reserved."), (14, "m/n/o", "x"),
            (11, "q/head", "Some code\n# Licensed under the Apache License, Version 2.0 (the \"License\")\n" + "more code " * 90), (None, "/root", "x")]
    tables = [spark.createDataFrame(made, "doc_id long, path string, text string"),
              odd.selectExpr("doc_id", "concat(source, '/', doc_id) path", "text", "digest `dir`"),
              small.selectExpr("doc_id", "concat_ws('/', source, doc_id div 10, if(doc_id % 10 = 0, 'LICENSE', cast(doc_id as string))) path", "text")]
    for docs in tables:
        rows = [(r.doc_id, r.path, r.text) for r in docs.select("doc_id", "path", "text").collect()]
        got = sorted(map(tuple, licences.scan(docs).collect()), key=str)
        want = sorted(_brute(rows), key=str)
        assert [(*g[:3], *g[4:]) for g in got] == [(*w[:3], *w[4:]) for w in want]
        assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-5)
    assert licences.scan(none.selectExpr("doc_id", "text path", "text")).count() == 0


BSD2 = """Copyright (c) 2020, Somebody Else
All rights reserved.

""" + licences._BSD + licences._BSD_TWO + "\n\n" + licences._BSD_WARRANTY
BSD3 = BSD2.replace("the distribution. ", "the distribution.\n\n" + licences._BSD_THREE)
MIT = "MIT License\n\nCopyright (c) 2021 Somebody\n\n" + licences._MIT + "\n\n" + licences._MIT_WARRANTY
SHARED = "/usr/share/common-licenses/"


def test_whole_licence_files_are_named(spark):
    """Whole licences as they stand in repositories, wrapped lines and comment marks included, among other files."""
    wrapped = "\n".join(" * " + " ".join(w) for w in zip(*[iter(licences._BSD.split())] * 6))
    texts = {"bsd2": (BSD2, "BSD-2-Clause"), "bsd3": (BSD3, "BSD-3-Clause"), "mit": (MIT, "MIT"),
             "isc": ("Copyright (c) Somebody\n\n" + licences._ISC + "\n\n" + licences._ISC_WARRANTY, "ISC"),
             "code": ("/*\n" + wrapped + "\n * met\n */\nint main() { return 0; }", "BSD-3-Clause"),
             "rights": ("Copyright Somebody\nAll rights reserved.", "proprietary"), "prose": ("Nothing is granted here, my friend.", None)}
    for name, licence in {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
                          "MPL-2.0": "MPL-2.0", "BSD": "BSD-3-Clause"}.items():
        if os.path.exists(SHARED + name):
            with open(SHARED + name) as file:
                texts[name] = file.read(), licence
    fill = [(f"f{i}", f"f/{i}.txt", f"some words of file {i} and the rest of it as in all of the others") for i in range(50)]
    docs = spark.createDataFrame([(n, f"{n}/LICENSE", t) for n, (t, _) in texts.items()] + [(n, f"{n}/src/x.c", "int x;") for n in texts] + fill,
                                 "name string, path string, text string")
    got = {(r.doc_id, r.basis == "inherited"): r.licence for r in licences.scan(docs, doc_id="name").collect()}
    assert {n: got[n, False] for n in texts} == {n: want for n, (_, want) in texts.items()}
    assert {n: got.get((n, True)) for n in texts} == {n: want for n, (_, want) in texts.items()}
