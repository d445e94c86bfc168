"""License scans: TF-IDF cosine of lines, paragraphs and whole files to templates, then inheritance along directories."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortica.llm.shared import checkpoint
from cohortica.operators.skew import salted_join

# The wording of licences, their headers and notices.
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. ")
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. ")
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met")
_BSD_TWO = (": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
            "conditions and the following disclaimer in the documentation and/or other materials provided with the "
            "distribution. ")
_BSD_THREE = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission. ")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU = ("is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as "
        "published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")

#: Fixed values: (licence, wording); the longest wording that a file holds names it.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the software without restriction"),
    ("MIT", _MIT),
    ("MIT", _MIT + _MIT_WARRANTY),
    ("ISC", _ISC),
    ("ISC", _ISC + _ISC_WARRANTY),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program " + _GNU.format(kind="General", version="2")),
    ("GPL-3.0", "This program " + _GNU.format(kind="General", version="3")),
    ("LGPL-2.1", "This library " + _GNU.format(kind="Lesser General", version="2.1")),
    ("LGPL-3.0", "This library " + _GNU.format(kind="Lesser General", version="3")),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of "
                 "the GNU General Public License, supplemented by the additional permissions listed below."),
    ("AGPL-3.0", "This program " + _GNU.format(kind="Affero General", version="3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", _BSD),
    ("BSD-2-Clause", _BSD + _BSD_TWO),
    ("BSD-2-Clause", _BSD + _BSD_TWO + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD + _BSD_TWO + _BSD_THREE),
    ("BSD-3-Clause", _BSD + _BSD_TWO + _BSD_THREE + _BSD_WARRANTY),
    ("CC0-1.0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and "
                "related or neighboring rights to this work."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("proprietary", "All rights reserved."),
)
#: Licences that stand only where nothing else was found: their wording is part of other licences' notices.
LAST_RESORT = ("proprietary",)
#: A line, paragraph or file with a cosine of at least this names the licence.
LEAST = 0.7
#: Names of files whose licence holds for their directory.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\.[a-z]+)?$"
_TERM = re.compile("[a-z0-9]+")
_FLUSH = 200_000  # terms that a task counts before it hands them on


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(term, n): documents with each term, over whole texts of all rows; the term '' counts the rows."""

    def counted(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                seen.update(set(terms(t.as_py() or "")))
                seen[""] += 1
                if len(seen) > _FLUSH:
                    yield counted(seen)
                    seen = Counter()
        yield counted(seen)

    return texts.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Matcher:
    """Weights of the templates' terms, and what of a cosine they alone decide."""

    def __init__(self, templates: tuple[tuple[str, str], ...], documents: int, frequency: dict[str, int], least: float):
        bags = [Counter(terms(text)) for _, text in templates]
        self.least = least
        self.last = [name in LAST_RESORT for name, _ in templates]
        self.idf = {t: math.log((1 + documents) / (1 + frequency.get(t, 0))) + 1 for t in sorted(set().union(*bags))}
        norms = [math.sqrt(sum((n * self.idf[t]) ** 2 for t, n in bag.items())) for bag in bags]
        self.by_term: dict[str, list[tuple[int, float]]] = {}
        for i, bag in enumerate(bags):
            for t, n in bag.items():
                self.by_term.setdefault(t, []).append((i, n * self.idf[t] / norms[i]))
        by_weight = sorted(range(len(bags)), key=lambda i: (round(norms[i], 9), -i))
        self.rank = {i: at for at, i in enumerate(by_weight)}

    def near(self, words: list[str]) -> list[tuple[int, float, float, tuple[tuple[str, int], ...]]]:
        """(template, dot, squared norm of the templates' terms, other terms with counts) of the nearest template of
        each kind (last resort or not) that may have a cosine of `least`.

        A term that no template has weighs at least one, so the bound holds whatever its frequency is.
        """
        idf, floor = self.idf, self.least * self.least
        known = Counter([w for w in words if w in idf])
        if not known:
            return []
        inner = sum((n * idf[t]) ** 2 for t, n in known.items())
        if inner < floor * (inner + len(words) - known.total()):
            return []  # even a template of just these terms would be too far
        dots = [0.0] * len(self.last)
        for t, n in known.items():
            weight = n * idf[t]
            for i, share in self.by_term[t]:
                dots[i] += weight * share
        best = []
        for last in (False, True):
            dot, i = max(((round(d, 9), -i) for i, d in enumerate(dots) if self.last[i] == last), default=(0.0, 0))
            if dot > 0 and dot * dot >= (floor - 1e-9) * (inner + len(words) - known.total()):
                best.append((-i, dot))
        if not best:
            return []
        others = Counter([w for w in words if w not in idf])
        outer = sum(n * n for n in others.values())
        listed = tuple(sorted(others.items()))
        return [(i, dot, inner, listed) for i, dot in best if dot * dot >= (floor - 1e-9) * (inner + outer)]

    def hits(self, text: str) -> list[tuple]:
        """near() of each line, paragraph and the whole text, as (unit, place, rank, template, dot, inner, others).

        Units are 0 for lines, 1 for paragraphs of several lines (parted by lines without a term), 2 for the whole. Of units
        that read the same the first counts.
        """
        lines = [terms(line) for line in text.split("\n")]
        found, paragraph = {}, []
        for at, words in enumerate([*lines, []]):
            if words:
                paragraph.append(words)
                units = [(0, words)]
            else:
                units = [(1, [w for line in paragraph for w in line])] if len(paragraph) > 1 else []
                paragraph = []
            for unit, bag in units:
                for i, dot, inner, others in self.near(bag):
                    found.setdefault((unit, i, round(inner, 9), dot, others), at)
        for i, dot, inner, others in self.near([w for line in lines for w in line]):
            found[2, i, round(inner, 9), dot, others] = 0
        return [(unit, at, self.rank[i], i, dot, inner, others) for (unit, i, inner, dot, others), at in found.items()]


_HITS = pa.list_(pa.struct([("unit", pa.int32()), ("place", pa.int32()), ("rank", pa.int32()), ("template", pa.int32()),
                            ("dot", pa.float64()), ("inner", pa.float64()),
                            ("others", pa.list_(pa.struct([("term", pa.string()), ("times", pa.int64())])))]))
_HITS_DDL = ("array<struct<unit: int, place: int, rank: int, template: int, dot: double, inner: double, "
             "others: array<struct<term: string, times: bigint>>>>")


def score_files(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """Replace `text` in files[text, ...] by own, own_score (licence and cosine of the file's best hit, or NULL),
    last (the licence is a last resort) and is_licence (its whole text is a hit).

    Frequencies of all terms of the corpus stay a table. A pass over the texts keeps what may be near enough, judged by
    the templates' own terms; the other terms of those few units are joined with the table for the exact cosine.
    Hits to licences of last resort give way to others; else the heaviest template wins, then the larger cosine, the
    larger unit and the earlier place.
    """
    counts = checkpoint(document_frequencies(files.select("text")))
    vocabulary = sorted({w for _, t in templates for w in terms(t)})
    frequency = {r.term: r.n for r in counts.where(F.col("term").isin(["", *vocabulary])).collect()}  # a row per template term
    documents = frequency.pop("", 0)
    matcher = Matcher(templates, documents, frequency, least)
    others = [c for c in files.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("unit", "place", "rank", "template", "dot", "inner", "others")
        for batch in batches:
            found = [[dict(zip(names, h)) for h in matcher.hits(t.as_py() or "")] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(found, _HITS)], [*others, "hits"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.select(*others).schema) + f", hits {_HITS_DDL}"
    # written once, so that a row keeps its number in every job
    found = checkpoint(files.mapInArrow(run, schema)).withColumn("_row", F.monotonically_increasing_id())
    hits = found.where(F.size("hits") > 0).select("_row", F.posexplode("hits").alias("_at", "hit"))
    words = hits.select("_row", "_at", F.explode("hit.others").alias("other")).select("_row", "_at", "other.term", "other.times")
    idf = F.log((F.lit(1.0 + documents)) / (1 + F.col("n"))) + 1
    outer = (salted_join(words, counts.where("term <> ''"), "term", "inner")
             .groupBy("_row", "_at").agg(F.sum((F.col("times") * idf) ** 2).alias("outer")))
    name = F.element_at(F.array(*[F.lit(n) for n, _ in templates]), F.col("hit.template") + 1)
    cosine = F.round(F.col("hit.dot") / F.sqrt(F.col("hit.inner") + F.coalesce("outer", F.lit(0.0))), 9)
    best = (hits.join(outer, ["_row", "_at"], "left").select("_row", "hit.*", name.alias("own"), cosine.alias("own_score"))
            .where(F.col("own_score") >= least).withColumn("first", ~F.col("own").isin(*LAST_RESORT))
            .groupBy("_row").agg(
                F.max(F.struct("first", "rank", "own_score", "unit", (-F.col("place")).alias("before"), "own")).alias("best"),
                F.max(F.col("unit") == 2).alias("is_licence")))
    return found.join(best, "_row", "left").select(
        *others, F.col("best.own").alias("own"), F.col("best.own_score").alias("own_score"),
        (~F.col("best.first")).alias("last"), F.coalesce("is_licence", F.lit(False)).alias("is_licence"))


def directory(path: Column) -> Column:
    """Everything before the last slash; files without one are in the root, ''."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), F.lit(""))


def scan(docs: DataFrame, doc_id: str = "doc_id", path: str = "path", text: str = "text",
         templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(doc_id, path, licence, score, basis, from_directory), one row per row of `docs`.

    A file's own licence is that of the heaviest template that a line, a paragraph of several lines (basis header) or
    its whole text (basis file) is at least `least` near to; ties go to the nearer, and "all rights reserved" stands only
    where nothing else does. Else it inherits that of the nearest ancestor directory, its own first, with a licence
    file: one that is named so and has a licence, or whose whole text is one; of several one that is no last resort,
    then the nearest to its template decides, ties by path and name. No licence: NULL, score 0, basis none. NULL and
    empty texts have none of their own; NULL paths inherit nothing. A text is one task's memory, however long; its
    units are judged one by one. Repeated rows and ids each have their row; an empty table gives no rows; other columns
    are left alone.
    """
    files = docs.select(F.col(doc_id).alias("doc_id"), F.col(path).alias("path"), F.col(text).alias("text"))
    scored = checkpoint(score_files(files, templates, least).withColumn("dir", directory(F.col("path"))))
    named = F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_FILE)
    holds = (scored.where(F.col("own").isNotNull() & F.col("dir").isNotNull() & (named | F.col("is_licence")))
             .groupBy("dir").agg(F.max(F.struct(~F.col("last"), "own_score", F.col("path").alias("by"), "own")).alias("holds")))
    parts = F.when(F.col("dir") != "", F.split("dir", "/")).otherwise(F.array().cast("array<string>"))
    above = scored.where("dir is not null").select("dir").distinct().select("dir", parts.alias("parts")).select(
        "dir", F.explode(F.sequence(F.lit(0), F.size("parts"))).alias("depth"), "parts").select(
        "dir", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("ancestor"))
    nearest = (above.join(holds.select(F.col("dir").alias("ancestor"), "holds"), "ancestor").groupBy("dir")
               .agg(F.max(F.struct("depth", "ancestor", "holds")).alias("from")))
    joined = scored.join(nearest, "dir", "left")
    own = F.col("own").isNotNull()
    inherits = ~own & F.col("from").isNotNull()
    return joined.select(
        "doc_id", "path", F.when(own, F.col("own")).otherwise(F.col("from.holds.own")).alias("licence"),
        F.round(F.when(own, F.col("own_score")).otherwise(F.coalesce("from.holds.own_score", F.lit(0.0))), 6).alias("score"),
        F.when(own, F.when(F.col("is_licence"), "file").otherwise("header")).when(inherits, "inherited").otherwise("none").alias("basis"),
        F.when(inherits, F.col("from.ancestor")).alias("from_directory"))
