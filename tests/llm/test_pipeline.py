"""The five stages together against plain Python over the same rows."""

import hashlib
import re
import shutil
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cohortica.llm import language, token_files

from .test_simhash import _classes, _plain
from .test_winnowing import _brute

SOURCE = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _copies(rows):
    """How often the mix takes each row, from the definition: weights 1, 2, 3 by source, targets at most 3 times its size."""
    size = lambda r: len(WORDS.findall(r.text or ""))
    sizes = Counter()
    for r in rows:
        sizes[r.source] += size(r)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, free, rest = {}, set(order), sum(sizes.values())
    while free:
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for f in [0] for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        target |= {s: 3 * sizes[s] for s in over} or share
        free = free - over if over else set()
        rest -= sum(3 * sizes[s] for s in over)
    out = []
    for r in rows:
        rate = min(3, target[r.source] / sizes[r.source]) if sizes[r.source] else 0
        seed = f"42:{'~' if r.doc_id is None else r.doc_id}:{hashlib.md5(r.text.encode()).hexdigest()}"
        draw = int(hashlib.md5(seed.encode()).hexdigest()[:13], 16) / 2 ** 52
        out.append(int(rate) + (draw < rate - int(rate)))
    return out


def _run_plainly(docs, items, model):
    judged = [(r, *model.predict(r.text)) for r in docs]
    rows = [r for r, name, score in judged if name != "und" and score >= 0.5]
    prints = [_plain(r.text) for r in rows]
    classes = _classes(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for r, c in zip(rows, classes):
        if c not in first or (r.doc_id is None, r.doc_id or 0) < (first[c].doc_id is None, first[c].doc_id or 0):
            first[c] = r
    dirty = {key for key, *_, hit in _brute([(k, r.text) for k, r in enumerate(first.values())], items) if hit}
    clean = [r for k, r in enumerate(first.values()) if k not in dirty]
    plain = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    out = []
    for r, n in zip(clean, _copies(clean)):
        ids = np.array(plain.encode(r.text, add_special_tokens=False).ids + [1], "<u4")
        out += [(r.doc_id, len(ids), zlib.crc32(ids.tobytes()))] * n
    return out, len(docs) - len(rows), len(rows) - len(first), len(dirty)


@pytest.fixture()
def folder(spark, tmp_path):
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SOURCE}/benchmark.parquet").collect()]
    texts = [r.text for r in docs.orderBy("doc_id").limit(6).collect()]
    planted = [texts[0], texts[0].upper(), texts[1] + " end", "Before it. " + items[0] + " And after it.", None, "", "12 !? 34",
               "Der Hund und die Katze " * 4000]
    more = [{**docs.first().asDict(), "doc_id": 9_000_000 + k, "text": t, "lang": None, "source": None if k % 2 else "planted"}
            for k, t in enumerate(planted)]
    docs.unionByName(spark.createDataFrame(more, docs.schema)).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    shutil.copy(f"{SOURCE}/benchmark.parquet", f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_run_equals_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want, rejected, copies, dirty = _run_plainly(docs.collect(), items, language.fit(docs))
    assert rejected >= 3 and copies >= 2 and dirty >= 1  # every stage decides something
    got = sorted(corpus_pipeline.run(spark, folder).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)


def test_stages_keep_columns_and_odd_rows(spark, odd, none, folder):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns and out.count() <= 3 * docs.count()
            docs = out
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()
