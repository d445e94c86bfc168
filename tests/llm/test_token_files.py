import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cohortica.llm import token_files

PATH = public_tokenizers.path(token_files.VOCABULARY)
PLAIN = Tokenizer.from_file(PATH)
OURS = token_files.Encoder(PATH, cache=50)


def _ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="aAéÉßÀÿ.,'s! \ń\x1c İΣ<|endoftext|>0ª", max_size=40)))
def test_encoder_equals_library(text):
    assert np.frombuffer(OURS.encode(text), "<u4").tolist() == _ids(text)


def test_round_trip(odd, small, none, tmp_path):
    for k, docs in enumerate((odd, small)):
        folder = f"file://{tmp_path}/{k}"
        got = token_files.round_trip(docs, folder).collect()
        got.sort(key=lambda r: r.start)
        assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is None, i))
        start = 0
        for r in got:
            assert r.start == start
            start += r.n_tokens
        want = sorted((r.doc_id, len(_ids(r.text)) + 1, zlib.crc32(np.array(_ids(r.text) + [1], "<u4").tobytes())) for r in docs.collect()
                      if r.doc_id is not None)
        assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == want
    assert token_files.round_trip(none, f"file://{tmp_path}/none").count() == 0


def test_other_vocabularies_are_encoded_by_the_library(small, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    assert OURS.by_words and not token_files.Encoder(path).by_words
    folder = f"file://{tmp_path}/other"
    token_files.write_tokens(small, folder, vocabulary=path).collect()
    wanted = {r.doc_id: plain.encode(r.text or "", add_special_tokens=False).ids + [1] for r in small.limit(20).collect()}
    got = {}
    for part in range(len(list((tmp_path / "other").glob("tokens-*.zst")))):
        got |= token_files.read_documents(f"{tmp_path}/other", part, list(wanted))
    assert {k: v.tolist() for k, v in got.items()} == wanted
    with pytest.raises(FileExistsError):
        token_files.write_tokens(small, folder, vocabulary=path)


def test_frames_and_checksums(small, tmp_path):
    docs = [(i, np.arange(i % 7 * 300, dtype="<u4").tobytes()) for i in range(200)]
    path = tmp_path / "tokens-000000.zst"
    with path.open("wb") as out:
        writer = token_files.Writer(out, frame_bytes=4096)
        for d in docs:
            writer.add(*d)
        writer.close()
    data = path.read_bytes()
    with path.open("rb") as source:
        reader = token_files.Reader(source, len(data))
        assert len(reader) == 200 and len(reader.sizes) > 50
        assert all(reader.document(i) == ids for i, (_, ids) in enumerate(docs))
    assert {k: v.tobytes() for k, v in token_files.read_documents(str(tmp_path), 0, [3, 150])} == {3: docs[3][1], 150: docs[150][1]}
    broken = bytearray(data)
    broken[int(reader.starts[2]) + 12] ^= 255
    path.write_bytes(broken)
    with path.open("rb") as source, pytest.raises(Exception):
        reader = token_files.Reader(source, len(data))
        [reader.document(i) for i in range(200)]
