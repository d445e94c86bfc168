"""Token ids in binary files that can be read document by document.

A file holds whole documents in ascending doc_id order. Its parts are
  frames      independent zstandard frames of little-endian uint32 ids, each of whole documents;
  index       a skippable frame: (doc_id, n_tokens, frame) of each document, int64 x 3, compressed as one frame;
  seek table  the last skippable frame: (compressed size, size, checksum) as uint32 x 3 for each frame and
              for the index, then their number (uint32), a descriptor byte and the magic number 0x8F92EAB1.
The checksum is the low half of the content's XXH64. A reader fetches the seek table and the index from
the end of the file, then only the frames of the documents it wants.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from cohortica.llm.shared import partitions
from cohortica.operators.running import ensure_checkpoint_dir

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
FRAME_BYTES = 1 << 18
SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
NO_ID = -(1 << 63)  # stands for a NULL doc_id in an index


# ---- encoding -----------------------------------------------------------------------------------------------------

def _byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1 characters stand for
    themselves, the other bytes in turn for the characters from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


#: How the default vocabulary normalises and splits texts.
_WORD_SCHEME = (
    ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"],
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", "BPE", "</w>")


def _scheme(found: dict) -> tuple:
    """Normalisers, splitters, the splitting pattern, the kind of model and the mark of a word's end."""
    steps = (found.get("normalizer") or {}).get("normalizers") or []
    splits = (found.get("pre_tokenizer") or {}).get("pretokenizers") or []
    patterns = [s["pattern"].get("Regex") for s in splits if s["type"] == "Split"]
    return ([s["type"] for s in steps], [s["type"] for s in splits], *patterns, found["model"]["type"],
            found["model"].get("end_of_word_suffix"))


class Encoder:
    """Ids of whole texts as the tokenizers library gives them, each different word encoded once per worker.

    The vocabulary's splitting never joins characters across white space, so a text's ids are those of its
    runs between ASCII white space in turn. A run of Latin letters, at most followed by plain punctuation, is
    split further and lower-cased before it is looked up: below U+0100 neither composition nor lower-casing
    depends on what stands beside a letter, so such words go straight to the library's merges. The cache is
    emptied when full, so memory is bounded. All this holds for vocabularies that normalise and split as the
    default one does; texts go whole to the library with any other.
    """

    #: Letters whose lower case is one letter below U+0100, and punctuation that starts no contraction.
    LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")

    def __init__(self, vocabulary: str, cache: int = 250_000):
        self.tokenizer, self.limit, self.symbols = Tokenizer.from_file(vocabulary), cache, _byte_symbols()
        self.words: dict[bytes, bytes] = {}
        with open(vocabulary, encoding="utf-8") as source:
            self.by_words = _scheme(json.load(source)) == _WORD_SCHEME

    def _of(self, piece: str) -> bytes:
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merged(self, low: str) -> bytes:
        """Of lower-case Latin letters, which the vocabulary's normalising and splitting leave as they are."""
        shown = low if low.isascii() else "".join([self.symbols[b] for b in low.encode()])
        ids = [t.id for t in self.tokenizer.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, word: bytes) -> bytes:
        words, text = self.words, word.decode()
        found = self.LATIN.fullmatch(text)
        if not found:
            out = self._of(text)
        else:
            low, marks = found[1].lower(), found[2]
            key = low.encode()
            out = words.get(key)
            if out is None:
                out = words[key] = self._merged(low)
            if marks:
                out += words.get(marks.encode()) or words.setdefault(marks.encode(), self._of(marks))
        words[word] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian uint32; NULL and empty texts have none."""
        if not self.by_words:
            return self._of(text or "")
        get, learn = self.words.get, self._learn
        out = b"".join([get(w) or learn(w) for w in (text or "").encode().split()])
        if len(self.words) > self.limit:
            self.words.clear()
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder per Python worker."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


# ---- files --------------------------------------------------------------------------------------------------------

def _skippable(content: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(content)) + content


def _check(content: bytes) -> int:
    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class Writer:
    """Writes documents to an open binary file; memory holds one frame, and the index of the file."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.out, self.frame_bytes, self.squeeze = out, frame_bytes, zstandard.ZstdCompressor(level=level)
        self.open: list[bytes] = []
        self.size, self.frames, self.index, self.tokens = 0, [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > self.frame_bytes:
            self._flush()
        self.index.append((NO_ID if doc_id is None else doc_id, len(ids) // 4, len(self.frames)))
        self.open.append(ids)
        self.size += len(ids)
        self.tokens += len(ids) // 4

    def _flush(self) -> None:
        content = b"".join(self.open)
        packed = self.squeeze.compress(content)
        self.out.write(packed)
        self.frames.append((len(packed), len(content), _check(content)))
        self.open, self.size = [], 0

    def close(self) -> None:
        if self.open:
            self._flush()
        content = np.array(self.index, "<i8").reshape(-1, 3).tobytes()
        packed = self.squeeze.compress(content)
        self.out.write(_skippable(packed))
        entries = [*self.frames, (len(packed) + 8, len(content), _check(content))]
        table = b"".join(struct.pack("<III", *e) for e in entries)
        self.out.write(_skippable(table + struct.pack("<IBI", len(entries), 0x80, SEEK_MAGIC)))


class Reader:
    """Reads documents of one file by number; fetches only the frames it needs and verifies their checksums."""

    def __init__(self, source, size: int):
        self.source, self.squeeze = source, zstandard.ZstdDecompressor()
        count, _, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        table = np.frombuffer(self._at(size - 9 - 12 * count, 12 * count), "<u4").reshape(-1, 3)
        self.sizes, self.checks = table[:, :2].astype(np.int64), table[:, 2]
        self.starts = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))
        index = np.frombuffer(self._content(count - 1, 8), "<i8").reshape(-1, 3)
        self.doc_ids, self.n_tokens, self.frame = index.T
        ends = np.cumsum(self.n_tokens)
        self.before = ends - self.n_tokens  # ids of earlier documents in the file
        first = np.searchsorted(self.frame, self.frame)
        self.offset = self.before - self.before[first] if len(ends) else ends
        self.held: tuple[int, bytes] = (-1, b"")

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(int(start))
        return self.source.read(int(size))

    def _content(self, k: int, skip: int = 0) -> bytes:
        packed = self._at(self.starts[k] + skip, self.sizes[k, 0] - skip)
        content = self.squeeze.decompress(packed, max_output_size=int(self.sizes[k, 1])) if self.sizes[k, 1] else b""
        if _check(content) != self.checks[k]:
            raise ValueError(f"checksum of frame {k}")
        return content

    def __len__(self) -> int:
        return len(self.doc_ids)

    def document(self, i: int) -> bytes:
        frame = int(self.frame[i])
        if self.held[0] != frame:
            self.held = (frame, self._content(frame))
        return self.held[1][int(self.offset[i]) * 4:int(self.offset[i] + self.n_tokens[i]) * 4]


def _name(part: int) -> str:
    return f"tokens-{part:06d}.zst"


def write_tokens(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
                 vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode every whole text, append `end_id`, and write the files of `folder` (a URI all executors reach).

    Documents are range-partitioned by (doc_id, hash of the text), NULL ids last, so files in order of their
    number hold ascending ids and many rows with one id are spread. A task writes under a name of its
    attempt and then renames, so a repeated task leaves one whole file. Returns (part, n_docs, n_tokens).
    A folder that holds token files already is an error, as files of a larger run would stay beside the new ones.
    Very long texts are encoded whole, one at a time.
    """
    held, base = fs.FileSystem.from_uri(folder)
    there = held.get_file_info(fs.FileSelector(base, allow_not_found=True))
    if any(f.base_name.startswith("tokens-") and f.base_name.endswith(".zst") for f in there):
        raise FileExistsError(f"{folder} holds token files already")
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    end = np.array([end_id], "<u4").tobytes()
    order = [F.col("missing"), F.col("doc_id"), F.col("hash")]
    plain = docs.select(F.col(doc_id).isNull().alias("missing"), F.col(doc_id).cast("long").alias("doc_id"),
                        F.xxhash64(F.col(text)).alias("hash"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, opened = TaskContext.get().partitionId(), None, None
        store, base = fs.FileSystem.from_uri(folder)
        mine = f"{base}/.{_name(part)}.{uuid.uuid4().hex}"
        encode = encoder(vocabulary).encode
        for batch in batches:
            for key, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if writer is None:
                    opened = store.open_output_stream(mine)
                    writer = Writer(opened)
                writer.add(key, encode(t.as_py()) + end)
        if writer is not None:
            writer.close()
            opened.close()
            store.move(mine, f"{base}/{_name(part)}")
            yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [len(writer.index)], "n_tokens": [writer.tokens]})

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base)
    spread = plain.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order)
    return spread.select("doc_id", "text").mapInArrow(run, "part long, n_docs long, n_tokens long")


def read_digests(spark: SparkSession, folder: str, files: Iterable[tuple[int, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files (part, ids in earlier files)."""
    files = sorted(files)
    starts = dict(files)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for at in batch.column(0).to_pylist():
                part = files[at][0]
                path = f"{base}/{_name(part)}"
                with store.open_input_file(path) as source:
                    reader = Reader(source, source.size())
                    crc = [zlib.crc32(reader.document(i)) for i in range(len(reader))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.doc_ids, mask=reader.doc_ids == NO_ID), pa.array(reader.before + starts[part]),
                         pa.array(reader.n_tokens), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(run, schema)


def read_documents(folder: str, part: int, doc_ids: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(doc_id, ids) of chosen documents of one file, reading only their frames."""
    store, base = fs.FileSystem.from_uri(folder)
    wanted = set(doc_ids)
    with store.open_input_file(f"{base}/{_name(part)}") as source:
        reader = Reader(source, source.size())
        for i, key in enumerate(reader.doc_ids.tolist()):
            if key in wanted:
                yield key, np.frombuffer(reader.document(i), "<u4")


def _shared_folder(spark: SparkSession) -> str:
    """A new folder in the cluster's checkpoint folder."""
    ensure_checkpoint_dir(spark)
    folder = re.sub("^file:/+", "file:///", spark.sparkContext.getCheckpointDir())
    return f"{folder}/tokens-{uuid.uuid4().hex}"


def round_trip(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), one row per row of `docs`, read back from the files written.

    NULL and empty texts hold the end id alone. NULL ids come last; rows with one id follow each other by a hash
    of their texts, and repeated rows are repeated documents. An empty table writes no file. Other columns are
    left alone. The files stay in `folder` (default: a new one in the cluster's checkpoint folder).
    """
    folder = folder or _shared_folder(docs.sparkSession)
    written = sorted(tuple(r) for r in write_tokens(docs, folder, **options).collect())  # a row per file
    starts, before = [], 0
    for part, _, n_tokens in written:
        starts.append((part, before))
        before += n_tokens
    return read_digests(docs.sparkSession, folder, starts)
