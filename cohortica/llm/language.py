"""Language identification: family first, then one-versus-one linear support vector machines.

Texts become L2-normed counts of hashed character n-grams. One set of machines separates families; a set for
each family separates its languages. Machines are fitted on the executors, one group per machine, on a
bounded hash sample of labelled rows; prediction reads whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


#: Families of related languages; a language in none is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "tk"),
    "indic": ("hi", "ur", "bn", "mr", "ne", "pa", "gu"),
}
DIMENSIONS = 4096
#: At most about so many labelled rows of each language are used for fitting (a hash sample, not a prefix).
SAMPLE_PER_LANGUAGE = 1000
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def family_of(language: str, families: dict[str, tuple[str, ...]] = FAMILIES) -> str:
    return next((f for f, members in families.items() if language in members), language)


def features(text: str, block: int = 1 << 20) -> np.ndarray:
    """L2-normed counts of the hashed 1-, 2- and 3-grams of the letters of a whole text, words set apart by spaces."""
    letters = " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    codes = np.frombuffer(letters.encode("utf-32-le", "replace"), np.uint32)
    counts = np.zeros(DIMENSIONS)
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    for at in range(0, len(codes), block):  # blocks overlap by two characters, so that no n-gram is lost
        c = codes[max(0, at - 2):at + block]
        fresh = min(at, 2)
        grams = c * _MIX[0]
        counts += np.bincount(grams[fresh:] >> shift, minlength=DIMENSIONS)
        for order in (1, 2):
            if len(c) > order:
                grams = (grams[:-1] ^ (grams[:-1] >> np.uint32(15))) * _MIX[1] + c[order:] * _MIX[2]
                new = grams[max(0, fresh - order):]
                counts += np.bincount((new * _MIX[0]) >> shift, minlength=DIMENSIONS)
    return (counts / np.sqrt((counts ** 2).sum())).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def fit_machine(x: np.ndarray, y: np.ndarray, strength: float = 1e-4, rounds: int = 150) -> np.ndarray:
    """Weights and bias (last) of a linear machine with squared hinge loss; classes +1 and -1 weigh the same.

    Accelerated gradient steps from zero, so equal rows give equal weights.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    step = 1.0 / (2 * 2.0 + strength)  # rows have norm sqrt(2), weights sum to one
    w, ahead, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    for _ in range(rounds):
        gap = np.maximum(0, 1 - y * (x @ ahead))
        slope = -2 * ((weight * gap * y) @ x) + strength * ahead
        after, t_after = ahead - step * slope, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = after + (t - 1) / t_after * (after - w)
        w, t = after, t_after
    return w


class Model:
    """Machines by (scope, first, second): positive margins speak for `first`. Scope "" holds the families."""

    def __init__(self, languages: list[str], families: dict[str, tuple[str, ...]] = FAMILIES):
        self.members: dict[str, list[str]] = {}
        for language in sorted(languages):
            self.members.setdefault(family_of(language, families), []).append(language)
        self.problems = [("", a, b) for a, b in combinations(sorted(self.members), 2)]
        self.problems += [(f, a, b) for f in sorted(self.members) for a, b in combinations(self.members[f], 2)]
        self.weights = np.zeros((len(self.problems), DIMENSIONS + 1))

    def roles(self, families: dict[str, tuple[str, ...]] = FAMILIES) -> list[tuple[str, int, float]]:
        """(language, machine, +1 or -1) for every machine that a language takes part in."""
        out = []
        for f, members in self.members.items():
            for language in members:
                for k, (scope, a, b) in enumerate(self.problems):
                    me = f if scope == "" else language if scope == f else None
                    if me in (a, b):
                        out.append((language, k, 1.0 if me == a else -1.0))
        return out

    def _elect(self, scope: str, names: list[str], margins: np.ndarray) -> tuple[str, float]:
        """The name with most votes, ties by its margins, then by name; and its least sure victory."""
        votes, sums, least = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
        for k, (s, a, b) in enumerate(self.problems):
            if s == scope and a in votes and b in votes:
                m = margins[k]
                votes[a if m >= 0 else b] += 1
                for name, own in ((a, m), (b, -m)):
                    sums[name] += own
                    least[name] = min(least[name], own)
        best = min(names, key=lambda n: (-votes[n], -sums[n], n))
        return best, float(least[best])

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score); score is the logistic of the least sure decision on the way, 0 for `und`."""
        if not self.members or not has_letter(text):
            return "und", 0.0
        x = features(text)
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        family, sure = self._elect("", sorted(self.members), margins)
        language, more = self._elect(family, self.members[family], margins)
        low = min(sure, more)
        return language, 1.0 if low == np.inf else float(1 / (1 + np.exp(-4 * low)))


def held_out(docs: DataFrame, doc_id: str = "doc_id"):
    """Whether crc32 of the id as text is divisible by 5; NULL ids are not held out, and not learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        sample: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from labelled rows that are not held out: about `sample` of each language, drawn by a hash of the id.

    Texts without a letter teach nothing: a label that has no other texts is not a language of the model.
    """
    labelled = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(docs, doc_id) & F.col("text").rlike(r"\p{L}"))
    counts = labelled.groupBy("lang").count().collect()  # a row per language
    model = Model([r["lang"] for r in counts])
    roles = model.roles()
    if not roles:
        return model
    spark = docs.sparkSession
    shares = spark.createDataFrame([(r["lang"], min(1.0, sample / r["count"])) for r in counts], "lang string, share double")
    parts = spark.createDataFrame(roles, "lang string, machine int, y double")
    draw = (F.xxhash64(F.lit(6), "doc_id") % 1_000_000 + 1_000_000) % 1_000_000
    rows = (labelled.join(F.broadcast(shares), "lang").where(draw < F.col("share") * 1_000_000)
            .select("lang", "text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(l, features(t).tobytes()) for l, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                     if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()),
                                              pa.array([p[1] for p in pairs], pa.binary())], ["lang", "x"])

    def solve(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["y", "x"])
        x = np.frombuffer(b"".join(group["x"]), np.float32).reshape(-1, DIMENSIONS)
        w = fit_machine(x, group["y"].to_numpy(np.float32))
        return pd.DataFrame({"machine": [key[0]], "w": [w.astype(np.float64).tobytes()]})

    # at most languages x sample rows in all, (languages - 1) x sample in a machine's group
    measured = rows.mapInArrow(measure, "lang string, x binary").join(F.broadcast(parts), "lang")
    solved = measured.groupBy("machine").applyInPandas(solve, "machine int, w binary").collect()  # a row per machine
    for row in solved:
        model.weights[row["machine"]] = np.frombuffer(row["w"], np.float64)
    return model


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `lang_pred`, `score` to rows `docs[text, ...]`, dropping the text. NULL texts and those without a letter: und, 0."""
    others = [c for c in docs.columns if c != text]
    schema = docs.select(*others).schema.add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # machines x 4096 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], [*others, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
            sample: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of `docs`, from its text alone.

    Repeated rows and ids each have their row; NULL labels are only left out of fitting. Without labelled rows
    every text is `und`. Other columns are left alone.
    """
    model = fit(docs, text, lang, doc_id, sample)
    plain = docs.select(F.col(doc_id).alias("doc_id"), held_out(docs, doc_id).alias("held_out"), F.col(text).alias("text"))
    return identify(plain, model)


def keep_identified(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
                    sample: int = SAMPLE_PER_LANGUAGE, least: float = 0.5, languages: tuple[str, ...] | None = None) -> DataFrame:
    """`docs`, all its columns, without the rows whose language is not told, or is not wanted.

    Rejected are NULL texts, texts without a letter, texts whose score is below `least` (below 0.5 the best
    language loses one of its own duels, so no language stands out) and, where `languages` names the wanted ones,
    texts predicted as another. Repeated rows and ids are judged row by row; extra columns are kept as they are.
    """
    model = fit(docs, text, lang, doc_id, sample)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    judged = identify(rows.select("row", F.col(f"row.`{text}`").alias("text")), model)
    wanted = (F.col("lang_pred") != "und") & (F.col("score") >= least)
    if languages is not None:
        wanted &= F.col("lang_pred").isin(*languages)
    return judged.where(wanted).select("row.*")
