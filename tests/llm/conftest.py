import pytest

#: Nulls in every column, empty and very long texts, repeated rows and ids, ties, and clashing extra columns.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, digest string, `group` string, fp long"


def _rows():
    base = [
        (1, "The quick brown fox jumps over the lazy dog and runs away into the dark wood today", "en", "a"),
        (2, "The quick brown fox jumps over the lazy dog and runs away into the dark wood today", "en", "a"),
        (3, "Der schnelle braune Fuchs springt über den faulen Hund.\nAll rights reserved.", "de", "b"),
        (4, "Le renard brun rapide saute par-dessus le chien paresseux.\n\nUne ligne de plus ici", "fr", None),
        (5, "", "es", "b"),
        (6, None, None, "c"),
        (7, "12 34 !!", "en", "c"),
        (8, "El zorro marrón salta sobre el perro perezoso\npassword=abcdef123456 user: alice\nhttps://x.example.org", "es", "a"),
        (8, "El zorro marrón salta sobre el perro perezoso\npassword=abcdef123456 user: alice\nhttps://x.example.org", "es", "a"),
        (8, "A different text under the same id, with AKIA" + "A1B2C3D4E5F6G7H8", "en", "a"),
        (None, "text without an id that has some words in it", "en", "a"),
        (None, "another text without an id", None, None),
        (None, None, None, None),
        (9, "word " * 30000 + "end", "en", "c"),
        (10, "😀 ünïcödé テキスト 한국어 mixed İstanbul Σίσυφος é   x\x1cy", "en", "b"),
        (11, "deadbeef" * 400 + " " + "q" * 5000, "en", "b"),
    ]
    return [(*r, len(r[1] or ""), i, "d", "g", -1) for i, r in enumerate(base)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """All documents of the smallest tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
