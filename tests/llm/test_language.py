import zlib

from cohortica.llm import language


def test_held_out_accuracy(small):
    rows = language.predict(small).join(small.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.95 * len(tested)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, none):
    rows = language.predict(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (5, 6, 7))
    assert {r.lang_pred for r in rows} <= {"en", "de", "fr", "es", "und"}
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert language.predict(none).count() == 0
    kept = language.keep_identified(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4


def test_labels_are_no_input(spark, small):
    blind = small.selectExpr("doc_id", "text", "lang", "'z' source")
    a = {r.doc_id: r.lang_pred for r in language.predict(small).collect()}
    model = language.fit(small)
    b = {r.doc_id: r.lang_pred for r in language.identify(blind.select("doc_id", "text"), model).collect()}
    assert a == b


def test_unlabelled_and_single(spark, odd):
    assert {r.lang_pred for r in language.predict(odd.withColumn("lang", odd.lang.substr(99, 1)).selectExpr(
        "doc_id", "text", "nullif(lang, '') lang")).collect()} == {"und"}
    one = language.predict(odd.selectExpr("doc_id", "text", "'xx' lang")).collect()
    assert {r.lang_pred for r in one} == {"xx", "und"}


def test_blocks_change_nothing():
    text = "Der Fuchs läuft. " * 50
    assert abs(language.features(text) - language.features(text, 97)).max() < 1e-6


def test_labels_without_usable_texts_are_no_languages(spark):
    rows = [(k, t, l) for k in range(40) for t, l in ((None, "aa"), ("", "bb"), ("12 ?", "cc"), ("der Hund und die Katze", "de"),
                                                     ("the dog and the cat", "en"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert {l for members in model.members.values() for l in members} == {"de", "en"}
    assert model.predict("the cat and the dog")[0] == "en"
    assert language.fit(docs.where("lang in ('aa', 'bb', 'cc')")).predict("hello") == ("und", 0.0)


def test_stage_rejects_the_undecided_and_the_unwanted(spark, small):
    judged = {r.doc_id: r for r in language.predict(small).collect()}
    bar = sorted(r.score for r in judged.values())[len(judged) // 3]
    kept = language.keep_identified(small, least=bar, languages=("en", "de"))
    assert kept.columns == small.columns
    want = {d for d, r in judged.items() if r.score >= bar and r.lang_pred in ("en", "de")}
    assert {r.doc_id for r in kept.collect()} == want and 0 < len(want) < len(judged)
