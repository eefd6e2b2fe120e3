"""Language model: held-out accuracy, calibration, defined cases."""

import random
import string
import zlib

import numpy as np

from stagecheck.llm import language


def test_held_out_accuracy_and_nothing_but_text_is_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn_languages(docs.where(~language.held_out()))
    assert model.labels == ["de", "en", "es", "fr"]
    moved = docs.selectExpr("doc_id + 10 AS doc_id", "text", "'zz' AS lang", "'none' AS source", "lang AS truth")
    rows = language.predict_languages(moved, model, keep=("doc_id", "truth")).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id - 10).encode()) % 4 == 2]
    assert len(held) > 200 and sum(r.lang_pred == r.truth for r in held) / len(held) > 0.98
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    own = {r.doc_id: (r.lang_pred, r.score) for r in language.predict_languages(docs, model).collect()}
    assert own == {r.doc_id - 10: (r.lang_pred, r.score) for r in rows}


def test_texts_unlike_any_language_score_low(spark):
    rows = [(i, " ".join(["abcde"] * n), "aa") for i, n in enumerate(range(5, 45))]
    rows += [(100 + i, " ".join(["vwxyz"] * n), "bb") for i, n in enumerate(range(5, 45))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn_languages(df)
    odd = spark.createDataFrame([(1, "abcde abcde"), (2, "abcde vwxyz")], "doc_id long, text string")
    sure, torn = sorted(language.predict_languages(odd, model).collect(), key=lambda r: r.doc_id)
    assert sure.lang_pred == "aa" and sure.score > torn.score


def test_defined_cases(spark):
    df = spark.createDataFrame(
        [(1, "der das", "de", 0.5), (1, "der das", "de", 0.5), (None, None, "de", 0.5), (3, "", None, 0.5), (4, "123 ²½ _-_", "fr", 0.5),
         (5, "a" * 100_000, "de", 0.5)], "doc_id long, text string, lang string, score double")
    model = language.learn_languages(df)
    rows = language.predict_languages(df, model).collect()
    assert len(rows) == 6
    assert {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in rows if r.doc_id in (None, 3, 4)} == dict.fromkeys((None, 3, 4), ("und", 0.0, True))
    assert {r.lang_pred for r in rows if r.doc_id in (1, 5)} == {"de"}
    assert language.learn_languages(df.where("false")) is None
    assert [r.lang_pred for r in language.predict_languages(df.limit(1), None).collect()] == ["und"]
    held = {r[0]: r[1] for r in df.select("doc_id", language.held_out().alias("h")).collect()}
    assert held == {d: zlib.crc32(("" if d is None else str(d)).encode()) % 4 == 2 for d in held}


def test_the_sample_is_bounded(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "concat('word', id % 7) AS text", "if(id % 9 = 0, 'aa', 'bb') AS lang")
    seen = {}

    def spy(rows, seed=7):
        seen["n"] = len(rows)
        return original(rows, seed)

    original, language.train = language.train, spy
    try:
        language.learn_languages(df, per_language=50)
    finally:
        language.train = original
    assert 40 < seen["n"] <= 400


def test_foreign_and_random_texts_go_though_some_labels_are_wrong(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wrong = "if(crc32(cast(doc_id AS string)) % 50 = 7, if(lang = 'en', 'de', 'en'), lang) AS lang"
    model = language.learn_languages(docs.where(~language.held_out()).selectExpr("doc_id", "text", wrong))
    draw = random.Random(2)
    noise = [" ".join("".join(draw.choices(string.ascii_lowercase, k=draw.randint(3, 9))) for _ in range(80)) for _ in range(20)]
    foreign = ["всем привет это текст на русском языке который никто не учил " * 5, "これは日本語の文章です。誰も学んでいません。" * 5,
               "to jest tekst w języku polskim którego nikt się nie uczył przed chwilą " * 3]
    odd = spark.createDataFrame(list(enumerate(noise + foreign)), "doc_id long, text string")
    assert all(r.rejected for r in language.predict_languages(odd, model).collect())
    clean = language.predict_languages(docs.where(language.held_out()), model).collect()
    assert sum(r.rejected for r in clean if r.lang_pred != "und") <= 0.01 * len(clean)


def test_bytes_and_labels_are_bounded(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id AS doc_id", "concat('word', id % 7, ' other', id % 11) AS text", "concat('l', id % 10) AS lang")
    seen = {}
    original = language.train
    monkeypatch.setattr(language, "train", lambda rows, seed=7: seen.update(rows=rows) or original(rows, seed))
    monkeypatch.setattr(language, "MOST_LABELS", 4)
    monkeypatch.setattr(language, "SAMPLE_BYTES", 20_000)
    model = language.learn_languages(df, per_language=200)
    assert model.labels == ["l0", "l1", "l2", "l3"]
    assert 8_000 < sum(b.nbytes + c.nbytes for _, b, c in seen["rows"]) < 30_000


def test_predictions_are_those_of_the_plain_formula(spark):
    """Mean embedding, softmax and temperature, n-gram by n-gram, against the cached sums of words."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.learn_languages(docs)
    got = {r.doc_id: r for r in language.predict_languages(docs, model).collect()}
    for row in docs.collect():
        buckets, counts = language._features(row.text or "")
        if not len(buckets):
            assert got[row.doc_id].lang_pred == "und"
            continue
        share = counts.astype(float) / counts.sum()
        z = (share @ model.weights[buckets] + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        best = int(p.argmax())
        usual = share @ model.usual[buckets, best]
        assert got[row.doc_id].lang_pred == model.labels[best]
        assert abs(got[row.doc_id].score - (p[best] if usual >= model.least_usual else 0.0)) < 1e-4
