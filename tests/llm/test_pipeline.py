"""The pipeline against its stages done one document at a time."""

import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from stagecheck.llm import language, tiling
from tests.llm.test_neardup import brute as groups
from tests.llm.test_privacy import brute as private

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near-duplicates", "decontamination", "private-data", "encode"]


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.learn_languages(docs.where(~language.held_out()))
    predictor = language.Predictor(model)
    rows = []
    for r in docs.collect():
        label, score = predictor.predict(r.text)
        if label != "und" and score >= model.threshold:
            rows.append((r.doc_id, r.text))
    first = groups(rows)
    rows = [row for row, group in zip(rows, first, strict=True) if row[0] == group]
    items = tiling.Items([tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()])
    rows = [r for r in rows if not items.judge(r[1], tiling.COVERAGE)[2]]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(got) == sorted(r[0] for r in rows)
    for key, text in rows:
        spans = [s.split(":") for s in private(text)[2].split(",") if s]
        out, at = "", 0
        for kind, a, b in spans:
            if int(a) >= at:
                out += text[at : int(a)] + f"<{kind}>"
            at = max(at, int(b))
        assert got[key] == library.encode(out + text[at:])


def test_stages_keep_columns_nulls_and_empty_tables(spark):
    draw = random.Random(1)
    words = "the of and for that with this from have which".split()
    rows = [(i, " ".join(draw.choices(words, k=30)) if i % 5 else None, "en" if i % 3 else None, None, i) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.where("false")):
        left = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, left, SF)
            assert left.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, left, SF).count() <= frame.count()


def test_columns_of_any_name_come_through_every_stage(spark):
    """Columns named like results and inner columns of every stage, their values compared; no n_chars, lang or source."""
    names = ["score", "rejected", "lang_pred", "coverage", "items", "item_id", "contaminated", "email", "ip", "card", "phone", "spans",
             "sanitised", "_row", "_rows", "_rid", "_text_key", "n_email", "_others", "_text", "_key", "a.b", "Label x"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    docs = docs.select("doc_id", "text", "lang", *[F.concat_ws(":", F.lit(n), "doc_id").alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SF)
        assert made.columns == docs.columns
        rows = made.collect()
        assert len(rows) > 20
        for r in rows:
            assert list(tuple(r)[3:]) == [f"{n}:{r.doc_id}" for n in names]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 60
