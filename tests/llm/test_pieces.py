"""Piece encoding against the library, and its defined cases."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from stagecheck.llm.pieces import LONG, PieceCoder, encode_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "▁x ▁▁ y", "\n\n\t a", "日本語 🎉 é é", "<s></s><unk> <0x0A>", "a" * 3000, "    " * 50 + "x",
       "\x00 \x01", "hello　world ñ", "ab " * 3, "ＡＢＣ ﬁ ①  ㍿ ½", "ｶﾞ　x​ y", "é̀ \r\n ﷺ"]


def models():
    plain = open(PATH, "rb").read()
    maps = sentencepiece_model_pb2.ModelProto()
    maps.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    out = [plain]
    for squeeze in (False, True):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(plain)
        proto.normalizer_spec.precompiled_charsmap = maps.normalizer_spec.precompiled_charsmap
        proto.normalizer_spec.remove_extra_whitespaces = squeeze
        out.append(proto.SerializeToString())
    return out


@pytest.mark.parametrize("model", models(), ids=["identity", "mapped", "mapped-squeezed"])
def test_ids_spans_and_text_equal_the_librarys(spark, model):
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    coder, library = PieceCoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for text in coder.prepared(texts):
        ids, borders = coder.encode(text)
        numbers = np.frombuffer(ids, "<u4").tolist()
        proto = library.encode(text, return_type="proto")
        assert numbers == [p.id for p in proto.pieces]
        assert list(zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)) == [(p.begin, p.end) for p in proto.pieces]
        assert coder.decode(ids).decode() == library.decode(numbers)


def test_any_ids_decode_as_in_the_library():
    coder, library = PieceCoder(open(PATH, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=PATH)
    draw = random.Random(1)
    for _ in range(300):
        ids = [draw.choice([draw.randrange(3, 260), draw.randrange(32000), 1, 2]) for _ in range(draw.randrange(12))]
        assert coder.decode(np.array(ids, "<u4").tobytes()).decode() == library.decode(ids)


def test_long_stretches_merge_alike():
    coder, library = PieceCoder(open(PATH, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for size in (LONG - 1, LONG, LONG + 1, 400):
        text = "".join(random.Random(size).choices("therational", k=size))
        assert np.frombuffer(coder.encode(text)[0], "<u4").tolist() == library.encode(text)


def test_rows_nulls_repeats_and_clashing_columns(spark):
    texts = [None, "", "one two", "one two", *ODD]
    df = spark.createDataFrame([(i if i else None, t, 5, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids int, n_tokens string")
    rows = encode_texts(df, PATH).collect()
    assert len(rows) == len(texts)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for row in rows:
        text = texts[row.doc_id or 0] or ""
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids) and row.ids == ids[1:-1]
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert encode_texts(df.where(F.lit(False)), PATH).count() == 0
