"""A corpus from raw documents to token ids, stage by stage.

Every stage takes a table with columns doc_id and text, and lang, source and n_chars where it has them. All other
columns are passed on unchanged whatever their names, for they travel in one struct. Null, repeated and
empty rows, ties and empty tables have the results that the operators' docstrings state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stagecheck.llm import language, neardup, pieces, privacy, tiling
from stagecheck.llm.common import settle, table
from stagecheck.storage import delete_path, pin_scope

#: Columns that operators look at; no operator gives a result one of these names.
CORE = ("doc_id", "text", "lang", "source", "n_chars")
_OTHERS = "_others"


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns outside ``CORE`` in one struct, by number, so that no name of theirs meets one of ours."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in CORE]
    packed = [F.struct(*[c.alias(f"_{i}") for i, c in enumerate(others)]).alias(_OTHERS)] if others else []
    return docs.select(*[c for c in docs.columns if c in CORE], *packed)


def _unpacked(docs: DataFrame, columns: list[str]) -> DataFrame:
    others = [c for c in columns if c not in CORE]
    return docs.select(*[F.col(c) if c in CORE else F.col(f"{_OTHERS}._{others.index(c)}").alias(c) for c in columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from the labelled three fourths.

    Without any labelled row nothing is recognised. A null or wordless text is not.
    """
    own = _packed(docs)
    model = language.learn_languages(own.where(~language.held_out()))
    kept = language.predict_languages(own, model, keep=own.columns).where(~F.col("rejected"))
    return _unpacked(kept, docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id; texts without words are copies of each other."""
    return _unpacked(neardup.keep_one(_packed(docs)), docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; null and empty texts hold none."""
    own = _packed(docs)
    found = tiling.find_contamination(own, table(spark, sf_dir, "benchmark"), keep=own.columns)
    return _unpacked(found.where(~F.col("contaminated")), docs.columns)


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and disclosing terms replaced; n_chars, if there, follows the text.

    A null text becomes an empty one.
    """
    own = _packed(docs)
    found = privacy.find_private(own, keep=[c for c in own.columns if c != "text"], with_text=True).withColumn("text", F.col("sanitised"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return _unpacked(found, docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and byte spans of every document that is left; a null text is an empty one."""
    return pieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", known_language), ("near-duplicates", one_of_each), ("decontamination", without_benchmark),
    ("private-data", without_private_data), ("encode", encode),
]

#: Learned and hashed stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each to the written result of the one before.

    What a stage writes for itself goes at its end, and its input once the next result stands, but for
    the last result, which the returned frame reads.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with pin_scope(spark):
            made = settle(stage(spark, docs, sf_dir), f"stage-{name}", owned=False)
        if before is not None:
            delete_path(spark, before)
        docs, before = made, made.inputFiles()[0].rsplit("/", 1)[0] if made.inputFiles() else None
    return STAGES[-1][1](spark, docs, sf_dir)
