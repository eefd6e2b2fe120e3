"""Small helpers the operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stagecheck.storage import own, scratch_path

#: What a word is wherever a contract does not say otherwise.
WORD = re.compile(r"\w+")
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str, owned: bool = True) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so that a lost executor costs no recomputation.

    If ``owned``, the innermost ``pin_scope`` deletes the table at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    if owned:
        own(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: str | Column) -> Column:
    """128 bits that stand for a text; a null text is an empty one."""
    column = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(F.coalesce(column, F.lit("")).cast("binary")))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finaliser of splitmix64), a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


def texts_of(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    """The column's values one by one, null as the empty text."""
    column = batch.column(batch.schema.get_field_index(name))
    for value in column:
        yield value.as_py() or ""


def with_text(df: DataFrame, keep: Sequence[str], text: str) -> tuple[DataFrame, str, str]:
    """``keep`` and the text, once even if it is kept too; what the text is called there; ``keep`` as a schema."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    if text in keep:
        return df.select(*keep), text, kept
    return df.select(*keep, F.col(text).alias("_text")), "_text", kept


def first_columns(batch: pa.RecordBatch, names: Sequence[str]) -> list[pa.Array]:
    return batch.columns[: len(names)]


LEAST_BITS, SIEVE_BITS = 1 << 16, 1 << 27
BITS_PER_VALUE = 64  # so that few values pass by chance


def sieve(values: DataFrame, column: str):
    """A broadcast bitmap for the written table ``values`` (a column of longs), by their number, of 16 MB at most; ``passes`` reads it.

    It spares a shuffle rows that a later join would drop; what it lets through by chance
    the join still drops. The fuller it gets, the less it spares. All of it comes to the driver by one job, for
    a job for each partition leaves the driver with the records of thousands of stages.
    """
    size = LEAST_BITS
    wanted = min(SIEVE_BITS, BITS_PER_VALUE * values.count())
    while size < wanted:
        size *= 2
    at = F.pmod(F.col(column), F.lit(size)) + 1
    parts = values.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = np.zeros(size // 8, np.uint8)
    for batch in parts.toArrow().to_batches():
        for part, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if part is not None:  # a null value is in no join
                found = np.frombuffer(own.as_buffer(), np.uint8)
                bits[(part - 1) * len(found) : part * len(found)] = found
    return values.sparkSession.sparkContext.broadcast(bits)


def passes(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the signed 64-bit ``values`` may be in the sieve."""
    at = values % (8 * len(bits))
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def free_names(names: Sequence[str], taken: Sequence[str]) -> list[str]:
    """``names``, with underscores at the end of those that ``taken`` has already (whatever the case)."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
