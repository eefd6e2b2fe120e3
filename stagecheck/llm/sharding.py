"""Operator 9: shards by extendible hashing.

The directory is indexed by the leading bits of a hash. A bucket that holds more bytes than a
shard may hold is split on the next bit, and only that one, until every bucket fits. Sizes
of all prefixes come from one aggregation over cells (prefixes a few bits longer than an even
spread would need); rows of a cell that is still too large go into a further round with longer
cells. Rows of one hash can't be told apart by bits: they go to a chain of overflow pages, as do
rows that are too large by themselves, once no other row shares their cell.

Shuffled are hashes and sizes, never texts. Aggregates combine before the shuffle, so equal
keys don't gather; the running sum of a chain is taken slot by slot.

Defined cases: null keys hash as empty ones; null texts hold no bytes; repeated rows share a hash
and, beyond the limit, a chain; an empty table has no shards; a row larger than a shard stands alone
and is marked ``oversized``; other columns are passed by, and result columns whose names the key's
columns bear get underscores at their end.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stagecheck.llm.common import free_names, settle
from stagecheck.operators.numbering import in_slots

BITS = 60  # of the hash
SPARE = 6  # bits by which cells are finer than an even spread needs


def hash_bits(columns: Sequence[str]) -> Column:
    """The first 60 bits of the MD5 of the columns as text, as a number."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _leaves(cells: DataFrame, deep: int, above: int, limit: int) -> DataFrame:
    """For each cell of ``deep`` bits the bucket it belongs to: the shortest prefix that fits."""
    spread = cells.withColumn("depth", F.explode(F.sequence(F.lit(above), F.lit(deep))))
    spread = spread.withColumn("prefix", F.expr(f"shiftright(cell, {deep} - depth)"))
    fits = spread.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
    fits = settle(fits.where(F.col("shard_bytes") <= limit), "shard-fits")
    # Short prefixes hold very many cells each, and none of them fits.
    least = fits.agg(F.min("depth")).first()[0]
    spread = spread.where(F.col("depth") >= (deep if least is None else least))
    return (
        spread.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"])
        .groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("leaf"))
        .select("cell", "leaf.*")
    )


def assign_shards(df: DataFrame, max_bytes: int, text: str = "text", key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``key``, shard, depth, page, n_bytes, shard_bytes, shard_rows, oversized for each row.

    ``shard`` names the hash prefix in bits; ``page`` counts the overflow pages of one hash, else 0.
    Rows of a (shard, page) hold at most ``max_bytes`` bytes of text, but for a single larger row.
    """
    names = free_names(("shard", "depth", "page", "n_bytes", "shard_bytes", "shard_rows", "oversized"), key)
    kept = F.struct(*[F.col(f"`{c}`") for c in key]).alias("_kept")
    placed = _assigned(df.select(kept, hash_bits(key).alias("hash"), _bytes(text).alias("n_bytes")), max_bytes)
    return placed.select(*[F.col(f"_kept.`{c}`") for c in key], *[F.col(c).alias(n) for c, n in zip(_MADE, names, strict=True)])


_MADE = ("shard", "depth", "page", "n_bytes", "shard_bytes", "shard_rows", "oversized")


def _bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _assigned(rows: DataFrame, max_bytes: int) -> DataFrame:
    """``_kept`` and the result for rows (_kept, hash, n_bytes)."""
    rest = settle(rows, "shard-rows")
    total = rest.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    deep, above, parts, chained = 0, 0, [], []
    grown = max(0, math.ceil(math.log2(max(1, total / max_bytes)))) + SPARE
    while True:
        deep = min(BITS, deep + grown)
        rest = rest.withColumn("cell", F.shiftright("hash", BITS - deep))
        cells = rest.groupBy("cell").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows"))
        cells = settle(cells, "shard-sizes")
        placed = settle(_leaves(cells, deep, above, max_bytes), "shard-cells")
        parts.append(rest.join(placed, "cell").withColumn("page", F.lit(0).cast("long")))
        open_ = cells.join(placed.select("cell"), "cell", "left_anti")
        shared = open_.where((F.col("rows") > 1) & F.lit(deep < BITS))
        # A row alone in a cell that does not fit is too large for any shard: more bits would not help it.
        chained.append(rest.join(open_.join(shared, "cell", "left_anti").select("cell"), "cell", "left_semi").drop("cell"))
        if shared.isEmpty():
            break
        rest = settle(rest.join(shared.select("cell"), "cell", "left_semi").drop("cell"), "shard-rest")
        above, grown = deep, SPARE
    alone = settle(reduce(DataFrame.unionByName, chained), "shard-alone")
    if not alone.isEmpty():
        parts.append(_chain(alone, max_bytes))
    bits = F.lpad(F.bin("prefix"), F.col("depth"), "0")
    out = [
        p.withColumn("shard", F.concat(F.lit("b"), F.when(F.col("depth") > 0, bits).otherwise("")))
        .withColumn("oversized", F.col("shard_bytes") > max_bytes).select("_kept", *_MADE)
        for p in parts
    ]
    return reduce(DataFrame.unionByName, out)


def _chain(rows: DataFrame, limit: int) -> DataFrame:
    """Overflow pages of buckets that no bit can split.

    Rows over half a shard get pages of their own; the others fill pages in steps of half a shard
    by their running sum, so that the row that crosses a step still fits.
    """
    half = max(1, limit // 2)
    slots = settle(in_slots(rows.withColumn("big", F.col("n_bytes") > half), ["hash", "big"], tie_break=[]), "shard-chain")
    inside = Window.partitionBy("_slot", "hash", "big").orderBy("_position").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.when(F.col("big"), 2 * half).otherwise(F.col("n_bytes"))
    ahead = slots.groupBy("_slot", "hash", "big").agg(F.sum(weight).alias("sum"))
    before = Window.partitionBy("hash", "big").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carry = ahead.select("_slot", "hash", "big", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("carry"))
    at = F.col("carry") + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    paged = slots.join(carry, ["_slot", "hash", "big"]).withColumn("page", F.when(
        F.col("big"), 2 * (at / (2 * half)).cast("long") + 1).otherwise(2 * (at / half).cast("long")))
    sizes = paged.groupBy("hash", "page").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    return paged.join(sizes, ["hash", "page"]).withColumn("depth", F.lit(BITS)).withColumn("prefix", F.col("hash"))


def write_shards(df: DataFrame, path: str, max_bytes: int, text: str = "text", key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Write whole rows below ``path``, one folder for each shard and page, and return the directory.

    The directory is a row per folder: shard, page, shard_bytes, shard_rows. Rows are told apart by numbers of
    their own, so null and repeated keys are written as they are; an extra column named like the
    folders' (``_shard``) goes along under another name.
    """
    folder, row = free_names(("_shard", "_row"), df.columns)
    numbered = settle(df.withColumn(row, F.monotonically_increasing_id()), "shard-source")
    placed = settle(_assigned(numbered.select(
        F.col(row).alias("_kept"), hash_bits(key).alias("hash"), _bytes(text).alias("n_bytes")), max_bytes), "shard-places")
    named = placed.select(F.col("_kept").alias(row), F.concat_ws("-", "shard", "page").alias(folder))
    numbered.join(named, row).drop(row).repartition(folder).write.partitionBy(folder).parquet(path)
    return placed.groupBy("shard", "page").agg(F.max("shard_bytes").alias("shard_bytes"), F.max("shard_rows").alias("shard_rows"))
