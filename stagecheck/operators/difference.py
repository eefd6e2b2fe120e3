"""Where two tables differ, by a tree of hash sums.

Every row has a 128-bit digest, and every key a place in a tree by the bits of its own hash. A node's
sums, of the digests of all rows below it and of their number, do not depend on order, so both
tables give theirs by one aggregate each. Levels are compared from the top; only rows below
unequal nodes are looked at again, and only those of unequal leaves are compared one by one. Of
equal tables nothing moves but the sums of the first level.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stagecheck.storage import pin

# Bits of the key's hash that the first level and every further level look at.
FIRST_BITS, MORE_BITS = 12, 8

# Rows that a leaf should hold on average, and the most bits that tell leaves apart.
LEAF_ROWS, MOST_BITS = 16, 44

# Unequal nodes that are sent to the tasks to pick rows, 8 bytes each; beyond, rows meet them by a shuffle.
SENT_NODES = 4_000_000

# How a key differs.
CHANGED, LEFT_ONLY, RIGHT_ONLY = "changed", "left_only", "right_only"

_HALVES = ("_d1", "_d2", "_d3", "_d4")


def _digest(columns: Sequence[str], seed: int) -> Column:
    """64 bits of a row; a NULL is told apart from a missing column and from its neighbour's."""
    return F.xxhash64(F.lit(seed), *[c for name in columns for c in (F.col(name).isNull(), F.col(name))])


def _side(df: DataFrame, keys: Sequence[str], values: Sequence[str], like: DataFrame, named: Sequence[str]) -> DataFrame:
    """(keys, place in the tree, digest) of the rows, values read as the types of ``like``."""
    kinds = [like.schema[n].dataType for n in named]
    rows = df.select(*[F.col(f"`{c}`").cast(k).alias(f"_{i}") for i, (c, k) in enumerate(zip([*keys, *values], kinds, strict=True))])
    every, key = rows.columns, rows.columns[: len(keys)]
    return rows.select(*key, _digest(key, 7).alias("_place"), _digest(every, 1).alias("_one"), _digest(every, 2).alias("_two"))


def _node(bits: int) -> Column:
    return F.shiftrightunsigned(F.col("_place"), 64 - bits)


def _sums(rows: DataFrame, bits: int, sign: int) -> DataFrame:
    """Sums of each node, as halves of 32 bits so that they can't run over."""
    halves = [F.col("_one").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("_one", 32),
              F.col("_two").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("_two", 32)]
    return rows.groupBy(_node(bits).alias("_node")).agg(
        *[(sign * F.sum(h)).alias(n) for n, h in zip(_HALVES, halves, strict=True)],
        (sign * F.count(F.lit(1))).alias("_rows"), F.count(F.lit(1)).alias("_seen"))


def _unequal(left: DataFrame, right: DataFrame, bits: int) -> DataFrame:
    """Nodes whose sums differ, with the rows below them on both sides."""
    both = _sums(left, bits, 1).unionAll(_sums(right, bits, -1)).groupBy("_node").agg(
        *[F.sum(c).alias(c) for c in (*_HALVES, "_rows", "_seen")])
    differs = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in (*_HALVES, "_rows")])
    return pin(both.filter(differs).select("_node", "_seen"), "unequal-nodes")


def _below(rows: DataFrame, nodes: DataFrame, count: int, bits: int) -> DataFrame:
    picked = nodes.select("_node")
    return rows.withColumn("_node", _node(bits)).join(
        F.broadcast(picked) if count <= SENT_NODES else picked, "_node", "left_semi").drop("_node")


def table_difference(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], values: Sequence[tuple[str, str]],
) -> DataFrame:
    """Keys whose rows differ: the keys under their left names, left_rows, right_rows, kind.

    Tables are compared as bags of rows. ``left_rows`` and ``right_rows`` count the rows of a key that
    have no equal on the other side; equal copies cancel out. A key with rows on both sides is
    ``changed``, else it is ``left_only`` or ``right_only``. NULLs are equal to each other.
    """
    named = [l for l, _ in (*keys, *values)]
    one = _side(left, [l for l, _ in keys], [l for l, _ in values], left, named)
    two = _side(right, [r for _, r in keys], [r for _, r in values], left, named)
    bits = FIRST_BITS
    while True:
        nodes = _unequal(one, two, bits)
        found = nodes.agg(F.count(F.lit(1)).alias("nodes"), F.coalesce(F.sum("_seen"), F.lit(0)).alias("rows")).first()
        one, two = (_below(side, nodes, found["nodes"], bits) for side in (one, two))
        if not found["nodes"] or bits >= MOST_BITS or found["rows"] <= 2 * LEAF_ROWS * found["nodes"]:
            break
        wanted = bits + math.ceil(math.log2(found["rows"] / (2 * LEAF_ROWS * found["nodes"])))
        bits = min(MOST_BITS, max(bits + 1, min(wanted, bits + MORE_BITS)))
    key = [f"_{i}" for i in range(len(keys))]
    tagged = one.withColumn("_side", F.lit(1)).unionAll(two.withColumn("_side", F.lit(-1)))
    surplus = tagged.groupBy(*key, "_one", "_two").agg(F.sum("_side").alias("_surplus")).filter(F.col("_surplus") != 0)
    rest = surplus.groupBy(*key).agg(
        F.sum(F.greatest("_surplus", F.lit(0))).alias("left_rows"), F.sum(F.greatest(-F.col("_surplus"), F.lit(0))).alias("right_rows"))
    kind = F.when(F.col("right_rows") == 0, LEFT_ONLY).when(F.col("left_rows") == 0, RIGHT_ONLY).otherwise(CHANGED)
    return rest.select(*[F.col(k).alias(l) for k, (l, _) in zip(key, keys, strict=True)], "left_rows", "right_rows", kind.alias("kind"))
