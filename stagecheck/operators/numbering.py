"""Dense numbering, renumbering and key remapping without a single-task window.

Rows are range-partitioned on the wanted order, so that a slot (partition) holds a
contiguous run of it, and written once with slot and position. The number of a row is the
size of the slots before its own plus its position. Only the slot sizes, one row per slot,
meet in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stagecheck.storage import input_slots, pin

SLOT, POSITION, COPY = "_slot", "_position", "_copy"

# monotonically_increasing_id keeps the position inside the partition in its low 33 bits.
_POSITION_MASK = (1 << 33) - 1


def _columns(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def in_slots(
    df: DataFrame, order: Sequence[str | Column], tie_break: Sequence[str | Column] | None = None,
    num_partitions: int | None = None, expand: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Range-partition and sort ``df`` by ``order``; adds the slot and the position in it.

    Rows of equal order are told apart by ``tie_break``, by default a hash of the whole row,
    and exact copies by a running id, so that a large group with the same order values still
    spreads over slots. ``expand`` may turn each sorted row into several, as an explode does,
    before positions are given. The result must be pinned before it is read twice, because
    range bounds are drawn from a sample.
    """
    whole_row = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    ties = whole_row if tie_break is None else _columns(tie_break)
    if tie_break is None and any("map<" in kind for _, kind in df.dtypes):
        ties = []  # maps have no hash; such rows are told apart by the running id
    by = _columns(order) + ties + [F.col(COPY)]
    tagged = df.withColumn(COPY, F.monotonically_increasing_id())
    ranged = tagged.repartitionByRange(num_partitions or input_slots(df), *by)
    in_order = ranged.sortWithinPartitions(*by)
    if expand:
        in_order = expand(in_order)
    return with_places(in_order).drop(COPY)


def with_places(in_order: DataFrame) -> DataFrame:
    """Adds the slot of every row and its position there, to rows that partitions hold in order."""
    return in_order.withColumn(SLOT, F.spark_partition_id()).withColumn(
        POSITION, F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)))


def number_rows(
    df: DataFrame, order: Sequence[str | Column], start: int = 0, name: str = "id",
    tie_break: Sequence[str | Column] | None = None, num_partitions: int | None = None,
    expand: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Dense numbers ``start, start+1, …`` in the given order, in column ``name``.

    With ``expand`` the numbers go to the rows it makes of each ordered row, in their order.
    """
    slotted = pin(in_slots(df, order, tie_break, num_partitions, expand), "numbered")
    before = Window.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = slotted.groupBy(SLOT).count().select(
        SLOT, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"),
    )
    # One row per slot: bounded by the number of partitions, whatever the data size.
    numbered = slotted.join(F.broadcast(offsets), SLOT)
    return numbered.withColumn(name, F.col("_offset") + F.col(POSITION) + F.lit(start)).drop(SLOT, POSITION, "_offset")


def number_within(
    df: DataFrame, group: str, order: Sequence[str | Column], start: int = 1, name: str = "number",
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Dense numbers that start anew in each of a few groups, none of them NULL; a group spreads over slots.

    Rows are ordered by group first, so a slot holds few groups and one pass over (slot, group) gives
    all offsets: one row per slot and one more per group.
    """
    return number_slots_within(pin(in_slots(df, [group, *order], tie_break), "numbered"), group, start, name).select(*df.columns, name)


def number_slots_within(slotted: DataFrame, group: str, start: int = 1, name: str = "number") -> DataFrame:
    """Numbers within groups of rows whose places are written down; in a slot they are in order of the group first."""
    sizes = slotted.groupBy(SLOT, group).count()
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    ahead = lambda of, by: F.coalesce(F.sum("count").over(earlier.partitionBy(of).orderBy(by)), F.lit(0))
    shifts = sizes.select(SLOT, group, (ahead(group, SLOT) - ahead(SLOT, group)).alias("_shift"))
    numbered = slotted.join(F.broadcast(shifts), [SLOT, group])
    return numbered.withColumn(name, F.col("_shift") + F.col(POSITION) + F.lit(start)).drop(SLOT, POSITION, "_shift")


def renumber(
    df: DataFrame, key: str, order: Sequence[str | Column], start: int = 1,
) -> DataFrame:
    """Replace ``key`` by dense numbers in the given order; the old key stays as ``old_<key>``."""
    kept = df.withColumnRenamed(key, f"old_{key}")
    numbered = number_rows(kept, order, start=start, name=key, tie_break=[f"old_{key}"])
    return numbered.select(key, *kept.columns)


def key_map(renumbered: DataFrame, key: str) -> DataFrame:
    """Old key to new key, from the result of :func:`renumber`."""
    return renumbered.select(F.col(f"old_{key}").alias("old_key"), F.col(key).alias("new_key"))


def remap_fk(child: DataFrame, keys: DataFrame, fk: str) -> DataFrame:
    """Follow a renumbered parent: ``fk`` becomes the parent's new key, NULL for an unknown parent.

    The map is unique on its old key, so rows never multiply, and a parent with very many
    children only makes a skewed left side, which the adaptive join splits.
    """
    joined = child.join(keys, child[fk] == keys["old_key"], "left")
    return joined.withColumn(fk, F.col("new_key")).select(*child.columns)


def number_groups(
    df: DataFrame, group: str, order: Sequence[str], name: str = "group_id", start: int = 1,
) -> DataFrame:
    """Number groups by their first appearance in the given order.

    The first appearance is a map-side combined minimum, so only distinct groups are numbered.
    """
    firsts = df.groupBy(group).agg(F.min(F.struct(*order)).alias("_first"))
    numbered = number_rows(firsts, ["_first"], start=start, name=name, tie_break=[group])
    keys = numbered.select(F.col(group).alias("_group"), name)
    return df.join(keys, df[group].eqNullSafe(keys["_group"]), "left").drop("_group")


def reorder_children(child: DataFrame, keys: DataFrame, fk: str, key: str) -> DataFrame:
    """Number children in the order of their renumbered parents, old key as ``old_<key>``.

    ``fk`` becomes the place of the parent among the parents that have children. Children
    without a known parent are left out.
    """
    mapped = remap_fk(child, keys, fk).filter(F.col(fk).isNotNull()).withColumnRenamed(key, f"old_{key}")
    parents = number_rows(mapped.select(fk).distinct(), [fk], start=1, name="_parent", tie_break=())
    placed = mapped.join(parents, fk).withColumn(fk, F.col("_parent")).drop("_parent")
    numbered = number_rows(placed, [fk, f"old_{key}"], start=1, name=key)
    return numbered.select(*child.columns, f"old_{key}")


def shuffle_rows(df: DataFrame, key: str, seed: int | str, name: str = "id", start: int = 1) -> DataFrame:
    """A repeatable random permutation with new dense numbers, the old key as ``old_<key>``."""
    kept = df.withColumnRenamed(key, f"old_{key}")
    draw = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(f"old_{key}").cast("string")))
    return number_rows(kept, [draw], start=start, name=name, tie_break=[f"old_{key}"]).select(name, *kept.columns)
