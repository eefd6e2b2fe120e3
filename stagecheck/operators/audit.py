"""Checks a relational target would enforce on insert: keys, nulls, lengths, ranges, references."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from stagecheck.spec import Column


def pk_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. Counts combine before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def key_conflicts(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``new`` that occur twice in it or are stored already. Counts combine before the shuffle."""
    both = new.select(*keys, F.lit(True).alias("_new")).unionAll(stored.select(*keys, F.lit(False).alias("_new")))
    counted = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.bool_or("_new").alias("_new"))
    return counted.filter((F.col("rows") > 1) & F.col("_new")).drop("_new")


def constraint_audit(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """Violations per rule and declared column, counted in one pass.

    Rules: ``not_null`` (required), ``length`` (texts), ``castable`` (a present text that does
    not read as the declared type), ``range`` (a number too large for the declared decimal).
    """
    rules = []
    for c in columns:
        value = F.col(f"`{c.name}`")
        if c.required:
            rules.append(("not_null", c.name, value.isNull()))
        if c.length is not None:
            rules.append(("length", c.name, F.length(value.cast("string")) > c.length))
        if c.type == "string":
            continue
        stored_as_text = isinstance(df.schema[c.name].dataType, T.StringType)
        is_decimal = c.type.startswith("decimal")
        # A decimal of full width tells "no number at all" from "number out of range".
        readable = value.try_cast("decimal(38,10)" if is_decimal else c.type)
        if stored_as_text:
            rules.append(("castable", c.name, value.isNotNull() & readable.isNull()))
        if is_decimal:
            rules.append(("range", c.name, readable.isNotNull() & value.try_cast(c.type).isNull()))
    if not rules:
        raise ValueError("no rule to check")
    counts = df.agg(*[F.count_if(broken).alias(f"_{i}") for i, (_, _, broken) in enumerate(rules)])
    rows = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.col(f"_{i}").alias("violations"))
        for i, (rule, column, _) in enumerate(rules)
    ])
    return counts.select(F.inline(rows))


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key refers to nothing and passes."""
    parents = parent.select(F.col(pk).alias("_parent"))
    return child.filter(F.col(fk).isNotNull()).join(parents, child[fk] == parents["_parent"], "left_anti")


def reference_orphans(child: DataFrame, references: Sequence[tuple[str, str, DataFrame | None, str]]) -> DataFrame:
    """Values of all references that have no parent: (column, parent, value as text), each once.

    ``references`` are (child column, parent's name, parent or None if there is none, parent's key). The
    child is read once, whatever their number: its distinct values, which combine before the shuffle,
    meet the keys of all parents in one anti join. NULL refers to nothing and passes.
    """
    parents = {name: (rows, key) for _, name, rows, key in references}
    if any((name, key) not in {(n, k) for n, (_, k) in parents.items()} for _, name, _, key in references):
        raise ValueError("one parent is referred to by different keys")

    def as_key(column: str, name: str) -> F.Column:
        rows, key = parents[name]
        value = F.col(f"`{column}`")
        return (value if rows is None else value.cast(rows.schema[key].dataType)).cast("string")

    values = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(n).alias("parent"), as_key(c, n).alias("value")) for c, n, _, _ in references])
    wanted = child.select(F.inline(values)).filter(F.col("value").isNotNull()).distinct()
    stored = [rows.select(F.lit(name).alias("parent"), F.col(f"`{key}`").cast("string").alias("value"))
              for name, (rows, key) in parents.items() if rows is not None]
    if not stored:
        return wanted
    return wanted.join(reduce(DataFrame.unionAll, stored), ["parent", "value"], "left_anti").select("column", "parent", "value")


def fk_repair(child: DataFrame, parent: DataFrame, fk: str, pk: str, default: int | str = 0) -> DataFrame:
    """Point orphans to a default key. Parents are distinct, so child rows never multiply."""
    parents = parent.select(F.col(pk).alias("_parent")).distinct()
    joined = child.join(parents, child[fk] == parents["_parent"], "left")
    orphan = F.col(fk).isNotNull() & F.col("_parent").isNull()
    repaired = F.when(orphan, F.lit(default).cast(child.schema[fk].dataType)).otherwise(F.col(fk))
    return joined.withColumn(fk, repaired).select(*child.columns)


def distinct_keys(df: DataFrame, column: str, ignore: Sequence = ("", "0")) -> DataFrame:
    """Distinct usable ids in order; NULL and the values of ``ignore`` (compared as text) do not count."""
    usable = F.col(column).isNotNull() & ~F.col(column).cast("string").isin(*ignore)
    return df.select(column).filter(usable).distinct().orderBy(column)
