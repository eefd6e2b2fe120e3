"""Column mapping between the file, staging and final layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from stagecheck import names
from stagecheck.spec import Column, ColumnMapping


def _convert(source: F.Column, kind: str, on_bad: str) -> F.Column:
    if on_bad == "null":
        return source.try_cast(kind)
    if on_bad == "fail":
        return source.cast(kind)
    raise ValueError(f"on_bad must be 'null' or 'fail', not {on_bad!r}")


def apply_mapping(df: DataFrame, mappings: Sequence[ColumnMapping], on_bad: str = "null") -> DataFrame:
    """Rename and cast the mapped columns; columns without a mapping are dropped.

    A value that does not fit its target type becomes NULL, or fails the job with ``on_bad="fail"``
    (ANSI mode, Spark's default).
    """
    if not mappings:
        return df
    return df.select(*[_convert(F.col(f"`{m.source}`"), m.target_type, on_bad).alias(m.target) for m in mappings])


def add_prefix(df: DataFrame, prefix: str = names.STAGED_PREFIX) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def coerce_declared(df: DataFrame, columns: Sequence[Column], on_bad: str = "null") -> DataFrame:
    """Cast to the declared types, keeping other columns as they are.

    With ``on_bad="fail"`` a text longer than declared or a missing required value also fails.
    """
    declared = {c.name: c for c in columns}
    out = []
    for name in df.columns:
        column = declared.get(name)
        if column is None:
            out.append(F.col(f"`{name}`"))
            continue
        value = _convert(F.col(f"`{name}`"), column.type, on_bad)
        if on_bad == "fail":
            if column.length is not None:
                value = F.when(
                    F.length(value) > column.length, F.raise_error(F.lit(f"{name}: longer than {column.length}")),
                ).otherwise(value)
            if column.required:
                value = F.coalesce(value, F.raise_error(F.lit(f"{name}: required value is missing")))
        out.append(value.alias(name))
    return df.select(*out)


def with_origin_file(df: DataFrame, file_name: str, column: str = names.PRE_ORIGIN_FILE) -> DataFrame:
    return df.withColumn(column, F.lit(file_name))


def cast_voids(df: DataFrame) -> DataFrame:
    """Give every untyped (all-NULL) column the string type, so that it can be stored."""
    voids = [name for name, kind in df.dtypes if kind == "void"]
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in voids}) if voids else df


def stringify(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def conform_columns(df: DataFrame, order: Sequence[str], defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """Exactly the columns of ``order``, absent ones filled with a constant from ``defaults``."""
    defaults = defaults or {}
    missing = [c for c in order if c not in df.columns and c not in defaults]
    if missing:
        raise ValueError(f"no column and no default for {missing}")
    return df.select(*[
        F.col(f"`{c}`") if c in df.columns else F.lit(defaults[c]).alias(c) for c in order
    ])
