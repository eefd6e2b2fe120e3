"""Value cleaning. Every rule is one projection; rules chain without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from stagecheck.functions import text, times
from stagecheck.operators.numbering import number_rows
from stagecheck.spec import register_step


def blank_to_default(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Replace blank texts by a constant; NULL stays NULL."""
    return df.withColumns({
        c: F.when(F.col(c) == F.lit(""), F.lit(value)).otherwise(F.col(c)) for c, value in defaults.items()
    })


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})


def null_to_default(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace NULL by a constant, read as a value of the column's own type."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)) for c, value in defaults.items()
    })


def parse_and_shift(df: DataFrame, columns: Sequence[str], hours: int = 8) -> DataFrame:
    """Turn ISO-8601 texts into times and shift them; what cannot be read becomes NULL."""
    return df.withColumns({c: times.shifted(F.col(c), hours) for c in columns})


def derive(df: DataFrame, name: str, expression: str) -> DataFrame:
    """Add or replace a column by a SQL expression over the others."""
    return df.withColumn(name, F.expr(expression))


def with_now(df: DataFrame, name: str = "timestamp", python_format: str | None = None) -> DataFrame:
    now = F.current_timestamp()
    return df.withColumn(name, times.format_ts(now, python_format) if python_format else now)


def with_uuid(df: DataFrame, name: str = "uuid") -> DataFrame:
    return df.withColumn(name, F.expr("uuid()"))


def explode_list(
    df: DataFrame, key: str, list_column: str, key_name: str, item_name: str, id_name: str | None = None,
    separator: str = ",",
) -> DataFrame:
    """One row per element of a separated list, blank elements as NULL.

    A NULL list gives no row and a blank list one row with a NULL element. With ``id_name``
    rows get dense ids from 0 in order of key and position.
    """
    lists = df.select(F.col(key).alias(key_name), F.col(list_column).alias("_list"))

    def explode(rows: DataFrame) -> DataFrame:
        items = rows.select(key_name, F.explode(text.split_trim(F.col("_list"), separator)).alias(item_name))
        return items.withColumn(item_name, F.nullif(F.col(item_name), F.lit("")))

    if id_name is None:
        return explode(lists)
    return number_rows(lists, [key_name], name=id_name, expand=explode)


for _step in (blank_to_default, blank_to_null, null_to_default, parse_and_shift, derive, with_now, with_uuid):
    register_step(_step.__name__, _step)
