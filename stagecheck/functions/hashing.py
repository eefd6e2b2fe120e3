"""Row hashes: upper-case SHA-256 over the rendered values of a list of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Fixed value: two places at most, trailing zeros dropped.
DECIMAL_FORMAT = "0.##"


def trimmed_decimal(value: Column) -> Column:
    return F.call_function("format_number", value, F.lit(DECIMAL_FORMAT))


def render(name: str, kind: str = "text") -> Column:
    """The text of one column as it enters a row hash."""
    if kind == "bool":
        return F.when(F.col(name), F.lit("1")).otherwise(F.lit("0"))
    if kind == "decimal":
        return trimmed_decimal(F.col(name))
    if kind == "text":
        return F.col(name).cast("string")
    raise ValueError(f"unknown kind {kind!r} for {name}")


def row_hash(
    columns: Sequence[str], kinds: Mapping[str, str] | None = None, nulls: str = "propagate", sep: str = "",
) -> Column:
    """Hash of ``columns`` in the given order.

    ``nulls="propagate"`` gives a NULL hash as soon as one value is NULL (staging and final
    side); ``nulls="empty"`` reads NULL as an empty text (source side). The default empty
    ``sep`` equals the hashes files already carry; a separator such as ``\\x1f`` keeps
    ``('1','23')`` and ``('12','3')`` apart.
    """
    if not columns:
        raise ValueError("a row hash needs at least one column")
    if nulls not in ("propagate", "empty"):
        raise ValueError(f"nulls must be 'propagate' or 'empty', not {nulls!r}")
    kinds = kinds or {}
    parts = [render(c, kinds.get(c, "text")) for c in columns]
    if nulls == "empty":
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    if sep:
        parts = [x for p in parts for x in (F.lit(sep), p)][1:]
    return F.upper(F.sha2(F.concat(*parts), 256))
