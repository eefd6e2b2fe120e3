"""Declared tables: columns, keys, mappings, hash columns and cleaning steps."""

from __future__ import annotations

from collections.abc import Callable, Mapping as MappingType, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T

from stagecheck import names

Step = Callable[[DataFrame], DataFrame]

_STEPS: dict[str, Callable[..., DataFrame]] = {}


def register_step(name: str, fn: Callable[..., DataFrame]) -> None:
    """Make a ``DataFrame -> DataFrame`` function available to specs by name."""
    _STEPS[name] = fn


def resolve_step(step: str | Step) -> Step:
    if callable(step):
        return step
    if step not in _STEPS:
        raise ValueError(f"step {step!r} is not registered; known: {sorted(_STEPS)}")
    return _STEPS[step]


def apply_steps(df: DataFrame, steps: Sequence[str | Step]) -> DataFrame:
    """Run steps in order; a frame with neither columns nor rows is returned as it is."""
    if not df.columns and df.isEmpty():
        return df
    for step in steps:
        df = df.transform(resolve_step(step))
    return df


@dataclass(frozen=True)
class Column:
    """One declared column. ``type`` is a Spark DDL type name."""

    name: str
    type: str
    required: bool = True
    length: int | None = None


@dataclass(frozen=True)
class ColumnMapping:
    source: str
    source_type: str
    target: str
    target_type: str


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str = "id"


@dataclass(frozen=True)
class TableSpec:
    """Everything the loads and reconciliations need to know about one table.

    ``columns`` are the columns of the final table under their own names; the staging
    table holds the same columns under the staging prefix. ``file_columns`` are the
    columns mapped from the source file, which differ only for tables derived from
    another table's file. Mappings and table names may be given as they are; else they follow
    from the columns and the staging prefix.
    """

    name: str
    columns: tuple[Column, ...]
    keys: tuple[str, ...] = ("id",)
    foreign_keys: tuple[ForeignKey, ...] = ()
    hash_columns: tuple[str, ...] = ()
    steps: tuple[str | Step, ...] = ()
    file_columns: tuple[str, ...] | None = None
    carries_file_hash: bool = True
    excluded: bool = False
    own_numbers: str | None = None  # staging column that a step numbers from 0 in every file
    prefix: str = names.STAGED_PREFIX
    staged_table: str | None = None
    final_table: str | None = None
    to_staging: tuple[ColumnMapping, ...] | None = None
    to_final: tuple[ColumnMapping, ...] | None = None

    @property
    def staged_name(self) -> str:
        return self.staged_table or f"PRE_{self.name}"

    @property
    def final_name(self) -> str:
        return self.final_table or self.name

    def staged_column(self, name: str) -> str:
        """What a final column is called in the staging table."""
        return {m.target: m.source for m in self.final_mappings}[name]

    @property
    def staged_keys(self) -> tuple[str, ...]:
        return tuple(self.staged_column(k) for k in self.keys)

    @property
    def staged_hash_columns(self) -> tuple[str, ...]:
        return tuple(self.staged_column(c) for c in self.hash_columns)

    @property
    def source_keys(self) -> tuple[str, ...]:
        """The key columns as the source file names them."""
        sources = {m.target: m.source for m in self.staging_mappings}
        return tuple(sources[k] for k in self.staged_keys)

    @property
    def staging_mappings(self) -> tuple[ColumnMapping, ...]:
        if self.to_staging is not None:
            return self.to_staging
        mapped = self.file_columns or tuple(c.name for c in self.columns)
        return tuple(ColumnMapping(c, "string", self.prefix + c, "string") for c in mapped)

    @property
    def final_mappings(self) -> tuple[ColumnMapping, ...]:
        if self.to_final is not None:
            return self.to_final
        return tuple(ColumnMapping(self.prefix + c.name, c.type, c.name, c.type) for c in self.columns)

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name} has no column {name!r}")

    @property
    def staged_kinds(self) -> dict[str, str]:
        """:meth:`kinds` by the names of the staging table."""
        return {self.staged_column(c): kind for c, kind in self.kinds().items()}

    def kinds(self, prefix: str = "") -> dict[str, str]:
        """How hash columns are rendered: booleans as 1/0, decimals without trailing zeros."""
        kinds = {}
        for name in self.hash_columns:
            declared = self.column(name).type
            if declared == "boolean":
                kinds[prefix + name] = "bool"
            elif declared.startswith("decimal"):
                kinds[prefix + name] = "decimal"
        return kinds

    @property
    def staged_columns(self) -> tuple[Column, ...]:
        """Declared staging columns, without the origin file."""
        prefixed = tuple(Column(self.staged_column(c.name), c.type, c.required, c.length) for c in self.columns)
        if not self.carries_file_hash:
            return prefixed
        return prefixed + (Column(names.PRE_FILE_HASH, "string", False, 64),)

    @property
    def staged_schema(self) -> T.StructType:
        return _schema(self.staged_columns + (Column(names.PRE_ORIGIN_FILE, "string", True, 128),))

    @property
    def final_schema(self) -> T.StructType:
        return _schema(self.columns + (Column(names.ORIGIN_FILE, "string", True, 128),))


def _schema(columns: Sequence[Column]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{c.name}` {c.type}" for c in columns))


def specs_from_config(
    config: MappingType, decimal_type: str = "decimal(10,2)", steps: MappingType[str, Sequence] | None = None,
    hash_columns: MappingType[str, Sequence[str]] | None = None,
) -> dict[str, TableSpec]:
    """Build specs from a migration configuration already read from JSON.

    The configuration names, per table, ``mappings_prelim`` and ``mappings_final`` as
    4-tuples, ``primary_keys`` and ``pre_exclude_from_hash``, and may name the tables
    (``prelim_name``, ``final_name``). Mappings hold as written. A bare ``decimal`` gets
    ``decimal_type``, since Spark's own default would drop the cents.
    """
    prefix = config.get("prelim_column_prefix", names.STAGED_PREFIX)
    full = lambda kind: decimal_type if kind == "decimal" else kind
    mappings = lambda rows: tuple(ColumnMapping(a, full(x), b, full(y)) for a, x, b, y in rows)
    specs = {}
    for name, entry in config["tables"].items():
        columns = tuple(
            Column(target, decimal_type if kind == "decimal" else kind, required=target in entry["primary_keys"])
            for _, _, target, kind in entry["mappings_final"]
        )
        from_file = tuple(source for source, *_ in entry["mappings_prelim"])
        derived = {m[2] for m in entry["mappings_prelim"]} != {m[0] for m in entry["mappings_final"]}
        excluded = bool(entry["pre_exclude_from_hash"])
        hashed = tuple((hash_columns or {}).get(name, () if excluded else [c.name for c in columns]))
        specs[name] = TableSpec(
            name=name,
            columns=columns,
            keys=tuple(entry["primary_keys"]),
            hash_columns=hashed,
            steps=tuple((steps or {}).get(name, ())),
            file_columns=from_file if derived else None,
            carries_file_hash=not excluded,
            excluded=excluded,
            prefix=prefix,
            staged_table=entry.get("prelim_name"),
            final_table=entry.get("final_name"),
            to_staging=mappings(entry["mappings_prelim"]),
            to_final=mappings(entry["mappings_final"]),
        )
    return specs
