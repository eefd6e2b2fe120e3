"""Writes of staging and final tables, reloads by file, and hash archives.

Every write takes effect at once, by publishing a snapshot, or not at all; see ``snapshots``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from stagecheck import names, snapshots
from stagecheck.operators.audit import pk_duplicates, reference_orphans
from stagecheck.operators.mapping import coerce_declared
from stagecheck.operators.tracker import upsert_latest
from stagecheck.snapshots import Aside, Folder, Snapshot
from stagecheck.sources.tables import table_path
from stagecheck.spec import Column, TableSpec
from stagecheck.storage import path_exists, pin, pin_scope


#: Column that tells the buckets of an upserted table apart.
BUCKET = "bucket"


def delete_file(spark: SparkSession, path: str, origin_file: str) -> bool:
    """Drop the rows of one file from a stored table; True if it had any."""
    had = any(f.file == origin_file for f in snapshots.latest(spark, path).folders)
    snapshots.commit(spark, path, lambda base: base.without_files([origin_file]))
    return had


def _refuse_repeats(new: DataFrame, keys: Sequence[str], table: str) -> None:
    example = pk_duplicates(new, keys).first()
    if example is not None:
        raise ValueError(f"{table}: key {example.asDict()} is not unique")


def stored_collisions(
    new: DataFrame, stored: DataFrame, keys: Sequence[str], ends: tuple[Any, Any] | None = None,
) -> DataFrame:
    """Keys of ``new`` that are stored already.

    The stored side is only narrowed, by the range of the new keys at its scan (``ends``, of the first
    key, where they are known) and then by the keys themselves, which are sent to it while they are
    small; its own rows need not move.
    """
    wanted = new.select(*[F.col(k).alias(f"_{k}") for k in keys])
    low, high = ends or wanted.agg(F.min(f"_{keys[0]}"), F.max(f"_{keys[0]}")).first()
    near = stored.select(*keys).filter(F.col(keys[0]).between(F.lit(low), F.lit(high)))
    return near.join(wanted, [near[k] == wanted[f"_{k}"] for k in keys], "left_semi")


class _Load:
    """One load: its rows are written aside once, and counted, bounded and searched for gaps in that pass."""

    def __init__(self, df: DataFrame, path: str, table: str, partition: str, keys: Sequence[str], required: Iterable[Column] = ()):
        self.path, self.table, self.partition, self.keys = path, table, partition, list(keys)
        self.schema = df.schema
        self.required = [c.name for c in required]
        self.seen = Observation()
        gaps = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"gap_{c}") for c in self.required]
        self.df = df.observe(
            self.seen, F.count(F.lit(1)).alias("rows"), F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high"), *gaps)

    def described(self, new: Aside) -> None:
        """Keep what the write has seen with the folders: their rows, if it made one, and the ends of the first key."""
        seen = self.seen.get
        zoned = isinstance(self.schema[self.keys[0]].dataType, (T.IntegralType, T.StringType))
        new.describe([
            replace(f, rows=seen["rows"] if len(new.folders) == 1 else None, low=seen["low"] if zoned else None,
                    high=seen["high"] if zoned else None) for f in new.folders])

    def refuse_gaps(self) -> None:
        broken = {c: self.seen.get[f"gap_{c}"] for c in self.required if self.seen.get[f"gap_{c}"]}
        if broken:
            raise ValueError(f"{self.table}: required values are missing: {broken}")

    def adding(self, new: Aside, replaced: Iterable[str | None], check_keys: bool, own_files: bool) -> Callable[[Snapshot], Snapshot]:
        """The change that publishes ``new`` in place of the files ``replaced``.

        With ``check_keys`` it refuses keys that are stored already, in the files of ``new`` only if
        ``own_files``. Asked again after another load was first, it looks at what that one added.
        """
        seen: set[str] = set()

        def change(base: Snapshot) -> Snapshot:
            kept = base.without_files(replaced)
            if check_keys:
                files = {f.file for f in new.folders}
                ends = {(f.low, f.high): f for f in new.folders if f.rows != 0}.values()  # folders of a load share them
                near = [f for f in kept.folders
                        if f.path not in seen and (f.file in files or not own_files) and any(_may_meet(f, n) for n in ends)]
                if near:
                    stored = snapshots.read_folders(new.spark, self.path, near, self.schema)
                    keys = [*self.keys, self.partition] if own_files else self.keys
                    known = self.seen.get["low"], self.seen.get["high"]
                    example = stored_collisions(new.rows(self.schema), stored, keys, known).first()
                    if example is not None:
                        raise ValueError(f"{self.table}: key {example.asDict()} is not unique")
                seen.update(f.path for f in kept.folders)
            return kept.with_folders(new.folders)

        return change


def _may_meet(one: Folder, two: Folder) -> bool:
    """Whether two folders can hold one key, by the ends of their first keys; folders of unknown ends can."""
    if any(end is None for end in (one.low, one.high, two.low, two.high)):
        return one.rows != 0 and two.rows != 0
    return one.low <= two.high and two.low <= one.high


def write_staged(
    df: DataFrame, root: str, spec: TableSpec, mode: str = "append", on_bad: str = "null", check_keys: bool = True,
    origin_file: str | None = None,
) -> None:
    """Append cleaned rows, cast to their declared types; ``mode="overwrite"`` replaces their files.

    The key of a staging table is the source key and the origin file. As a database would, a
    load that breaks it is refused, unless ``check_keys`` is off. ``origin_file`` names the file that
    an overwrite replaces, so that its old rows go even if it has no rows now. The rows are
    computed and written once; checks read what was written, and only then it is published.
    """
    path, partition = table_path(root, spec.staged_name), names.PRE_ORIGIN_FILE
    typed = coerce_declared(df, spec.staged_columns, on_bad).select(*spec.staged_schema.names)
    load = _Load(typed, path, spec.staged_name, partition, spec.staged_keys)
    with snapshots.aside(load.df, path, partition) as new:
        load.described(new)
        if check_keys:
            _refuse_repeats(new.rows(typed.schema), [*spec.staged_keys, partition], spec.staged_name)
        new.commit(load.adding(new, _replaced(new, mode, origin_file), check_keys, own_files=True))


def write_final(
    df: DataFrame, root: str, spec: TableSpec, mode: str = "append", on_bad: str = "null", check_keys: bool = True,
    origin_file: str | None = None, check_rows: bool = True, check_references: bool = True,
) -> None:
    """Append mapped rows; ``mode="overwrite"`` replaces their files, and ``origin_file`` in any case.

    The key of a final table is the source key alone, over all files. As a database would, a
    load is refused that breaks it, lacks a required value (``check_rows``), or refers to a parent
    that is not stored below ``root`` (``check_references``). Of two loads of one key at the same time
    one is refused.
    """
    path, partition = table_path(root, spec.final_name), names.ORIGIN_FILE
    typed = coerce_declared(df, spec.columns, on_bad).select(*spec.final_schema.names)
    load = _Load(typed, path, spec.final_name, partition, spec.keys, [c for c in spec.columns if c.required and check_rows])
    with snapshots.aside(load.df, path, partition) as new:
        load.described(new)
        load.refuse_gaps()
        rows = new.rows(typed.schema)
        if check_keys:
            _refuse_repeats(rows, spec.keys, spec.final_name)
        if check_references and spec.foreign_keys:
            _refuse_orphans(rows, root, spec)
        new.commit(load.adding(new, _replaced(new, mode, origin_file), check_keys, own_files=False))


def _replaced(new: Aside, mode: str, origin_file: str | None) -> set[str | None]:
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    if mode == "append":
        return set()
    return {f.file for f in new.folders} | (set() if origin_file is None else {origin_file})


def _refuse_orphans(rows: DataFrame, root: str, spec: TableSpec) -> None:
    spark, parents = rows.sparkSession, {}
    for reference in spec.foreign_keys:
        path = table_path(root, reference.parent)
        now = snapshots.latest(spark, path)
        stored = bool(now.folders) or not now.version and path_exists(spark, path)
        parents[reference.parent] = snapshots.read(spark, path, snapshot=now) if stored else None
    example = reference_orphans(rows, [(r.column, r.parent, parents[r.parent], r.parent_column) for r in spec.foreign_keys]).first()
    if example is not None:
        raise ValueError(f"{spec.final_name}: {example.column} {example.value} has no row in {example.parent}")


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_size: int = 10_000) -> None:
    """Append to a database table, one connection per partition."""
    df.write.mode("append").option("batchsize", batch_size).jdbc(url, table, properties=dict(properties))


def reload_file(df: DataFrame, path: str, partition: str, files: Sequence[str] = ()) -> None:
    """Replace the rows of the files in ``df`` and of those named in ``files``, which may have none left.

    ``df`` may read the table itself. Until the new rows are published the old ones stay.
    """
    with snapshots.aside(df, path, partition) as new:
        gone = {f.file for f in new.folders}.union(files)
        new.commit(lambda base: base.without_files(gone).with_folders(new.folders))


class _Overtaken(Exception):
    """Another upsert has rewritten a bucket that this one read."""


def upsert_stored(
    changes: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], keep_when_null: Sequence[str] = (),
    buckets: int = 64,
) -> int:
    """Upsert into a stored table as ``upsert_latest`` does, rewriting only the buckets that changes fall into.

    Rows lie in ``buckets`` folders by the hash of their key; what is written grows with the changes, not
    with the table. ``buckets`` must stay what it was at the first call. Of two upserts of one bucket at the same
    time the later one starts over from what the other left. Returns the number of buckets rewritten.
    """
    spark = changes.sparkSession
    if BUCKET in changes.columns:
        raise ValueError(f"{BUCKET} is the name of the bucket's own column")
    with pin_scope(spark):
        placed = pin(changes.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), "changes")
        touched = {str(r[0]) for r in placed.select(BUCKET).distinct().collect()}  # at most ``buckets``
        for _ in range(snapshots.ATTEMPTS):
            stored = [f for f in snapshots.latest(spark, path).folders if f.file in touched]
            merged = upsert_latest(
                snapshots.read_folders(spark, path, stored, placed.schema), placed, [BUCKET, *keys], order, keep_when_null)

            def change(base: Snapshot, stored=stored) -> Snapshot:
                if [f for f in base.folders if f.file in touched] != stored:
                    raise _Overtaken
                return base.without_files(touched).with_folders(new.folders)

            try:
                with snapshots.aside(merged.repartition(BUCKET), path, BUCKET) as new:
                    new.commit(change)
                return len(touched)
            except _Overtaken:
                continue
    raise snapshots.Conflict(f"{path}: other upserts were first {snapshots.ATTEMPTS} times")


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table that ``upsert_stored`` keeps."""
    return snapshots.read(spark, path).drop(BUCKET)


def delete_by_file(df: DataFrame, origin_file: str, column: str = names.PRE_ORIGIN_FILE) -> DataFrame:
    """The table without the rows of one file; rows of unknown origin stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(origin_file)))


def archive_path(root: str, table: str, stage: int, file_datetime: str) -> str:
    return f"{root.rstrip('/')}/{table}/STAGE{stage}/{file_datetime}"


def write_hash_archive(
    df: DataFrame, root: str, table: str, stage: int, file_datetime: str, keys: Sequence[str], hashes: Sequence[str],
) -> DataFrame:
    """Write keys and both hashes, replacing an earlier archive of the same file, and read them back."""
    spark, path = df.sparkSession, archive_path(root, table, stage, file_datetime)
    narrow = df.select(*keys, *hashes)
    narrow.write.mode("overwrite").parquet(path)
    return spark.read.schema(narrow.schema).parquet(path)
