"""Shared storage: written tables that cut lineage, and file-system calls through Hadoop."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Paths of the tables pinned inside the innermost scope.
_pinned: ContextVar[list[str] | None] = ContextVar("pinned", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the session's warehouse: both are shared by all executors.

    On a cluster a warehouse in a local folder is not, so the setting is asked for there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and file_system(spark, folder)[0].getScheme() == "file":
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {folder} is a local one")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/stagecheck/{app}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Values that depend on how rows were partitioned (slots, positions) then stay what they
    were, whatever is recomputed or lost later, and every reader prunes to its own columns.
    """
    return pin_parts([df], name)


def pin_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """Write frames of one schema, one after the other, and read them back as one.

    What a part has shuffled is deleted before the next one starts, so the disk holds the exchanges
    of one part at a time beside what is written.
    """
    paths = []
    for df in parts:
        paths.append(scratch_path(df.sparkSession, name))
        with _shuffles_deleted(df.sparkSession):
            df.write.option("compression", "zstd").parquet(paths[-1])
        own(paths[-1])
    return df.sparkSession.read.schema(df.schema).parquet(*paths)


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of jobs started inside the block as they end, not when the driver happens to collect garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def own(path: str) -> None:
    """Let the innermost scope, if there is one, delete ``path`` at its end."""
    if (scope := _pinned.get()) is not None:
        scope.append(path)


@contextmanager
def pin_scope(spark: SparkSession) -> Iterator[None]:
    """Own the tables pinned inside the block, and delete them at its end.

    For jobs that have written their result by then; frames that read such a table must not leave the block.
    """
    token = _pinned.set([])
    try:
        yield
    finally:
        for path in _pinned.get():
            delete_path(spark, path)
        _pinned.reset(token)


def input_slots(df: DataFrame, slot_bytes: int = 128 << 20, least: int | None = None) -> int:
    """Partitions for ``df`` by the size of the files it reads, three times what they take on disk; at least ``least``, or the session's."""
    known = [s for s in input_sizes(df) if s is not None]
    return max(least or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(3 * sum(known) / slot_bytes))


def input_sizes(df: DataFrame) -> list[float | None]:
    """Bytes of every input of ``df``, each once however often the plan reads it; None where the size is not known."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes: dict[str, float | None] = {}
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        size = float(str(leaf.stats().sizeInBytes()))
        relation = leaf.relation() if leaf.nodeName() == "LogicalRelation" else None
        of_files = relation is not None and relation.getClass().getSimpleName() == "HadoopFsRelation"
        # A scan of the same files with other columns is the same input.
        files = relation.location().rootPaths().mkString(",") if of_files else ""
        sizes[files or f"{i}"] = size if size < 1 << 60 else None  # frames made in memory have no size
    return list(sizes.values())


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it wants it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def drop_pins(spark: SparkSession) -> bool:
    """Delete all pinned tables of this application that no scope owns, once nothing reads them any more."""
    return delete_path(spark, f"{shared_folder(spark)}/stagecheck/{spark.sparkContext.applicationId}")
