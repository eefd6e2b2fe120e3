"""Reports, extracts and compressed archives as delimited files."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stagecheck import names
from stagecheck.functions.hashing import row_hash
from stagecheck.operators.reports import REPORT_ORDER, Detail
from stagecheck.sources.files import FILE_ORDER, file_manifest
from stagecheck.sources.quoted import PLACE, read_quoted_file
from stagecheck.storage import delete_path, input_slots

# Blank cells are written as nothing at all, quotes inside a cell are doubled, and outer
# spaces, which Spark would cut off by default, are kept.
WRITE_OPTIONS = {
    "header": True, "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Codecs Spark's delimited writer accepts.
CODECS = ("gzip", "bzip2", "snappy", "lz4", "deflate")


# Text that one task writes to a file of ``write_large_files``: readers cut it into some blocks.
LARGE_FILE_BYTES = 256 << 20


def report_path(root: str, table: str, file_name: str, stage: int, report: str) -> str:
    stem = file_name.rpartition(".")[0] or file_name
    return f"{root.rstrip('/')}/{table}/{stem}_STAGE{stage}_{report}.csv"


def write_summary(summary: DataFrame, path: str) -> None:
    """One file; a summary has at most two rows."""
    summary.coalesce(1).write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def write_detail(detail: Detail, path: str, passed: int | None = None, failed: int | None = None) -> None:
    """Part files that, read by name, are in report order; with header even when empty.

    A complete report is sorted once, on its way to the files; one that is cut is sorted after that.
    """
    if passed is None and failed is None:
        ordered = detail.in_order()
    else:
        ordered = detail.lines(passed, failed).orderBy(*REPORT_ORDER).drop(*REPORT_ORDER)
    ordered.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def write_large_files(df: DataFrame, path: str, file_bytes: int | None = None) -> None:
    """Write large delimited files, one for every ``file_bytes`` or so of what ``df`` reads and one at least.

    A task takes up some blocks of the input as they lie, so nothing is shuffled.
    """
    files = input_slots(df, file_bytes or LARGE_FILE_BYTES, least=1)
    df.coalesce(files).write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def extract_table(
    df: DataFrame, hash_columns: Sequence[str], out_dir: str, table: str, file_datetime: str,
    kinds: dict[str, str] | None = None,
) -> str | None:
    """Write a source table as ``TABLE~time.csv`` with its row hash; NULL enters the hash as blank.

    A table without hash columns has nothing to extract and is skipped. The result is a folder
    of part files, each with header, written by all tasks at once.
    """
    if not hash_columns:
        return None
    path = f"{out_dir.rstrip('/')}/{table}~{file_datetime}.csv"
    hashed = df.withColumn(names.FILE_HASH, row_hash(hash_columns, kinds, nulls="empty"))
    hashed.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)
    return path


def extract_counts(df: DataFrame, group: str = names.PRE_ORIGIN_FILE) -> DataFrame:
    """Rows per extracted file."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"))


def _contents(rows: DataFrame) -> tuple:
    """Number of rows and a sum over their hashes, equal for equal bags of rows."""
    value = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    return tuple(rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(value.cast("decimal(38,0)")), F.lit(0))).first())


def archive_dataset(
    spark: SparkSession, source: str, target: str, codec: str = "gzip", enabled: bool = True,
    drop_source: bool = False,
) -> bool:
    """Compress a delimited dataset into ``target`` and, on request, drop the original after that.

    Records may hold line breaks. The original goes only once the copy, read back, has as many
    rows with the same hashes; else ValueError is raised.
    """
    if not enabled:
        return False
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}, not {codec!r}")
    rows = read_quoted_file(spark, source)
    rows.write.mode("overwrite").options(**WRITE_OPTIONS).option("compression", codec).csv(target)
    if drop_source:
        if _contents(rows) != _contents(read_quoted_file(spark, target, rows.columns)):
            raise ValueError(f"{target} does not hold what {source} holds; nothing is dropped")
        delete_path(spark, source)
    return True


def compact_dataset(
    spark: SparkSession, source: str, target: str, target_bytes: int = 128 << 20, target_files: int | None = None,
) -> int:
    """Rewrite many small delimited files as a few of about ``target_bytes`` each; returns their number.

    ``target_files`` asks for so many at least: a file is written by one task, so large datasets get
    more, of ``target_bytes`` each. Part files, read by name, hold the records in listing order: by
    file, then as in the file.
    """
    size = file_manifest(spark, source).agg(F.sum("length").alias("size")).first()["size"] or 0
    files = max(1, target_files or 1, math.ceil(size / target_bytes))
    rows = read_quoted_file(spark, source, places=True)
    ordered = rows.repartitionByRange(files, *PLACE).sortWithinPartitions(*PLACE)
    ordered.drop(*PLACE).write.mode("overwrite").options(**WRITE_OPTIONS).csv(target)
    return files


def write_merged(merged: DataFrame, path: str) -> None:
    """Write a frame of :func:`merge_csv_files` so that part files, read by name, keep its order."""
    ordered = merged.orderBy(*FILE_ORDER).drop(*FILE_ORDER)
    ordered.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)
