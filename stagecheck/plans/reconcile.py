"""Whole reconciliations of one file.

The hash archive, which has to be written anyway, holds keys and hashes of all rows. Once it
stands, the summary reads it instead of hashing and joining the tables again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from stagecheck import names
from stagecheck.operators.matching import excluded_summary, final_hashes, recon_summary, with_staged_hash
from stagecheck.operators.reports import Detail, detail1, detail2
from stagecheck.sinks.files import report_path, write_detail, write_summary
from stagecheck.sinks.tables import archive_path, write_hash_archive
from stagecheck.sources.files import read_flat_file
from stagecheck.sources.quoted import read_quoted_file
from stagecheck.sources.tables import read_final, read_staged
from stagecheck.spec import TableSpec
from stagecheck.storage import pin_scope


@dataclass(frozen=True)
class ReconPaths:
    """Where a reconciliation left its results; detail and archive are missing for excluded tables."""

    summary: str
    detail: str | None = None
    archive: str | None = None


def _file_datetime(file_name: str) -> str:
    return (file_name.rpartition(".")[0] or file_name).partition("~")[2]


def _write_reports(
    summary: DataFrame, detail: Detail, spec: TableSpec, file_name: str, stage: int, report_root: str,
    hash_root: str, passed: int | None, failed: int | None,
) -> ReconPaths:
    paths = ReconPaths(
        report_path(report_root, spec.name, file_name, stage, "RECON1"),
        report_path(report_root, spec.name, file_name, stage, "RECON2"),
        archive_path(hash_root, spec.name, stage, _file_datetime(file_name)),
    )
    write_summary(summary, paths.summary)
    write_detail(detail, paths.detail, passed, failed)
    return paths


def _owned(job):
    """Run a reconciliation as the owner of the tables it pins."""
    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs) -> ReconPaths:
        with pin_scope(spark):
            return job(spark, *args, **kwargs)
    return run


@_owned
def reconcile_stage1(
    spark: SparkSession, path: str, file_name: str, spec: TableSpec, staging_root: str, report_root: str,
    hash_root: str, multi_line: bool = False, passed: int | None = None, failed: int | None = None,
) -> ReconPaths:
    """File against staging. The summary counts staged rows; the detail also shows unstaged file rows.

    The detail is complete; ``passed`` and ``failed`` cut it to the first records of an outcome.
    """
    if spec.excluded:
        summary_path = report_path(report_root, spec.name, file_name, 1, "RECON1")
        write_summary(excluded_summary(spark.range(0)), summary_path)
        return ReconPaths(summary_path)
    file_rows = read_quoted_file(spark, path) if multi_line else read_flat_file(spark, path)
    staged = read_staged(spark, staging_root, spec, file_name)
    archive = write_hash_archive(
        with_staged_hash(staged, spec), hash_root, spec.name, 1, _file_datetime(file_name), spec.staged_keys,
        (names.PRE_FILE_HASH, names.STAGED_HASH),
    )
    return _write_reports(
        recon_summary(archive, names.PRE_FILE_HASH, names.STAGED_HASH),
        detail1(file_rows, staged, spec), spec, file_name, 1, report_root, hash_root, passed, failed,
    )


@_owned
def reconcile_stage2(
    spark: SparkSession, file_name: str, spec: TableSpec, staging_root: str, final_root: str, report_root: str,
    hash_root: str, passed: int | None = None, failed: int | None = None,
) -> ReconPaths:
    """Staging against final, over rows present on both sides; limits as in stage 1."""
    staged = read_staged(spark, staging_root, spec, file_name)
    final = read_final(spark, final_root, spec, file_name)
    archive = write_hash_archive(
        final_hashes(staged, final, spec), hash_root, spec.name, 2, _file_datetime(file_name), spec.keys,
        (names.STAGED_HASH, names.FINAL_HASH),
    )
    return _write_reports(
        recon_summary(archive, names.STAGED_HASH, names.FINAL_HASH),
        detail2(staged, final, spec), spec, file_name, 2, report_root, hash_root, passed, failed,
    )
