"""Stage loads: file to staging table, staging table to final table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stagecheck import names
from stagecheck.operators.mapping import apply_mapping, cast_voids, with_origin_file
from stagecheck.sinks.tables import write_final, write_staged
from stagecheck.snapshots import reserve_numbers
from stagecheck.sources.files import read_flat_file
from stagecheck.sources.quoted import read_quoted_file
from stagecheck.sources.tables import read_staged, table_path
from stagecheck.spec import ColumnMapping, TableSpec, apply_steps
from stagecheck.storage import pin_scope

_HASH_MAPPING = ColumnMapping(names.FILE_HASH, "string", names.PRE_FILE_HASH, "string")


def run_staging(file_rows: DataFrame, spec: TableSpec, file_name: str) -> DataFrame:
    """Map, clean and label the rows of one file for the staging table of ``spec``."""
    mappings = spec.staging_mappings + ((_HASH_MAPPING,) if spec.carries_file_hash else ())
    mapped = apply_mapping(file_rows, mappings)
    return cast_voids(with_origin_file(apply_steps(mapped, spec.steps), file_name))


def run_final(staged: DataFrame, spec: TableSpec, file_name: str) -> DataFrame:
    """Map staged rows to the final layer: prefix dropped, declared types, labelled by file."""
    return with_origin_file(apply_mapping(staged, spec.final_mappings), file_name, names.ORIGIN_FILE)


def load_stage1(
    spark: SparkSession, path: str, file_name: str, spec: TableSpec, staging_root: str, multi_line: bool = False,
    mode: str = "append", on_bad: str = "null", check_keys: bool = True,
) -> None:
    """Load one file into staging. ``mode="overwrite"`` replaces what was staged of this file only."""
    rows = read_quoted_file(spark, path) if multi_line else read_flat_file(spark, path)
    with pin_scope(spark):
        staged = run_staging(rows, spec, file_name)
        if spec.own_numbers:
            staged = _numbered_over_files(staged, spec, staging_root, file_name)
        write_staged(staged, staging_root, spec, mode, on_bad, check_keys, file_name)


def _numbered_over_files(staged: DataFrame, spec: TableSpec, staging_root: str, file_name: str) -> DataFrame:
    """Move the numbers a file's rows got by themselves behind those of the files before.

    The table keeps which numbers a file has, so a file that is loaded again gets them again.
    """
    path = table_path(staging_root, spec.staged_name)
    first = reserve_numbers(staged.sparkSession, path, file_name, staged.count())
    return staged.withColumn(spec.own_numbers, F.col(spec.own_numbers) + F.lit(first))


def load_stage2(
    spark: SparkSession, file_name: str, spec: TableSpec, staging_root: str, final_root: str, mode: str = "append",
    on_bad: str = "null", check_keys: bool = True, check_rows: bool = True, check_references: bool = True,
) -> None:
    """Load the staged rows of one file into the final table; see :func:`write_final` for what is refused."""
    staged = read_staged(spark, staging_root, spec, file_name)
    write_final(run_final(staged, spec, file_name), final_root, spec, mode, on_bad, check_keys,
                file_name, check_rows, check_references)
