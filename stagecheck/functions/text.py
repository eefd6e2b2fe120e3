"""Texts: lists inside a cell, file names, report names, status messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The naming rule of data files, and the report and status wordings.
VALID_FILE_NAME = r"^[a-zA-Z_]+~\d+\.\d+\.[a-zA-Z0-9]*$"
FILE_PARTS = r"^(?:.*/)?([^~/]*)~(\d+\.\d+)\.[^./]+$"
LAST_EXTENSION = r"(?<=.)\.[^.]+$"
REPORT_NAME = "%s_STAGE%s_%s.%s"
ERROR_STATUS = "STAGE %s ERROR"
SUCCESS_MESSAGE = "Stage %s data pipeline for file %s, targetting table %s is complete.\nRecon summary:\n%s"
UNKNOWN = "<UNKNOWN>"
ERROR_MESSAGE = (
    "Stage %s data pipeline for file %s is failing at job %s with error:\n[%s] %s.\n\n"
    'If any fields are specified as "UNKNOWN", check step function execution directly, '
    "as specific details cannot be obtained due to Step Function limitations."
)


def split_trim(value: Column, separator: str = ",") -> Column:
    """Split a cell into an array of trimmed texts."""
    return F.transform(F.split(value, f"\\Q{separator}\\E"), lambda item: F.trim(item))


def stem(file_name: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(file_name, LAST_EXTENSION, "")


def is_valid_file_name(file_name: Column) -> Column:
    return file_name.rlike(VALID_FILE_NAME)


def file_table(file_name: Column) -> Column:
    """Table part of ``TABLE~digits.digits.ext``, folders left aside; NULL when the name breaks the rule."""
    return F.when(file_name.rlike(FILE_PARTS), F.regexp_extract(file_name, FILE_PARTS, 1))


def file_datetime(file_name: Column) -> Column:
    """Time part of ``TABLE~digits.digits.ext``; NULL when the name breaks the rule."""
    return F.nullif(F.regexp_extract(file_name, FILE_PARTS, 2), F.lit(""))


def report_name(file_name: Column, stage: Column, report: Column, extension: str = "csv") -> Column:
    return F.format_string(REPORT_NAME, stem(file_name), stage.cast("string"), report, F.lit(extension))


def error_status(stage: Column) -> Column:
    return F.format_string(ERROR_STATUS, stage.cast("string"))


def success_message(stage: Column, file_name: Column, table: Column, summary: Column) -> Column:
    return F.format_string(SUCCESS_MESSAGE, stage.cast("string"), file_name, table, summary)


def error_message(stage: Column, file_name: Column, job: Column, kind: Column, cause: Column) -> Column:
    return F.format_string(ERROR_MESSAGE, stage.cast("string"), file_name, job, kind, cause)
