"""Flat files: scan, ordered merge, listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

FILE_ORDER = ("_rank", "_file", "_block_start", "_row")


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True).option("quote", '"').option("escape", '"').option("sep", ",")
        .option("multiLine", multi_line).option("recursiveFileLookup", True)
    )


def file_header(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """Column names from the header of a file, or of the first file below a folder."""
    return _reader(spark, multi_line).csv(path).columns


def read_flat_file(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, multi_line: bool = False,
) -> DataFrame:
    """Comma-separated file with header and double quotes, every column text, blank cells ``''``.

    Giving ``columns`` saves the look at the header. ``multi_line`` lets quoted cells hold line
    breaks, at the price that a file is read by one task; ``read_quoted_file`` reads it by many.
    """
    names = list(columns) if columns else file_header(spark, path if isinstance(path, str) else path[0], multi_line)
    reader = _reader(spark, multi_line).option("enforceSchema", False)
    rows = reader.schema(_text_schema(names)).csv(path if isinstance(path, str) else list(path))
    return rows.fillna("")


def file_manifest(spark: SparkSession, folder: str, prefix: str | None = None) -> DataFrame:
    """Path, size and time of every file below a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .select("path", "length", "modificationTime")
    )
    return files.filter(F.element_at(F.split("path", "/"), -1).startswith(prefix)) if prefix else files


def merge_csv_files(
    spark: SparkSession, paths: Sequence[str], keep_order: bool = True, multi_line: bool = False,
) -> DataFrame:
    """Several files, in the given order, as one frame.

    All files must have the header of the first; the tasks that read them check it. With
    ``keep_order`` the frame carries the columns of ``FILE_ORDER`` (rank of the given path, file,
    start of the block, row), on which it can be sorted without gathering it anywhere. Files
    of a folder go by name. One scan reads all; ranks are joined to it by file.
    """
    header = file_header(spark, paths[0], multi_line)
    if not keep_order:
        return read_flat_file(spark, list(paths), header, multi_line)
    rows = read_flat_file(spark, list(paths), header, multi_line).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_row"))
    return rows.join(_ranks(spark, paths), "_file").select(*header, *FILE_ORDER)


def _ranks(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(_file, _rank): every file with the place of the given path it is or lies below."""
    plain = lambda path: F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")
    given = []
    for rank, path in enumerate(paths):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        given.append((at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString().rstrip("/"), rank))
    wanted = spark.createDataFrame(given, "_path string, _rank int").withColumn("_path", plain(F.col("_path")))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths)).select(
        F.col("_metadata.file_path").alias("_file")).distinct()
    steps = F.split(plain(F.col("_file")), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    return files.withColumn("_path", F.explode(above)).join(wanted, "_path").groupBy("_file").agg(F.min("_rank").alias("_rank"))
