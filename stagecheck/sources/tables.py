"""Staging and final tables, held by origin file, and JDBC queries."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession

from stagecheck import snapshots
from stagecheck.spec import TableSpec


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def read_staged(spark: SparkSession, root: str, spec: TableSpec, origin_file: str | None = None) -> DataFrame:
    """Staged rows, of one file if named: its folders are read by path, so no other is listed or opened."""
    return snapshots.read(spark, table_path(root, spec.staged_name), spec.staged_schema, origin_file)


def read_final(spark: SparkSession, root: str, spec: TableSpec, origin_file: str | None = None) -> DataFrame:
    return snapshots.read(spark, table_path(root, spec.final_name), spec.final_schema, origin_file)


def query_frames(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Result of a SQL text over frames named in it as ``{name}``; no view is left behind."""
    return spark.sql(sql, **frames)


def jdbc_address(kind: str, host: str, port: int, schema: str, options: Mapping[str, str] | None = None) -> str:
    """Address of a database; ``options`` are the driver's own, such as its TLS mode."""
    return f"jdbc:{kind}://{host}:{port}/{schema}" + (f"?{urlencode(sorted(options.items()))}" if options else "")


@dataclass(frozen=True)
class Split:
    """How a read is cut into ``partitions`` connections: ranges of ``column`` between two bounds, rows beyond them included."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def jdbc_options(
    url: str, source: str, user: str, password: str, split: Split | None = None, **more: str,
) -> dict[str, str]:
    """Reader options for a table name or bracketed query; ``more`` are driver, fetchsize and the like."""
    cut = {} if split is None else {
        "partitionColumn": split.column, "lowerBound": str(split.lower), "upperBound": str(split.upper),
        "numPartitions": str(split.partitions)}
    return {"url": url, "dbtable": source, "user": user, "password": password, **cut, **more}


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Rows of a database, by the options of :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**options).load()
