"""Migration tracker, routing of files to tables, and error events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stagecheck import names
from stagecheck.functions import text

TRACKER_KEYS = ("file_name", "executing_for_table")
TRACKER_COLUMNS = (
    "id", "file_name", "executing_for_table", "mig_sts", "error_msg", "recon_summary", "crt_upd_dt_time",
)

# Error types of the workflow service, by the shape of their cause.
MANAGED_ERRORS = ("Exception",)
JOB_ERRORS = ("States.TaskFailed", "Glue.ConcurrentRunsExceededException")
UNMANAGED_ERRORS = ("Lambda.Unknown", "Lambda.AWSLambdaException")
JOB_ERROR_LABEL = "Glue Runtime Error"
PAYLOAD_MARK = "Returned payload: "


def upsert_latest(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str],
    keep_when_null: Sequence[str] = (),
) -> DataFrame:
    """Insert new keys and replace known ones by their latest change.

    ``order`` must rank changes after the current rows and tell changes of a key apart. A
    column in ``keep_when_null`` keeps its last non-NULL value. The latest value is an
    aggregate, combined before the shuffle, so a key with very many changes stays cheap.
    """
    rank = F.struct(*order)
    latest = []
    for c in current.columns:
        if c in keys:
            continue
        value = F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)) if c in keep_when_null else (
            F.max_by(F.col(c), rank))
        latest.append(value.alias(c))
    merged = current.unionByName(changes).groupBy(*keys).agg(*latest)
    return merged.select(*current.columns)


def poll_status(df: DataFrame, columns: Sequence[str] | str | None = None, **where) -> DataFrame:
    """Tracker rows as text, filtered by equality; unknown names are left out, none means all."""
    if isinstance(columns, str):
        columns = [c.strip() for c in columns.split(",")]
    known = [c for c in TRACKER_COLUMNS if c in df.columns]
    wanted = [c for c in columns if c in known] if columns else known
    for name, value in where.items():
        if name in known:
            df = df.filter(F.col(name) == F.lit(value))
    return df.select(*[F.col(c).cast("string").alias(c) for c in wanted])


def summary_line(summary: DataFrame, stage: int) -> DataFrame:
    """A summary as one line, ``STAGE n - [header][row]…``, FAILED before PASSED.

    A summary has at most one row per outcome, so the list stays that short.
    """
    rows = F.array_sort(F.collect_list(
        F.concat(F.col(names.OUTCOME), F.lit(","), F.col(names.COUNT).cast("string"))))
    lines = F.concat(F.array(F.lit(f"{names.OUTCOME},{names.COUNT}")), rows)
    inner = F.array_join(F.transform(lines, lambda l: F.concat(F.lit("["), l, F.lit("]"))), "")
    return summary.agg(F.concat(F.lit(f"STAGE {stage} - "), inner).alias("recon_summary"))


def parse_file_name(df: DataFrame, column: str = "file_name") -> DataFrame:
    """Adds the table and time named by a file, NULL for names that break the rule, and ``is_valid``."""
    name = F.col(column)
    return df.withColumns({
        "table_name": text.file_table(name),
        "file_datetime": text.file_datetime(name),
        "is_valid": text.is_valid_file_name(name),
    })


def _routing_map(routing: Mapping[str, Sequence[str]]) -> Column:
    pairs = [x for table, targets in routing.items()
             for x in (F.lit(table), F.array(*[F.lit(t) for t in targets]).cast("array<string>"))]
    return F.create_map(*pairs)


def route_files(manifest: DataFrame, routing: Mapping[str, Sequence[str]], table: str = "table_name") -> DataFrame:
    """One row per file and table it feeds. The routing is a literal map, so nothing is shuffled."""
    targets = F.try_element_at(_routing_map(routing), F.col(table))
    return manifest.select("*", F.explode(targets).alias("target_table"))


def rejected_requests(
    requests: DataFrame, routing: Mapping[str, Sequence[str]], table: str = "table_name", target: str = "target_table",
) -> DataFrame:
    """Requests for a table their file does not feed, or from a file of an unknown table."""
    allowed = F.array_contains(F.try_element_at(_routing_map(routing), F.col(table)), F.col(target))
    return requests.filter(~F.coalesce(allowed, F.lit(False)))


def _last_value(entries: Column, key: str) -> Column:
    same = F.filter(entries, lambda e: F.lower(e["key"]) == F.lit(key.lower()))
    return F.try_element_at(same, F.lit(-1))["value"]


def parse_error_events(
    df: DataFrame, error_type: str = "error_type", cause: str = "cause", file_name: str = "file_name",
    stage: str = "pipeline_stage",
) -> DataFrame:
    """Adds kind, cause and job of an error event, and its status and message for the tracker.

    Causes are JSON texts in three shapes, told apart by the error type. Letter case of keys
    does not matter; what a cause leaves out reads ``<UNKNOWN>``. ``is_handled`` is false for an
    error type of no known shape.
    """
    def entries(value: Column) -> Column:
        return F.map_entries(F.from_json(value, "map<string,string>"))

    kind = F.col(error_type)
    managed, from_job = kind.isin(*MANAGED_ERRORS), kind.isin(*JOB_ERRORS)
    unmanaged = kind.isin(*UNMANAGED_ERRORS)
    payload = F.when(
        F.contains(F.col(cause), F.lit(PAYLOAD_MARK)), F.split_part(F.col(cause), F.lit(PAYLOAD_MARK), F.lit(2)),
    ).otherwise(F.col(cause))
    outer = entries(F.when(kind == "Lambda.Unknown", payload).otherwise(F.col(cause)))
    inner = entries(_last_value(F.col("_outer"), "errorMessage"))
    found = df.withColumn("_outer", outer).withColumn("_inner", F.when(managed, inner))

    def or_unknown(value: Column) -> Column:
        return F.coalesce(value, F.lit(text.UNKNOWN))

    message = _last_value(F.col("_outer"), "errorMessage")
    found = found.withColumns({
        "is_handled": managed | from_job | unmanaged,
        "error_kind": F.when(managed, or_unknown(_last_value(F.col("_inner"), "error_type")))
        .when(from_job, F.lit(JOB_ERROR_LABEL)).otherwise(kind),
        "error_cause": or_unknown(F.when(managed, _last_value(F.col("_inner"), "exception_cause")).otherwise(message)),
        "job_name": or_unknown(
            F.when(managed, _last_value(F.col("_inner"), "lambda_name"))
            .when(from_job, _last_value(F.col("_outer"), "jobName"))),
    }).drop("_outer", "_inner")
    return found.withColumns({
        "mig_sts": text.error_status(F.col(stage)),
        "error_msg": text.error_message(
            F.col(stage), F.col(file_name), F.col("job_name"), F.col("error_kind"), F.col("error_cause")),
    })
