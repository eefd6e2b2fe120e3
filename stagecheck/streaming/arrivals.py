"""Stage-1 loads driven by file arrival: the same load, started by a stream instead of a call.

Each micro-batch holds whole files. Rows are labelled with the name of their own file and
replace what was staged of it, so a batch that is run again after a failure leaves the same
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stagecheck import names
from stagecheck.operators.mapping import cast_voids
from stagecheck.plans.load import _HASH_MAPPING
from stagecheck.sinks.tables import write_staged
from stagecheck.spec import TableSpec, apply_steps


def load_arrivals(
    spark: SparkSession, folder: str, columns: list[str], spec: TableSpec, staging_root: str, checkpoint: str,
    files_per_batch: int = 100, multi_line: bool = False,
) -> StreamingQuery:
    """Load every file of ``folder`` not loaded yet, then stop. Call again when more have come.

    Tables derived from another table's file number their rows per file, so they are loaded
    file by file with ``load_stage1``. ``multi_line`` lets quoted cells hold line breaks; each file
    is then read by one task.
    """
    if spec.file_columns is not None:
        raise ValueError(f"{spec.name} is derived from another file; load it with load_stage1")
    files = (
        spark.readStream.option("header", True).option("escape", '"')
        .option("maxFilesPerTrigger", files_per_batch).option("multiLine", multi_line)
        .schema(", ".join(f"`{c}` string" for c in columns)).csv(folder)
        .withColumn(names.PRE_ORIGIN_FILE, F.col("_metadata.file_name"))
        .fillna("")
    )

    def load(batch: DataFrame, _: int) -> None:
        mappings = spec.staging_mappings + ((_HASH_MAPPING,) if spec.carries_file_hash else ())
        kept = batch.select(names.PRE_ORIGIN_FILE, *[m.source for m in mappings])
        mapped = kept.select(names.PRE_ORIGIN_FILE, *[F.col(m.source).alias(m.target) for m in mappings])
        write_staged(cast_voids(apply_steps(mapped, spec.steps)), staging_root, spec, "overwrite")

    return (
        files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
