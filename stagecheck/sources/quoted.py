"""Delimited files whose quoted cells hold line breaks, read by many tasks each.

A quote inside a cell is doubled, so a line break ends a record just where an even number of
quotes lies ahead of it in the file. One pass counts the quotes of every block; their running sum, a
row per block, tells which blocks begin inside a cell. Then every task cuts the lines of its blocks at
true record ends. A record that crosses blocks comes out in pieces, which are few and are put
together by a small shuffle; all other text goes from the file to its cells without moving.

Counting and joining lines is vectorised over Arrow batches, the one place of this part that leaves the JVM: no
built-in operator carries a state along the rows of a task without shuffling them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

FILE, BLOCK_START, ROW = "_file", "_block_start", "_row"
PLACE = (FILE, BLOCK_START, ROW)

# What a piece of text is: a whole record, or the end, beginning or middle of one that crosses blocks.
WHOLE, END, BEGINNING, MIDDLE = range(4)

_OPTIONS = {"quote": '"', "escape": '"', "sep": ",", "multiLine": "true"}
_PIECES = pa.schema([
    ("record", pa.string()), (FILE, pa.string()), (BLOCK_START, pa.int64()), (ROW, pa.int64()), ("kind", pa.int8())])


def read_quoted_file(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, places: bool = False,
) -> DataFrame:
    """Comma-separated files with header, every column text, blank cells ``''``; cells may hold line breaks.

    Every file must have the header ``columns``, by default that of the first file. ``places`` adds the
    columns of ``PLACE``: file, start of the block where the record begins, and number in it, by
    which records can be put in order. Lines end in ``\\n`` or ``\\r\\n``; empty lines are no records.
    """
    paths = [path] if isinstance(path, str) else list(path)
    names = list(columns) if columns else _header(spark, paths[0])
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(paths).select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK_START))
    inside = _blocks(lines)
    pieces = _cut(lines, inside)
    records = pieces.filter(F.col("kind") == WHOLE).drop("kind")
    crossed = sorted({file for (file, _), begins_inside in inside.items() if begins_inside})
    if crossed:
        some = spark.createDataFrame([(f,) for f in crossed], f"{FILE} string")
        records = records.unionByName(_joined(_cut(lines.join(F.broadcast(some), FILE, "left_semi").select("value", FILE, BLOCK_START), inside)))
    return _parsed(records, names, places)


def _header(spark: SparkSession, path: str) -> list[str]:
    reader = spark.read.options(header=True, recursiveFileLookup=True, **_OPTIONS)
    return reader.csv(path).columns


def _blocks(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """Whether each block begins inside a quoted cell; a row per block comes to the driver."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    counted = lines.groupBy(FILE, BLOCK_START).agg(F.sum(quotes).alias("quotes"))
    ahead = F.sum("quotes").over(Window.partitionBy(FILE).orderBy(BLOCK_START).rowsBetween(Window.unboundedPreceding, -1))
    rows = counted.select(FILE, BLOCK_START, (F.coalesce(ahead, F.lit(0)) % 2 == 1).alias("inside"))
    return {(r[0], r[1]): r[2] for r in rows.toLocalIterator()}


@dataclass
class _Block:
    """The block a task is in: what is open of a record, and how many records came out."""

    file: str
    start: int
    open_inside: bool
    records: int = 0
    pending: list[str] = field(default_factory=list)

    @property
    def kind_of_next(self) -> int:
        return END if self.open_inside else WHOLE

    def rest(self) -> list[tuple[str, int]]:
        """What is open at the end of the block."""
        if not self.pending:
            return []
        return [("\n".join(self.pending), MIDDLE if self.open_inside else BEGINNING)]

    def feed(self, lines: pa.Array) -> Iterator[tuple[pa.Array, int]]:
        """Pieces that end with one of ``lines``, with their kind."""
        odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) & 1
        opened = int(self.open_inside) if not self.pending else 1
        ends = np.flatnonzero((np.cumsum(odd) + opened) % 2 == 0)
        if not len(ends):
            self.pending += lines.to_pylist()
            return
        first = int(ends[0]) + 1
        yield pa.array(["\n".join([*self.pending, *lines[:first].to_pylist()])], pa.string()), self.kind_of_next
        self.open_inside = False
        last = int(ends[-1]) + 1
        if len(ends) > 1:
            offsets = pa.array((ends + 1 - first).astype(np.int32))
            yield pc.binary_join(pa.ListArray.from_arrays(offsets, lines[first:last]), "\n"), WHOLE
        self.pending = lines[last:].to_pylist()


def _cut(lines: DataFrame, inside: dict[tuple[str, int], bool]) -> DataFrame:
    """Records and pieces of records, with the place where they begin, and their kind."""
    known = lines.sparkSession.sparkContext.broadcast(inside)

    def batch_of(block: _Block, texts: pa.Array, kind: int) -> pa.RecordBatch:
        count = len(texts)
        numbers = pa.array(np.arange(block.records, block.records + count))
        block.records += count
        return pa.RecordBatch.from_arrays(
            [texts, pa.array([block.file] * count, pa.string()), pa.array(np.full(count, block.start)), numbers,
             pa.array(np.full(count, kind, np.int8))], schema=_PIECES)

    def left_over(block: _Block | None) -> Iterator[pa.RecordBatch]:
        for text, kind in block.rest() if block else ():
            yield batch_of(block, pa.array([text], pa.string()), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            values, files, starts = batch.columns
            begins = starts.to_numpy(zero_copy_only=False)
            names = files.dictionary_encode()
            number = names.indices.to_numpy(zero_copy_only=False)
            borders = np.flatnonzero(np.diff(begins) | np.diff(number)) + 1
            for low, high in zip([0, *borders], [*borders, len(begins)], strict=True):
                if low == high:
                    continue
                file, start = names.dictionary[int(number[low])].as_py(), int(begins[low])
                if block is None or (block.file, block.start) != (file, start):
                    yield from left_over(block)
                    if (file, start) not in known.value:
                        raise ValueError(f"{file} was cut at {start}, where no block began when its quotes were counted")
                    block = _Block(file, start, known.value[file, start])
                for texts, kind in block.feed(values.slice(low, high - low)):
                    yield batch_of(block, texts, kind)
        yield from left_over(block)

    return lines.mapInArrow(run, f"record string, {FILE} string, {BLOCK_START} bigint, {ROW} bigint, kind tinyint")


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that cross blocks, from their pieces: a record begins with each beginning."""
    along = Window.partitionBy(FILE).orderBy(BLOCK_START, ROW)
    numbered = pieces.filter(F.col("kind") != WHOLE).withColumn("_of", F.count_if(F.col("kind") == BEGINNING).over(along))
    whole = numbered.groupBy(FILE, "_of").agg(
        F.array_sort(F.collect_list(F.struct(BLOCK_START, ROW, "record"))).alias("_pieces"))
    return whole.select(
        F.array_join(F.col("_pieces.record"), "\n").alias("record"), FILE,
        F.col("_pieces")[0][BLOCK_START].alias(BLOCK_START), F.col("_pieces")[0][ROW].alias(ROW))


def _parsed(records: DataFrame, names: Sequence[str], places: bool) -> DataFrame:
    """Cells of the records; the first record of each file must be the header and goes."""
    plain = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    schema = ", ".join(f"`_{i}` string" for i in range(len(names)))
    cells = records.withColumn("record", plain).filter(F.col("record") != "").withColumn(
        "_cells", F.from_csv("record", schema, _OPTIONS))
    first = (F.col(BLOCK_START) == 0) & (F.col(ROW) == 0)
    wrong = F.raise_error(F.concat(F.lit("header of "), F.col(FILE), F.lit(f" is not {','.join(names)}"))).cast("boolean")
    found = F.array(*[F.coalesce(F.col(f"_cells._{i}"), F.lit("")) for i in range(len(names))])
    rows = cells.filter(F.when(~first, True).when(F.array_join(found, ",") == ",".join(names), False).otherwise(wrong))
    made = [F.coalesce(F.col(f"_cells._{i}"), F.lit("")).alias(name) for i, name in enumerate(names)]
    return rows.select(*made, *(PLACE if places else ()))
