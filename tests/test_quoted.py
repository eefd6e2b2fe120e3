"""Quoted line breaks over many blocks, against the whole-file reader."""

import csv
import io
import random

import pytest

from stagecheck.catalog import QUERIES
from stagecheck.sinks import files as sinks
from stagecheck.sources.files import read_flat_file
from stagecheck.sources.quoted import PLACE, read_quoted_file


@pytest.fixture
def small_blocks(spark):
    """Blocks of 97 bytes, so that small files are cut in many places."""
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def text_of(rows, line="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=line).writerows(rows)
    return out.getvalue()


def some_rows(draw, count):
    words = ["a", 'q"uote', "two\nlines", "", "x,y", "\n", '"', "é" * 40, "l\n" * 70, " s ", "back\\slash"]
    return [[str(i), draw.choice(words), draw.choice(words) + draw.choice(words)] for i in range(count)]


@pytest.mark.parametrize("line", ["\n", "\r\n"])
def test_many_blocks(spark, tmp_path, small_blocks, line):
    draw = random.Random(7)
    want = []
    for name in "abc":
        rows = some_rows(draw, 60)
        (tmp_path / f"{name}.csv").write_text(text_of([["id", "one", "two"], *rows], line), newline="")
        want += rows
    got = read_quoted_file(spark, str(tmp_path), ["id", "one", "two"], places=True)
    assert sorted(map(list, got.select("id", "one", "two").collect())) == sorted(want)
    assert got.select(PLACE[1]).distinct().count() > 20
    in_order = [list(r) for r in got.orderBy(*PLACE).select("id", "one", "two").collect()]
    assert in_order == want
    whole = read_flat_file(spark, str(tmp_path), ["id", "one", "two"], multi_line=True)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, want))


def test_blocks_within_one_record(spark, tmp_path, small_blocks):
    rows = [["1", "x\n" * 500], ["2", "y"]]
    path = tmp_path / "long.csv"
    path.write_text(text_of([["id", "v"], *rows]))
    assert sorted(map(list, read_quoted_file(spark, str(path)).collect())) == rows


def test_odd_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n\n1,\n\n2,\"\"\n3")
    (tmp_path / "b.csv").write_text("id,v\n")
    (tmp_path / "c.csv").write_text("")
    got = sorted(map(tuple, read_quoted_file(spark, str(tmp_path), ["id", "v"]).collect()))
    assert got == [("1", ""), ("2", ""), ("3", "")]
    (tmp_path / "d.csv").write_text("id,other\n9,9\n")
    with pytest.raises(Exception, match="header of"):
        read_quoted_file(spark, str(tmp_path), ["id", "v"]).collect()


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = tmp_path / "large.csv"
    path.write_text(text_of([["id", "v"], *[[str(i), "a\nb"] for i in range(400)]]))
    got = read_quoted_file(spark, str(path), ["id", "v"])
    assert got.rdd.getNumPartitions() > 20 and got.count() == 400
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan


def test_large_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """The scan's files grow in number with the input, not in size; a small input still goes to one."""
    rows = spark.range(600).selectExpr("id AS doc_id", "concat('a\n\"', repeat(uuid(), 20)) AS text", "'en' AS lang", "'s' AS source")
    rows.repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    want = sorted(map(tuple, spark.read.parquet(str(tmp_path / "documents.parquet")).collect()))
    scan = QUERIES["quoted_file_scan"]
    assert len(scan(spark, str(tmp_path)).inputFiles()) == 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        monkeypatch.setattr(sinks, "LARGE_FILE_BYTES", 30_000)
        back = scan(spark, str(tmp_path))
        assert 3 <= len(back.inputFiles()) <= 12
        assert sorted(map(tuple, back.collect())) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
