import pathlib
import random

import pytest

from stagecheck.sinks import files as sinks
from stagecheck.sources import files as sources
from stagecheck.sources import tables
from stagecheck.storage import path_exists


def write(path, text):
    pathlib.Path(path).write_text(text)
    return str(path)


def test_blank_quotes_and_line_breaks(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,name,note\n1,,"he said ""hi"", twice"\n2,"x, y","two\nlines"\n')
    got = [tuple(r) for r in sources.read_flat_file(spark, path, multi_line=True).collect()]
    assert got == [("1", "", 'he said "hi", twice'), ("2", "x, y", "two\nlines")]


def test_declared_columns_must_match_the_header(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name\n1,x\n")
    assert sources.read_flat_file(spark, path, ["id", "name"]).select("name").first()[0] == "x"
    with pytest.raises(Exception):
        sources.read_flat_file(spark, path, ["id", "title"]).collect()


def test_recursive_path(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    write(tmp_path / "deep" / "a.csv", "id\n1\n")
    write(tmp_path / "deep" / "er" / "b.csv", "id\n2\n")
    got = sources.read_flat_file(spark, str(tmp_path / "deep"), ["id"])
    assert sorted(r.id for r in got.collect()) == ["1", "2"]


def test_merge_keeps_given_order(spark, tmp_path):
    b = write(tmp_path / "b.csv", "id\n" + "".join(f"{i}\n" for i in range(50)))
    a = write(tmp_path / "a.csv", "id\n" + "".join(f"{i}\n" for i in range(50, 120)))
    merged = sources.merge_csv_files(spark, [b, a])
    out = str(tmp_path / "merged")
    sinks.write_merged(merged, out)
    lines = []
    for part in sorted(pathlib.Path(out).glob("part-*")):
        lines += part.read_text().splitlines()[1:]
    assert lines == [str(i) for i in range(120)]


def test_merge_refuses_other_header(spark, tmp_path):
    a, b = write(tmp_path / "a.csv", "id\n1\n"), write(tmp_path / "b.csv", "key\n2\n")
    with pytest.raises(Exception):
        sources.merge_csv_files(spark, [a, b]).collect()


def test_manifest(spark, tmp_path):
    write(tmp_path / "T~1.2.csv", "id\n1\n")
    write(tmp_path / "U~1.2.csv", "id\n")
    got = sources.file_manifest(spark, str(tmp_path), prefix="T~").collect()
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in got] == [("T~1.2.csv", 5)]


@pytest.mark.parametrize("codec", sinks.CODECS)
def test_archive(spark, tmp_path, codec):
    source = write(tmp_path / "a.csv", 'id,name\n1,"x ""y"""\n2,\n')
    assert sinks.archive_dataset(spark, source, str(tmp_path / "packed"), codec, drop_source=True)
    assert not path_exists(spark, source)
    got = sources.read_flat_file(spark, str(tmp_path / "packed"), ["id", "name"])
    assert sorted(map(tuple, got.collect())) == [("1", 'x "y"'), ("2", "")]


def test_archive_can_be_switched_off(spark, tmp_path):
    source = write(tmp_path / "a.csv", "id\n1\n")
    assert not sinks.archive_dataset(spark, source, str(tmp_path / "packed"), enabled=False, drop_source=True)
    assert path_exists(spark, source) and not path_exists(spark, str(tmp_path / "packed"))
    with pytest.raises(ValueError):
        sinks.archive_dataset(spark, source, str(tmp_path / "packed"), codec="zip")


def test_compact(spark, tmp_path):
    spark.range(100).selectExpr("cast(id AS string) id").repartition(10).write.option("header", True).csv(
        str(tmp_path / "many"))
    assert sinks.compact_dataset(spark, str(tmp_path / "many"), str(tmp_path / "few")) == 1
    assert len(list((tmp_path / "few").glob("part-*"))) == 1
    assert sources.read_flat_file(spark, str(tmp_path / "few")).count() == 100


def test_compacted_files_stay_bounded(spark, tmp_path):
    """A wish for few files does not put a large dataset into few tasks."""
    spark.range(4000).selectExpr("id", "'two\nlines' AS v").repartitionByRange(12, "id").write.option("header", True).csv(str(tmp_path / "many"))
    size = sum(f.stat().st_size for f in (tmp_path / "many").glob("part-*"))
    made = sinks.compact_dataset(spark, str(tmp_path / "many"), str(tmp_path / "few"), target_bytes=size // 8, target_files=3)
    parts = sorted((tmp_path / "few").glob("part-*"))
    assert made >= 8 and max(f.stat().st_size for f in parts) < size / 4
    text = "".join(f.read_text().removeprefix("id,v\n") for f in parts)
    assert text == "".join(f'{i},"two\nlines"\n' for i in range(4000))


def test_extract_skips_tables_without_hash(spark, tmp_path):
    assert sinks.extract_table(spark.range(1), [], str(tmp_path), "T", "1.2") is None
    path = sinks.extract_table(spark.range(2), ["id"], str(tmp_path), "T", "1.2")
    assert path.endswith("/T~1.2.csv")
    assert sources.read_flat_file(spark, path).columns == ["id", "file_hash"]


def test_report_path():
    assert sinks.report_path("/r/", "T", "T~1.2.csv", 1, "RECON2") == "/r/T/T~1.2_STAGE1_RECON2.csv"


def test_jdbc(spark):
    url = tables.jdbc_address("mysql", "h", 3306, "s", {"sslMode": "VERIFY_IDENTITY"})
    assert url == "jdbc:mysql://h:3306/s?sslMode=VERIFY_IDENTITY"
    assert tables.jdbc_address("postgresql", "h", 5432, "s") == "jdbc:postgresql://h:5432/s"
    options = tables.jdbc_options(url, "(SELECT 1) t", "u", "p", tables.Split("id", 0, 900, 9), fetchsize="1000")
    assert options == {
        "url": url, "dbtable": "(SELECT 1) t", "user": "u", "password": "p", "partitionColumn": "id", "lowerBound": "0",
        "upperBound": "900", "numPartitions": "9", "fetchsize": "1000"}
    with pytest.raises(Exception):  # no driver here
        tables.read_jdbc(spark, options)


def test_header_of_a_nested_folder(spark, tmp_path):
    (tmp_path / "in" / "day=1").mkdir(parents=True)
    write(tmp_path / "in" / "day=1" / "a.csv", 'id,"na,me"\n1,x\n')
    assert sources.read_flat_file(spark, str(tmp_path / "in")).columns == ["id", "na,me"]


def test_merge_of_folders_goes_by_path_and_name(spark, tmp_path):
    for folder, files in (("b", {"2.csv": range(30), "1.csv": [99]}), ("a", {"x y.csv": range(50, 52)})):
        (tmp_path / folder).mkdir()
        for name, ids in files.items():
            write(tmp_path / folder / name, "id\n" + "".join(f"{i}\n" for i in ids))
    merged = sources.merge_csv_files(spark, [str(tmp_path / "b"), str(tmp_path / "a")])
    got = [r.id for r in merged.orderBy(*sources.FILE_ORDER).collect()]
    assert got == ["99", *map(str, range(30)), "50", "51"]


def test_line_breaks_survive_archive_and_compaction(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", 'id,v\n1,"two\nlines"\n2,x\n')
    write(tmp_path / "in" / "b.csv", "id,v\n3,y\n")
    rows = [("1", "two\nlines"), ("2", "x"), ("3", "y")]
    sinks.compact_dataset(spark, str(tmp_path / "in"), str(tmp_path / "few"))
    part, = (tmp_path / "few").glob("part-*")
    assert part.read_text() == 'id,v\n1,"two\nlines"\n2,x\n3,y\n'
    sinks.archive_dataset(spark, str(tmp_path / "in"), str(tmp_path / "packed"), drop_source=True)
    assert not path_exists(spark, str(tmp_path / "in"))
    back = sources.read_flat_file(spark, str(tmp_path / "packed"), multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_archive_drops_nothing_that_differs(spark, tmp_path, monkeypatch):
    source = write(tmp_path / "a.csv", "id\n1\n2\n")
    contents = iter([(2, 5), (2, 6)])
    monkeypatch.setattr(sinks, "_contents", lambda rows: next(contents))
    with pytest.raises(ValueError, match="nothing is dropped"):
        sinks.archive_dataset(spark, source, str(tmp_path / "packed"), drop_source=True)
    assert path_exists(spark, source)


def test_any_text_survives(spark, tmp_path):
    draw = random.Random(5)
    pieces = ['"', ",", "\n", "\r", "\\", " ", "a", "é", "#", "\t", "'", '""', "\r\n"]
    rows = [(str(i), "".join(draw.choice(pieces) for _ in range(draw.randint(0, 6)))) for i in range(500)]
    spark.createDataFrame(rows, "id string, v string").write.options(**sinks.WRITE_OPTIONS).csv(str(tmp_path / "t"))
    back = sources.read_flat_file(spark, str(tmp_path / "t"), ["id", "v"], multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
