"""Pinned tables: where they lie, who owns them, and how many slots a frame gets."""

import time

import pytest
from pyspark.sql import functions as F

from stagecheck import storage
from stagecheck.operators.numbering import number_rows


def test_a_scope_deletes_what_was_pinned_in_it(spark):
    kept = storage.pin(spark.range(3), "kept")
    with storage.pin_scope(spark):
        inner = storage.pin(spark.range(5), "inner")
        path = inner.inputFiles()[0].rsplit("/", 1)[0]
        assert inner.count() == 5 and storage.path_exists(spark, path)
        with storage.pin_scope(spark):
            storage.pin(spark.range(1), "deeper")
        assert storage.path_exists(spark, path)
    assert not storage.path_exists(spark, path)
    assert kept.count() == 3


def test_the_warehouse_stands_in_for_the_setting(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(spark.conf, "get", lambda key, default=None: seen.setdefault(key, None) if key == "spark.checkpoint.dir" else "/shared/warehouse/")
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    assert storage.shared_folder(spark) == "/shared/warehouse"


def test_slots_follow_the_size_of_the_files(spark, tmp_path):
    spark.range(200_000).repartition(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert storage.input_slots(df) == 4
    assert storage.input_slots(df.filter("id > 5"), slot_bytes=size // 4) == -(-3 * size // (size // 4))


def test_rows_with_maps_can_be_numbered(spark):
    df = spark.range(20).selectExpr("id % 4 AS k", "map('a', id) AS m")
    got = number_rows(df, ["k"]).collect()
    assert sorted(r.id for r in got) == list(range(20))
    assert [r.k for r in sorted(got, key=lambda r: r.id)] == sorted(i % 4 for i in range(20))


def test_a_local_warehouse_is_refused_on_a_cluster():
    class Context:
        master, getCheckpointDir = "spark://host:7077", staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}

    class Local:
        getScheme = staticmethod(lambda: "file")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(storage, "file_system", lambda spark, path: (Local, path))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.shared_folder(Session)
        patch.setattr(Context, "master", "local[2]")
        assert storage.shared_folder(Session) == "file:/tmp/warehouse"


def test_an_input_read_twice_counts_once(spark, tmp_path):
    spark.range(100_000).repartition(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert storage.input_sizes(df.join(df.filter("id > 3").withColumnRenamed("id", "b"), df["id"] == F.col("b"))) == storage.input_sizes(df)


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def _left_behind(spark, before):
    """Shuffle files that are new since ``before``, once Spark has had time to delete some."""
    for _ in range(50):
        if not (new := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return new


def test_pinned_rows_leave_no_shuffle_files(spark):
    """What was exchanged for a pinned table takes no disk beside it, and the session's setting is as it was."""
    before, dealt = _shuffle_files(spark), spark.range(20_000).repartitionByRange(3, "id")
    pinned = storage.pin(dealt, "dealt")
    assert not _left_behind(spark, before)
    assert pinned.count() == dealt.count() == 20_000
    assert spark.conf.get(storage.SHUFFLE_CLEANUP, None) is None


def test_parts_are_read_back_as_one(spark):
    with storage.pin_scope(spark):
        parts = storage.pin_parts((spark.range(k, k + 5) for k in (0, 5)), "parts")
        assert sorted(r.id for r in parts.collect()) == list(range(10))
        folders = {f.rsplit("/", 1)[0] for f in parts.inputFiles()}
        assert len(folders) == 2
    assert not any(storage.path_exists(spark, f) for f in folders)
