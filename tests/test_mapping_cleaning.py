import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagecheck.operators import cleaning, mapping
from stagecheck.spec import Column, ColumnMapping, apply_steps, register_step


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_apply_mapping_renames_casts_and_drops(spark):
    df = spark.createDataFrame([("1", "9.905", "x"), ("abc", "", "y")], "a string, b string, c string")
    maps = [ColumnMapping("b", "string", "pre_b", "decimal(10,2)"), ColumnMapping("a", "string", "pre_a", "int")]
    out = mapping.apply_mapping(df, maps)
    assert out.columns == ["pre_b", "pre_a"]
    assert rows(out) == [(Decimal("9.91"), 1), (None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        mapping.apply_mapping(df, maps, on_bad="fail").collect()
    assert mapping.apply_mapping(df, []).columns == df.columns


def test_coerce_declared_fails_like_a_table(spark):
    df = spark.createDataFrame([("toolong", "1")], "t string, n string")
    columns = [Column("t", "string", True, 3), Column("n", "int")]
    assert rows(mapping.coerce_declared(df, columns)) == [("toolong", 1)]
    with pytest.raises(Exception, match="longer than 3"):
        mapping.coerce_declared(df, columns, "fail").collect()
    missing = spark.createDataFrame([(None, "1")], "t string, n string")
    with pytest.raises(Exception, match="required value is missing"):
        mapping.coerce_declared(missing, columns, "fail").collect()


def test_cast_voids_casts_every_one(spark):
    df = spark.range(1).select("id", F.lit(None).alias("a"), F.lit(None).alias("b"))
    assert mapping.cast_voids(df).dtypes == [("id", "bigint"), ("a", "string"), ("b", "string")]


def test_conform_columns(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    assert rows(mapping.conform_columns(df, ["a", "v", "b"], {"v": "1"})) == [("x", "1", 1)]
    with pytest.raises(ValueError):
        mapping.conform_columns(df, ["a", "z"])


def test_blank_rules(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "v string")
    assert rows(cleaning.blank_to_default(df, {"v": "1"})) == [("1",), (None,), ("x",)]
    assert rows(cleaning.blank_to_null(df, ["v"])) == [(None,), (None,), ("x",)]


def test_null_to_default_keeps_the_type(spark):
    at = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([(None,), (at,)], "v timestamp")
    out = cleaning.null_to_default(df, {"v": "1900-01-01 00:00:00"})
    assert out.dtypes == [("v", "timestamp")]
    assert rows(out) == [(datetime.datetime(1900, 1, 1),), (at,)]


def test_explode_list(spark):
    df = spark.createDataFrame([(2, "b, ,c"), (1, "a"), (3, None), (4, "")], "id int, cats string")
    out = cleaning.explode_list(df, "id", "cats", "id_prod", "id_cat", "id")
    assert out.columns == ["id_prod", "id_cat", "id"]
    assert sorted(rows(out), key=lambda r: r[2]) == [
        (1, "a", 0), (2, "b", 1), (2, None, 2), (2, "c", 3), (4, None, 4)]


def test_now_uuid_derive(spark):
    df = cleaning.with_uuid(cleaning.with_now(spark.range(3), "t", "%Y"))
    got = df.collect()
    assert {len(r.uuid) for r in got} == {36} and len({r.uuid for r in got}) == 3
    assert {r.t for r in got} == {str(datetime.datetime.now(datetime.timezone.utc).year)}
    assert rows(cleaning.derive(spark.range(2), "n", "id + 1")) == [(0, 1), (1, 2)]


def test_steps_by_name(spark):
    register_step("double_ids", lambda df: df.withColumn("id", F.col("id") * 2))
    assert rows(apply_steps(spark.range(2), ["double_ids"])) == [(0,), (2,)]
    with pytest.raises(ValueError):
        apply_steps(spark.range(2), ["no_such_step"])
    empty = spark.range(0).select()
    assert apply_steps(empty, ["no_such_step"]) is empty
