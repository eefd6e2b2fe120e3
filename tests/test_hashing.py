import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagecheck.functions.hashing import row_hash


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest().upper()


def hashed(df, *args, **kwargs):
    return [r.h for r in df.select(row_hash(*args, **kwargs).alias("h")).collect()]


def test_equals_plain_sha256(spark):
    df = spark.createDataFrame([(1, "bé", "x"), (2, "", "y")], "a int, b string, c string")
    assert hashed(df, ["a", "b", "c"]) == [sha("1béx"), sha("2y")]


def test_nulls_propagate_or_read_as_blank(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert hashed(df, ["a", "b"]) == [None]
    assert hashed(df, ["a", "b"], nulls="empty") == [sha("1")]


def test_separator_keeps_neighbours_apart(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3")], "a string, b string")
    plain = hashed(df, ["a", "b"])
    apart = hashed(df, ["a", "b"], sep="\x1f")
    assert plain[0] == plain[1] and apart[0] != apart[1] and apart[0] == sha("1\x1f23")


def test_kinds(spark):
    df = spark.createDataFrame(
        [(True, Decimal("5.50")), (False, Decimal("5.00")), (None, Decimal("-0.05"))], "f boolean, d decimal(10,2)")
    assert hashed(df, ["f", "d"], {"f": "bool", "d": "decimal"}) == [sha("15.5"), sha("05"), sha("0-0.05")]


def test_independent_of_partitioning(spark):
    df = spark.range(1000).withColumn("b", F.col("id") * 7)
    one = df.repartition(1).select("id", row_hash(["id", "b"]).alias("h"))
    many = df.repartition(7, "b").select("id", row_hash(["id", "b"]).alias("h"))
    assert one.exceptAll(many).isEmpty()


def test_refuses_nonsense(spark):
    with pytest.raises(ValueError):
        row_hash([])
    with pytest.raises(ValueError):
        row_hash(["a"], {"a": "float"})
    with pytest.raises(ValueError):
        row_hash(["a"], nulls="skip")
