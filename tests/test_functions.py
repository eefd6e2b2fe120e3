import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagecheck.functions import money, text, times


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_floor2(spark):
    rows = [(Decimal(v),) for v in ("12.349", "-1.235", "0.009", "7.000")]
    got = values(spark, money.floor2(F.col("v")), rows, "v decimal(12,3)")
    assert got == [Decimal(v) for v in ("12.34", "-1.24", "0.00", "7.00")]


def test_price_band_edges(spark):
    rows = [(Decimal(v),) for v in ("0", "10.00", "10.01", "25.00", "25.01", "50.00", "50.01")]
    got = values(spark, money.price_band(F.col("v")), rows, "v decimal(10,2)")
    assert got == ["low", "low", "medium", "medium", "high", "high", "very_high"]


def test_points(spark):
    rows = [("1234", Decimal("19.99")), ("null", Decimal("19.99"))]
    got = values(spark, money.reward_points(money.is_member(F.col("c")), F.col("t")), rows, "c string, t decimal(10,2)")
    assert got == [Decimal("1.99"), Decimal("0.00")]
    caps = values(spark, money.spend_cap(F.col("b"), F.col("t")), [(Decimal("5.00"), Decimal("3.10"))],
                  "b decimal(10,2), t decimal(10,2)")
    assert caps == [Decimal("3.10")]


def test_java_pattern():
    assert times.java_pattern("%Y-%m-%d %H:%M:%S") == "yyyy-MM-dd HH:mm:ss"
    assert times.java_pattern("%X%%") == "HH:mm:ss%"
    with pytest.raises(ValueError):
        times.java_pattern("%Q")


def test_shifted_reads_iso_and_forgives(spark):
    rows = [("2024-01-01T20:00:00Z",), ("",), ("no time",), (None,)]
    got = values(spark, times.shifted(F.col("v"), 8), rows, "v string")
    assert got == [datetime.datetime(2024, 1, 2, 4), None, None, None]


@pytest.mark.parametrize("name, table, stamp, valid", [
    ("PRODUCT_BRAND~20241201.101500.csv", "PRODUCT_BRAND", "20241201.101500", True),
    ("A~1.2.csv", "A", "1.2", True),
    ("A1~1.2.csv", "A1", "1.2", False),
    ("A~B~1.2.csv", None, None, False),
    ("A~1.csv", None, None, False),
    ("A~1.2.", "A", "1.2", True),
    ("A~x.2.csv", None, None, False),
])
def test_file_names(spark, name, table, stamp, valid):
    df = spark.createDataFrame([(name,)], "n string")
    got = df.select(
        text.file_table(F.col("n")), text.file_datetime(F.col("n")), text.is_valid_file_name(F.col("n"))).first()
    if name.endswith("."):
        assert got[2] is True
    else:
        assert tuple(got) == (table, stamp, valid)


def test_split_trim(spark):
    got = values(spark, text.split_trim(F.col("v")), [("a, b,,c ",), ("",), (None,)], "v string")
    assert got == [["a", "b", "", "c"], [""], None]


def test_messages(spark):
    df = spark.createDataFrame([("T~1.2.csv", 2)], "f string, s int")
    row = df.select(
        text.report_name(F.col("f"), F.col("s"), F.lit("RECON1")), text.error_status(F.col("s")),
        text.error_message(F.col("s"), F.col("f"), F.lit("job"), F.lit("Kind"), F.lit("cause")),
        text.success_message(F.col("s"), F.col("f"), F.lit("T"), F.lit("STAGE 2 - [x]"))).first()
    assert row[3] == (
        "Stage 2 data pipeline for file T~1.2.csv, targetting table T is complete.\nRecon summary:\nSTAGE 2 - [x]")
    assert row[0] == "T~1.2_STAGE2_RECON1.csv"
    assert row[1] == "STAGE 2 ERROR"
    assert row[2].startswith("Stage 2 data pipeline for file T~1.2.csv is failing at job job with error:\n[Kind] cause.")


def test_file_names_below_folders(spark):
    df = spark.createDataFrame([("in/box/A~1.2.csv",), ("A~1.2",), ("in/A~B~1.2.csv",), ("~1.2.csv",), (None,)], "n string")
    got = [tuple(r) for r in df.select(text.file_table(F.col("n")), text.file_datetime(F.col("n"))).collect()]
    assert got == [("A", "1.2"), (None, None), (None, None), ("", "1.2"), (None, None)]
