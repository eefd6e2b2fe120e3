"""Differences by hash tree against a count by hand."""

import random
from collections import Counter

import pytest

from stagecheck.operators import difference


def brute(left, right, width=1):
    gone, new = Counter(left) - Counter(right), Counter(right) - Counter(left)
    keys = {r[:width] for r in (*gone, *new)}
    out = {}
    for k in keys:
        a, b = (sum(n for r, n in side.items() if r[:width] == k) for side in (gone, new))
        out[k] = (a, b, "changed" if a and b else "left_only" if a else "right_only")
    return out


@pytest.mark.parametrize("leaf", [16, 1])
def test_random_tables(spark, monkeypatch, leaf):
    monkeypatch.setattr(difference, "LEAF_ROWS", leaf)
    monkeypatch.setattr(difference, "FIRST_BITS", 2)
    monkeypatch.setattr(difference, "MORE_BITS", 3)
    draw = random.Random(leaf)
    left = [(draw.choice([None, *range(300)]), draw.choice(["a", None]), draw.choice([None, 1])) for _ in range(500)]
    right = [r if draw.random() > 0.05 else (r[0], r[2] and "b", None) for r in left if draw.random() > 0.02] + [(1000, "n", 1)] * 3
    make = lambda rows, names: spark.createDataFrame(rows, names)
    got = difference.table_difference(
        make(left, "k int, v string, w int"), make(right, "id long, x string, y long"), [("k", "id")], [("v", "x"), ("w", "y")])
    assert got.columns == ["k", "left_rows", "right_rows", "kind"]
    assert {(r.k,): (r.left_rows, r.right_rows, r.kind) for r in got.collect()} == brute(left, right)


def test_equal_and_empty_tables(spark):
    one = spark.range(1000).selectExpr("id", "cast(id AS string) AS v").repartition(7)
    two = spark.range(1000).selectExpr("id AS pk", "cast(id AS string) AS w").orderBy("w")
    assert difference.table_difference(one, two, [("id", "pk")], [("v", "w")]).count() == 0
    assert difference.table_difference(one.filter("false"), two.filter("false"), [("id", "pk")], [("v", "w")]).count() == 0
    assert difference.table_difference(one, two.filter("false"), [("id", "pk")], [("v", "w")]).count() == 1000


def test_equal_tables_move_sums_alone(spark, tmp_path, monkeypatch):
    """One aggregate of nodes over both tables; no level below the first, and nothing left to compare."""
    levels, below = [], []
    real, picked = difference._unequal, difference._below
    monkeypatch.setattr(difference, "_unequal", lambda left, right, bits: levels.append((bits, real(left, right, bits))) or levels[-1][1])
    monkeypatch.setattr(difference, "_below", lambda rows, nodes, count, bits: below.append(count) or picked(rows, nodes, count, bits))
    spark.range(200_000).selectExpr("id", "cast(id AS string) AS v").write.parquet(str(tmp_path / "a"))
    table = spark.read.parquet(str(tmp_path / "a"))
    result = difference.table_difference(table, table.withColumnsRenamed({"id": "k", "v": "w"}), [("id", "k")], [("v", "w")])
    assert result.count() == 0 and below == [0, 0]
    assert [bits for bits, _ in levels] == [difference.FIRST_BITS] and levels[0][1].count() == 0
    sums = difference._sums(difference._side(table, ["id"], ["v"], table, ["id", "v"]), difference.FIRST_BITS, 1)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")  # summed before anything moves
    assert sums.count() <= 2**difference.FIRST_BITS


def test_one_fault_reads_one_leaf(spark, monkeypatch):
    seen = []
    real = difference._below
    monkeypatch.setattr(difference, "_below", lambda rows, nodes, count, bits: seen.append((count, bits)) or real(rows, nodes, count, bits))
    one = spark.range(100_000).selectExpr("id", "id % 7 AS v")
    two = spark.range(100_000).selectExpr("id AS k", "if(id = 77, -1, id % 7) AS w")
    got = difference.table_difference(one, two, [("id", "k")], [("v", "w")]).collect()
    assert [tuple(r) for r in got] == [(77, 1, 1, "changed")]
    assert {count for count, _ in seen} == {1} and seen[-1][1] >= 12
