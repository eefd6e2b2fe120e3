import random

import pytest
from pyspark.sql import functions as F

from stagecheck.operators import numbering


@pytest.mark.parametrize("slots", [1, 3, 8])
def test_dense_and_in_order(spark, slots):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, v % 10) for v in values], "k int, v int").repartition(5)
    got = numbering.number_rows(df, ["v", "k"], start=1, num_partitions=slots).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, 501))
    assert [(r.v, r.k) for r in got] == sorted((v % 10, v) for v in values)


def test_hot_value_spreads_over_slots(spark):
    """Copies of one row, a third of all, are numbered without meeting in one slot."""
    hot = spark.range(3000).select(F.lit(5).alias("k"), F.lit("same").alias("t"))
    rest = spark.range(6000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("t"))
    slotted = numbering.in_slots(hot.unionAll(rest), ["k"], num_partitions=9)
    sizes = [r["count"] for r in slotted.groupBy(numbering.SLOT).count().collect()]
    assert max(sizes) < 2500
    numbered = numbering.number_rows(hot.unionAll(rest), ["k"], num_partitions=9)
    assert numbered.agg(F.count_distinct("id"), F.min("id"), F.max("id")).first()[:] == (9000, 0, 8999)
    assert numbered.filter("t = 'same'").agg(F.max("id") - F.min("id")).first()[0] <= 3000


def test_empty(spark):
    assert numbering.number_rows(spark.range(0).withColumnRenamed("id", "k"), ["k"]).count() == 0


def test_renumber_and_remap(spark):
    parent = spark.createDataFrame([(10, "c"), (20, "a"), (30, "b")], "id int, at string")
    out = numbering.renumber(parent, "id", ["at"])
    assert sorted(map(tuple, out.select("id", "old_id").collect())) == [(1, 20), (2, 30), (3, 10)]
    child = spark.createDataFrame([(1, 10), (2, 30), (3, 99), (4, 10)], "item int, id_inst int")
    mapped = numbering.remap_fk(child, numbering.key_map(out, "id"), "id_inst")
    assert sorted(map(tuple, mapped.collect()), key=lambda r: r[0]) == [(1, 3), (2, 2), (3, None), (4, 3)]


def test_number_groups_by_first_appearance(spark):
    df = spark.createDataFrame([(3, "b"), (1, "c"), (2, "b"), (4, "a"), (5, None)], "pos int, g string")
    got = {r.pos: r.group_id for r in numbering.number_groups(df, "g", ["pos"]).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 3, 5: 4}


def test_shuffle_is_a_repeatable_permutation(spark):
    df = spark.range(200)
    once = numbering.shuffle_rows(df, "id", seed=3).collect()
    again = numbering.shuffle_rows(df.repartition(7), "id", seed=3).collect()
    assert sorted(once) == sorted(again)
    assert sorted(r.id for r in once) == list(range(1, 201))
    assert [r.old_id for r in sorted(once)] != list(range(200))


def test_reorder_children(spark):
    keys = spark.createDataFrame([(10, 3), (20, 1), (30, 2)], "old_key int, new_key int")
    child = spark.createDataFrame([(1, 10), (2, 20), (3, 10), (4, 99)], "id int, fk int")
    got = sorted(map(tuple, numbering.reorder_children(child, keys, "fk", "id").collect()))
    assert got == [(1, 1, 2), (2, 2, 1), (3, 2, 3)]
