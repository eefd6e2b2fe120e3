from stagecheck.operators import audit
from stagecheck.spec import Column


def test_constraint_audit(spark):
    df = spark.createDataFrame(
        [("1", "ab", "9.905"), ("abc", "abcdef", "123456789.00"), ("", None, "x"), (None, "a", None)],
        "id string, name string, price string")
    columns = [Column("id", "int"), Column("name", "string", True, 3), Column("price", "decimal(10,2)", False)]
    got = {(r.rule, r["column"]): r.violations for r in audit.constraint_audit(df, columns).collect()}
    assert got == {
        ("not_null", "id"): 1, ("castable", "id"): 2, ("not_null", "name"): 1, ("length", "name"): 1,
        ("castable", "price"): 1, ("range", "price"): 1}


def test_foreign_keys(spark):
    child = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(5,), (5,)], "pk int")
    assert [tuple(r) for r in audit.fk_orphans(child, parent, "fk", "pk").collect()] == [(2, 6)]
    fixed = audit.fk_repair(child, parent, "fk", "pk")
    assert sorted(map(tuple, fixed.collect()), key=str) == [(1, 5), (2, 0), (3, None)]
    assert fixed.dtypes == child.dtypes


def test_duplicates_and_conflicts(spark):
    new = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k int, v string")
    stored = spark.createDataFrame([(3, "x"), (9, "y"), (9, "z")], "k int, v string")
    assert [tuple(r) for r in audit.pk_duplicates(new, ["k"]).collect()] == [(1, 2)]
    assert sorted(map(tuple, audit.key_conflicts(new, stored, ["k"]).collect())) == [(1, 2), (3, 2)]


def test_distinct_keys(spark):
    df = spark.createDataFrame([("2",), ("",), ("0",), (None,), ("1",), ("2",)], "k string")
    assert [r.k for r in audit.distinct_keys(df, "k").collect()] == ["1", "2"]
