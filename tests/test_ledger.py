"""Balances against a plain walk over the orders, with a customer that spans many slots."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagecheck.operators import ledger

SCHEMA = "id int, cust int, at int, gained decimal(10,2), total decimal(10,2), used decimal(10,2), spends boolean"


def orders(seed, n=600):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        cust = 1 if draw.random() < 0.4 else draw.randint(2, 40)
        total = Decimal(draw.randint(1, 9000)) / 100
        gained = Decimal(draw.randint(0, 2000)) / 100
        out.append((i, cust, draw.randint(0, 50), gained, total, Decimal(draw.randint(0, 300)) / 100,
                    draw.random() < 0.3))
    return out


def walk(rows):
    """Balance of gained minus used, and points used and held under spending, per order id."""
    plain, held, out = {}, {}, {}
    for i, cust, at, gained, total, used, spends in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        plain[cust] = plain.get(cust, 0) + gained - used
        points = held.get(cust, 0) + gained
        take = min(points, total) if spends else Decimal(0)
        held[cust] = points - take
        out[i] = (plain[cust], take, held[cust])
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ledger_and_spending(spark, seed):
    rows = orders(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    want = walk(rows)
    balance = ledger.points_ledger(df, "cust", ["at", "id"], "gained", "used").collect()
    assert {r.id: r.balance for r in balance} == {i: w[0] for i, w in want.items()}
    spent = ledger.spend_points(df, "cust", ["at", "id"], "gained", "total", "spends").collect()
    assert {r.id: (r.points_used, r.balance) for r in spent} == {i: w[1:] for i, w in want.items()}


@pytest.mark.parametrize("slots", [1, 2, 16])
def test_hot_customer_over_many_slots(spark, slots):
    rows = orders(9)
    df = spark.createDataFrame(rows, SCHEMA)
    summed = ledger.running_sum(df, "cust", ["at", "id"], F.col("gained") - F.col("used"), num_partitions=slots)
    got = {r.id: Decimal(r._running_sum) / 100 for r in summed.collect()}
    assert got == {i: w[0] for i, w in walk(rows).items()}


def test_order_totals_round_each_item_down(spark):
    items = spark.createDataFrame([(1, Decimal("1.999"), 1), (1, Decimal("1.999"), 2), (2, Decimal("5.000"), 1)],
                                  "o int, p decimal(10,3), q int")
    got = {r.o: r.total for r in ledger.order_totals(items, "o", F.col("p"), F.col("q")).collect()}
    assert got == {1: Decimal("5.98"), 2: Decimal("5.00")}


def test_customer_balance_defaults_to_zero(spark):
    customers = spark.createDataFrame([(1, Decimal(0)), (2, Decimal(0))], "id int, points decimal(10,2)")
    df = spark.createDataFrame([(1, Decimal("3.50"), Decimal("1.00"))], "cust int, g decimal(10,2), u decimal(10,2)")
    got = ledger.customer_balance(customers, df, "id", "cust", "g", "u")
    assert {r.id: r.points for r in got.collect()} == {1: Decimal("2.50"), 2: Decimal("0.00")}


@pytest.mark.parametrize("seed", [4, 5])
def test_files_one_after_another_make_the_full_ledger(spark, seed):
    """Three files, with rows that come late and customers that are new; one customer has no id."""
    rows = [(i, None if c == 7 else c, at, *rest) for i, c, at, *rest in orders(seed, 300)]
    want = walk([(i, -1 if c is None else c, *rest) for i, c, *rest in rows])
    draw = random.Random(seed)
    files = [[], [], []]
    for r in rows:
        files[draw.choice([0, 1, 2]) if draw.random() < 0.1 else min(2, r[2] // 17)].append(r)
    frames = [spark.createDataFrame(f, SCHEMA) for f in files]
    order = ["at", "id"]
    for continued, args, columns, pick in (
            (ledger.continue_ledger, ("gained", "used"), ("balance",), slice(0, 1)),
            (ledger.continue_spending, ("gained", "total", "spends"), ("points_used", "balance"), slice(1, 3))):
        state, whole, history, reopened = ledger.empty_state(frames[0], "cust", order), None, frames[0].limit(0), 0
        for frame in frames:
            done = continued(frame, history, state, "cust", order, *args)
            whole = done.rows if whole is None else ledger.taken_up(whole, done, "cust")
            state, history, reopened = done.state, history.unionByName(frame), reopened + done.reopened.count()
        assert {r.id: tuple(r[c] for c in columns) for r in whole.collect()} == {i: w[pick] for i, w in want.items()}
        assert reopened > 0 and state.count() == len({r[1] for r in rows})


def test_history_is_read_for_reopened_customers_only(spark):
    first = spark.createDataFrame(orders(6, 50), SCHEMA)
    done = ledger.continue_ledger(first, first.limit(0), ledger.empty_state(first, "cust", ["at", "id"]), "cust", ["at", "id"], "gained", "used")
    later = spark.createDataFrame([(900 + i, c, 99, *rest) for i, c, _, *rest in orders(7, 20)], SCHEMA)
    broken = first.withColumn("gained", F.raise_error(F.lit("history was read")).cast("decimal(10,2)"))
    more = ledger.continue_ledger(later, broken, done.state, "cust", ["at", "id"], "gained", "used")
    assert more.reopened.count() == 0 and more.rows.count() == 20
