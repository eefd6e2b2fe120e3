"""Order totals, running points balances and spending per customer.

A plain window per customer would put a customer with very many orders into one task. Here
rows are first cut into slots of similar size along (customer, time), running values are
taken inside a slot, and what earlier slots of the same customer add is joined on
afterwards. Of all keys in a slot only the first can also occur in an earlier slot, so this
carry has at most one row per slot and may be broadcast at any data size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from stagecheck.functions.money import MONEY, floor2
from stagecheck.operators.numbering import POSITION, SLOT, in_slots
from stagecheck.storage import pin

# Running values are whole cents: adding up longs is several times faster than wide decimals.
_SUM, _LOW_BEFORE = "_running_sum", "_low_before"


def _cents(value: Column) -> Column:
    return (value.cast(MONEY) * F.lit(100)).cast("bigint")


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def order_totals(
    items: DataFrame, order: str, price: Column, quantity: Column, name: str = "total",
) -> DataFrame:
    """Sum over the items of an order of price times quantity, each rounded down to two places."""
    return items.groupBy(order).agg(F.sum(floor2(price * quantity)).cast(MONEY).alias(name))


def price_items(items: DataFrame, products: DataFrame, fk: str, pk: str, price: str) -> DataFrame:
    """Look up the unit price of each item. Spark broadcasts the products only while they are small."""
    prices = products.select(F.col(pk).alias("_product"), F.col(price))
    return items.join(prices, items[fk] == prices["_product"]).drop("_product")


def running_sum(
    df: DataFrame, key: str, order: Sequence[str], change: Column, num_partitions: int | None = None,
) -> DataFrame:
    """Adds the running sum of ``change`` per key, and the lowest running sum of the rows before, in cents.

    ``order`` must tell the rows of one key apart.
    """
    in_slot = Window.partitionBy(SLOT, key).orderBy(POSITION)
    up_to_here = in_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before_here = in_slot.rowsBetween(Window.unboundedPreceding, -1)
    changed = df.withColumn("_change", _cents(change))
    local = pin(
        in_slots(changed, [key, *order], tie_break=(), num_partitions=num_partitions)
        .withColumn(_SUM, F.sum("_change").over(up_to_here))
        .withColumn(_LOW_BEFORE, F.min(_SUM).over(before_here))
        .drop("_change"),
        "ledger",
    )
    carry = _carry(local, key)
    same = (local[SLOT] == F.col("_in_slot")) & local[key].eqNullSafe(F.col("_key"))
    base = F.coalesce("_base", F.lit(0))
    return (
        local.join(F.broadcast(carry), same, "left")
        .withColumn(_LOW_BEFORE, F.least("_base_low", base + F.col(_LOW_BEFORE)))
        .withColumn(_SUM, base + F.col(_SUM))
        .drop(SLOT, POSITION, *carry.columns)
    )


def _carry(local: DataFrame, key: str) -> DataFrame:
    """What a slot takes over for the key its predecessor ended with: one row per slot at most.

    A key that goes on into the next slot is the last of its own, so the last row of every
    slot tells all there is to carry.
    """
    ends = local.groupBy(SLOT).agg(F.max(POSITION).alias(POSITION))
    last_rows = local.join(F.broadcast(ends), [SLOT, POSITION], "left_semi").select(
        F.col(key).alias("_key"), SLOT, F.col(_SUM).alias("_total"), F.least(_LOW_BEFORE, _SUM).alias("_lowest"))
    of_key = Window.partitionBy("_key").orderBy(SLOT)
    so_far = of_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        last_rows
        .withColumn("_base", F.sum("_total").over(so_far))
        .withColumn("_base_low", F.min(F.col("_base") - F.col("_total") + F.col("_lowest")).over(so_far))
        .withColumn("_in_slot", F.lead(SLOT).over(Window.orderBy(SLOT)))
        .select("_key", "_in_slot", "_base", "_base_low")
    )


def points_ledger(
    df: DataFrame, customer: str, order: Sequence[str], gained: str, used: str, name: str = "balance",
) -> DataFrame:
    """Balance after each order: everything gained minus everything used so far."""
    summed = running_sum(df, customer, order, F.col(gained) - F.col(used))
    return summed.withColumn(name, _money(F.col(_SUM))).drop(_SUM, _LOW_BEFORE)


def spend_points(
    df: DataFrame, customer: str, order: Sequence[str], gained: str, total: str, spends: str,
    used_name: str = "points_used", name: str = "balance",
) -> DataFrame:
    """Points used per order and the balance after it, when spending orders use all they can.

    A spending order uses the smaller of its total and the points held including its own
    gain: ``b = max(b + gained - total, 0)``; any other order gives ``b = b + gained``. This
    recursion equals the running sum of the changes minus its lowest value below zero, so no
    row-by-row state is needed; the use falls short of the total by as much as the order
    pushes that lowest value down.
    """
    summed = running_sum(df, customer, order, F.col(gained) - _wanted(total, spends))
    return _spent(summed, _wanted(total, spends), used_name, name)


def _wanted(total: str, spends: str) -> Column:
    return F.when(F.col(spends), F.col(total)).otherwise(F.lit(0).cast(MONEY))


def _spent(summed: DataFrame, wanted: Column, used_name: str, name: str) -> DataFrame:
    low_before = F.least(F.col(_LOW_BEFORE), F.lit(0))
    low_here = F.least(low_before, F.col(_SUM))
    return (
        summed.withColumn(name, _money(F.col(_SUM) - low_here))
        .withColumn(used_name, _money(_cents(wanted) - (low_before - low_here)))
        .drop(_SUM, _LOW_BEFORE)
    )


@dataclass(frozen=True)
class Continued:
    """What new rows do to a ledger: rows to put in place of those of ``reopened`` customers, and the state after them."""

    rows: DataFrame
    reopened: DataFrame
    state: DataFrame


def empty_state(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The state of a ledger without rows: per key the sum and the lowest running sum, in cents, and the last place in order."""
    last = F.struct(*[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order]).alias("last")
    none = F.lit(None).cast("bigint")
    return df.limit(0).select(key, none.alias("total"), none.alias("lowest"), last)


def _continued(
    new: DataFrame, history: DataFrame, state: DataFrame, key: str, order: Sequence[str], change: Column,
) -> Continued:
    """Running sums of ``new`` on top of ``state``, in the columns that :func:`running_sum` adds.

    A customer with a new row ahead of one that is counted already is reopened: all rows are summed
    again. For the others the state stands for the history, which is not read.
    """
    place = F.struct(*order)
    late = new.join(state.select(F.col(key).alias("_key"), "last"), new[key].eqNullSafe(F.col("_key"))).filter(place < F.col("last"))
    late = pin(late.select(F.col("_key")).distinct(), "reopened")
    again = history.join(late, history[key].eqNullSafe(late["_key"]), "left_semi")
    known = state.withColumnRenamed(key, "_key").join(late.withColumnRenamed("_key", "_late"), F.col("_key").eqNullSafe(F.col("_late")), "left_anti")
    known = known.withColumnsRenamed({"total": "_known_total", "lowest": "_known_lowest"}).drop("last")
    summed = running_sum(new.unionByName(again), key, order, change)
    summed = summed.join(known, summed[key].eqNullSafe(known["_key"]), "left").drop("_key")
    base = F.coalesce("_known_total", F.lit(0))
    rows = pin(summed.withColumns({
        _LOW_BEFORE: F.least("_known_lowest", base + F.col(_LOW_BEFORE)), _SUM: base + F.col(_SUM)}), "continued")
    touched = rows.groupBy(key).agg(
        F.max_by(_SUM, place).alias("total"), F.min(F.least(_SUM, "_known_lowest")).alias("lowest"), F.max(place).alias("last"))
    seen = touched.select(F.col(key).alias("_key"))
    rest = state.join(seen, state[key].eqNullSafe(seen["_key"]), "left_anti")
    after = pin(touched.unionByName(rest), "ledger-state")
    return Continued(rows.drop("_known_total", "_known_lowest"), late.withColumnRenamed("_key", key), after)


def continue_ledger(
    new: DataFrame, history: DataFrame, state: DataFrame, customer: str, order: Sequence[str], gained: str, used: str,
    name: str = "balance",
) -> Continued:
    """``points_ledger`` of the rows of one more file, from the state that the files before left."""
    done = _continued(new, history, state, customer, order, F.col(gained) - F.col(used))
    return replace(done, rows=done.rows.withColumn(name, _money(F.col(_SUM))).drop(_SUM, _LOW_BEFORE))


def continue_spending(
    new: DataFrame, history: DataFrame, state: DataFrame, customer: str, order: Sequence[str], gained: str, total: str,
    spends: str, used_name: str = "points_used", name: str = "balance",
) -> Continued:
    """``spend_points`` of the rows of one more file, from the state that the files before left."""
    wanted = _wanted(total, spends)
    done = _continued(new, history, state, customer, order, F.col(gained) - wanted)
    return replace(done, rows=_spent(done.rows, wanted, used_name, name))


def taken_up(ledger: DataFrame, done: Continued, customer: str) -> DataFrame:
    """The whole ledger after :func:`continue_ledger` or :func:`continue_spending`: rows of reopened customers are replaced."""
    gone = done.reopened.select(F.col(customer).alias("_gone"))
    return ledger.join(gone, ledger[customer].eqNullSafe(gone["_gone"]), "left_anti").unionByName(done.rows)


def customer_balance(
    customers: DataFrame, orders: DataFrame, key: str, fk: str, gained: str, used: str, name: str = "points",
) -> DataFrame:
    """Final balance of every customer, 0 for those without orders."""
    sums = orders.groupBy(fk).agg(F.sum(F.col(gained) - F.col(used)).alias("_points"))
    joined = customers.join(sums, customers[key] == sums[fk], "left")
    return joined.select(*[customers[c] for c in customers.columns if c != name],
                         F.coalesce("_points", F.lit(0)).cast(MONEY).alias(name))
