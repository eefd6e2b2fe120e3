"""Every operator as a query over the given tables, each with the SQL that must agree with it.

The tables hold no faults, so pairs of layers are made from them with faults planted by
value: rows left out, texts changed, values lost.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from stagecheck import names, snapshots
from stagecheck.functions import money, text, times
from stagecheck.functions.hashing import row_hash, trimmed_decimal
from stagecheck.operators import audit, cleaning, ledger, mapping, matching, numbering, reports, tracker
from stagecheck.operators.difference import table_difference
from stagecheck.plans import load, reconcile
from stagecheck.sinks import files as file_sinks, tables as table_sinks
from stagecheck.sources import files as file_sources
from stagecheck.sources.quoted import read_quoted_file
from stagecheck.sources.tables import query_frames, read_final, read_staged, table_path
from stagecheck.spec import Column, ColumnMapping, ForeignKey, TableSpec, specs_from_config
from stagecheck.storage import input_slots, pin, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its oracle if SQL can state it."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dec(column: str, kind: str = "decimal(10,2)") -> F.Column:
    return F.col(column).cast(kind)


def trimmed_decimal_sql(value: str) -> str:
    """SQL text of a two-place decimal without trailing zeros."""
    return rf"regexp_replace(regexp_replace(CAST({value} AS VARCHAR), '0+$', ''), '\.$', '')"


# --- pairs of layers -------------------------------------------------------------------

CUSTOMER_FILE = "CUSTOMER~20240101.000000.csv"
ORDER_FILE = "ORDERS~20240101.000000.csv"
ITEM_FILE = "LINEITEM~20240101.000000.csv"

CUSTOMER = TableSpec(
    "CUSTOMER",
    (
        Column("id", "bigint"), Column("name", "string", True, 64), Column("nation", "int"),
        Column("balance", "decimal(10,2)"), Column("segment", "string", True, 16),
    ),
    hash_columns=("id", "name", "nation", "balance", "segment"),
)
ORDERS = TableSpec(
    "ORDERS",
    (
        Column("id", "bigint"), Column("customer", "bigint"), Column("status", "string", True, 1),
        Column("total", "decimal(12,2)"), Column("ordered_at", "timestamp"), Column("priority", "string", True, 16),
    ),
    hash_columns=("id", "customer", "status", "total", "ordered_at", "priority"),
)
ITEMS = TableSpec(
    "LINEITEM",
    (
        Column("order_id", "bigint"), Column("line", "int"), Column("part", "bigint"), Column("supplier", "bigint"),
        Column("quantity", "int"), Column("price", "decimal(12,2)"), Column("flag", "string", True, 1),
    ),
    keys=("order_id", "line", "part", "supplier"),
    hash_columns=("order_id", "line", "part", "supplier", "quantity", "flag"),
)


def customer_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a source file would hold them, all text."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("nation"),
        trimmed_decimal(dec("c_acctbal")).alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )


def customer_file(spark: SparkSession, folder: str) -> DataFrame:
    return customer_rows(spark, folder).withColumn(names.FILE_HASH, row_hash(CUSTOMER.hash_columns, nulls="empty"))


def customer_staged(spark: SparkSession, folder: str) -> DataFrame:
    balance = F.col("balance").cast("decimal(10,2)")
    faulty = (
        customer_file(spark, folder)
        .filter(~((F.col("nation") == "7") & (F.col("segment") == "BUILDING")))
        .withColumn("segment", F.when(balance < 0, "CHANGED").otherwise(F.col("segment")))
        .withColumn("name", F.when(~((F.col("nation") == "5") & (balance > 8000)), F.col("name")))
        .withColumn(names.FILE_HASH, F.when((F.col("nation") == "11") & (balance > 4000), "DAMAGED").otherwise(F.col(names.FILE_HASH)))
    )
    return mapping.coerce_declared(load.run_staging(faulty, CUSTOMER, CUSTOMER_FILE), CUSTOMER.staged_columns)


CUSTOMER_SQL = f"""
WITH file AS (
  SELECT *, upper(sha256(concat(id, name, nation, balance, segment))) AS file_hash FROM (
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
           {trimmed_decimal_sql('CAST(c_acctbal AS DECIMAL(10,2))')} AS balance, c_mktsegment AS segment
    FROM customer)
), staged_rows AS (
  SELECT c_custkey AS pre_id,
         CASE WHEN NOT (c_nationkey = 5 AND c_acctbal > 8000) THEN c_name END AS pre_name,
         c_nationkey AS pre_nation, CAST(c_acctbal AS DECIMAL(10,2)) AS pre_balance,
         CASE WHEN c_acctbal < 0 THEN 'CHANGED' ELSE c_mktsegment END AS pre_segment,
         CASE WHEN c_nationkey = 11 AND c_acctbal > 4000 THEN 'DAMAGED' ELSE file_hash END AS pre_file_hash,
         '{CUSTOMER_FILE}' AS pre_origin_file
  FROM customer JOIN file ON CAST(c_custkey AS VARCHAR) = id
  WHERE NOT (c_nationkey = 7 AND c_mktsegment = 'BUILDING')
), staged AS (
  SELECT *, upper(sha256(CAST(pre_id AS VARCHAR) || pre_name || CAST(pre_nation AS VARCHAR)
                         || {trimmed_decimal_sql('pre_balance')} || pre_segment)) AS staged_hash
  FROM staged_rows
)"""


def order_staged(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("pre_id"), F.col("o_custkey").alias("pre_customer"),
        F.col("o_orderstatus").alias("pre_status"), dec("o_totalprice", "decimal(12,2)").alias("pre_total"),
        F.col("o_orderdate").cast("timestamp").alias("pre_ordered_at"), F.col("o_orderpriority").alias("pre_priority"),
    )


def order_final(spark: SparkSession, folder: str) -> DataFrame:
    faulty = (
        order_staged(spark, folder)
        .filter(~((F.col("pre_status") == "P") & (F.col("pre_total") > 400000)))
        .withColumn("pre_priority", F.when(F.col("pre_total") < 20000, "CHANGED").otherwise(F.col("pre_priority")))
        .withColumn("pre_status", F.when(~((F.col("pre_priority") == "5-LOW") & (F.col("pre_total") > 450000)),
                                         F.col("pre_status")))
    )
    return load.run_final(faulty, ORDERS, ORDER_FILE)


ORDER_SQL = f"""
WITH staged_rows AS (
  SELECT o_orderkey AS pre_id, o_custkey AS pre_customer, o_orderstatus AS pre_status,
         CAST(o_totalprice AS DECIMAL(12,2)) AS pre_total, CAST(o_orderdate AS TIMESTAMP) AS pre_ordered_at,
         o_orderpriority AS pre_priority
  FROM orders
), final_rows AS (
  SELECT pre_id AS id, pre_customer AS customer,
         CASE WHEN NOT (pre_priority = '5-LOW' AND pre_total > 450000) THEN pre_status END AS status,
         pre_total AS total, pre_ordered_at AS ordered_at,
         CASE WHEN pre_total < 20000 THEN 'CHANGED' ELSE pre_priority END AS priority,
         '{ORDER_FILE}' AS origin_file
  FROM staged_rows WHERE NOT (pre_status = 'P' AND pre_total > 400000)
), staged AS (
  SELECT *, upper(sha256(CAST(pre_id AS VARCHAR) || CAST(pre_customer AS VARCHAR) || pre_status
      || CAST(pre_total AS VARCHAR) || CAST(pre_ordered_at AS VARCHAR) || pre_priority)) AS staged_hash
  FROM staged_rows
), final AS (
  SELECT *, upper(sha256(CAST(id AS VARCHAR) || CAST(customer AS VARCHAR) || status
      || CAST(total AS VARCHAR) || CAST(ordered_at AS VARCHAR) || priority)) AS final_hash
  FROM final_rows
)"""


def item_file(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").cast("string").alias("line"),
        F.col("l_partkey").cast("string").alias("part"), F.col("l_suppkey").cast("string").alias("supplier"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        dec("l_extendedprice", "decimal(12,2)").cast("string").alias("price"), F.col("l_returnflag").alias("flag"),
    )
    return rows.withColumn(names.FILE_HASH, row_hash(ITEMS.hash_columns, nulls="empty"))


def item_staged(spark: SparkSession, folder: str) -> DataFrame:
    faulty = (
        item_file(spark, folder)
        .filter(~((F.col("flag") == "R") & (F.col("quantity") == "50")))
        .withColumn("flag", F.when((F.col("quantity") == "1") & (F.col("flag") == "A"), "X").otherwise(F.col("flag")))
    )
    return mapping.coerce_declared(load.run_staging(faulty, ITEMS, ITEM_FILE), ITEMS.staged_columns)


ITEM_SQL = f"""
WITH file AS (
  SELECT *, upper(sha256(concat(order_id, line, part, supplier, quantity, flag))) AS file_hash FROM (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line,
           CAST(l_partkey AS VARCHAR) AS part, CAST(l_suppkey AS VARCHAR) AS supplier,
           CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price, l_returnflag AS flag
    FROM lineitem)
), staged_rows AS (
  SELECT CAST(order_id AS BIGINT) AS pre_order_id, CAST(line AS INTEGER) AS pre_line,
         CAST(part AS BIGINT) AS pre_part, CAST(supplier AS BIGINT) AS pre_supplier,
         CAST(quantity AS INTEGER) AS pre_quantity, CAST(price AS DECIMAL(12,2)) AS pre_price,
         CASE WHEN quantity = '1' AND flag = 'A' THEN 'X' ELSE flag END AS pre_flag,
         file_hash AS pre_file_hash, '{ITEM_FILE}' AS pre_origin_file
  FROM file WHERE NOT (flag = 'R' AND quantity = '50')
), staged AS (
  SELECT *, upper(sha256(CAST(pre_order_id AS VARCHAR) || CAST(pre_line AS VARCHAR) || CAST(pre_part AS VARCHAR)
      || CAST(pre_supplier AS VARCHAR) || CAST(pre_quantity AS VARCHAR) || pre_flag)) AS staged_hash
  FROM staged_rows
)"""


def summary_sql(source: str, left: str, right: str) -> str:
    return f"""
SELECT 'FAILED' AS reconciliation_outcome, CAST(count(*) - count(*) FILTER ({left} = {right}) AS BIGINT) AS "count"
FROM {source}
UNION ALL
SELECT 'PASSED', CAST(count(*) AS BIGINT) FROM {source} WHERE {left} = {right} HAVING count(*) > 0"""


def detail_sql(
    joined: str, pairs: list[tuple[str, str]], left: tuple[str, str, list[str]], right: tuple[str, str, list[str]],
    order: str, carried: str | None = None,
) -> str:
    """SQL of a complete detail report; each side is (source name, hash column, unmapped columns).

    ``carried`` is the hash the outcome compares with the right one, by default the left one.
    """
    def line(number: int, this: tuple, pick: int, other: tuple) -> str:
        cells = [f"CAST({p[pick]} AS VARCHAR) AS \"{p[0]} <> {p[1]}\"" for p in pairs]
        for side in (left, right):
            for c in side[2]:
                cells.append((f"CAST({c} AS VARCHAR)" if side is this else "'-NA-'") + f' AS "{c}"')
        cells += [
            f"'{this[0]}' AS data_source", "reconciliation_outcome",
            f"CAST({this[1]} AS VARCHAR) AS \"{left[1]} <> {right[1]}\"",
        ]
        return (f"SELECT CASE WHEN reconciliation_outcome = 'FAILED' THEN 0 ELSE 1 END AS block, record, "
                f"{number} AS line, {', '.join(cells)} FROM sampled")

    return f"""
, labelled AS (
  SELECT *, CASE WHEN {carried or left[1]} = {right[1]} THEN 'PASSED' ELSE 'FAILED' END AS reconciliation_outcome FROM {joined}
), sampled AS (
  SELECT *, row_number() OVER (PARTITION BY reconciliation_outcome ORDER BY {order}) AS record
  FROM labelled
)
{line(0, left, 0, right)} UNION ALL {line(1, right, 1, left)}"""


# --- hashes ----------------------------------------------------------------------------

@query("""SELECT c_custkey, upper(sha256(concat(CAST(c_custkey AS VARCHAR), nullif(c_name, 'Customer#000000001'),
          c_mktsegment))) AS file_hash FROM customer""")
def source_row_hash(spark, folder):
    df = table(spark, folder, "customer").withColumn("c_name", F.nullif("c_name", F.lit("Customer#000000001")))
    return df.select("c_custkey", row_hash(["c_custkey", "c_name", "c_mktsegment"], nulls="empty").alias("file_hash"))


@query(f"""SELECT p_partkey, upper(sha256(CAST(p_partkey AS VARCHAR) || p_name
           || CASE WHEN p_size > 25 THEN '1' ELSE '0' END || {trimmed_decimal_sql('CAST(p_retailprice AS DECIMAL(10,2))')}
           || nullif(p_type, 'ECONOMY'))) AS staged_hash FROM part""")
def staged_row_hash(spark, folder):
    df = table(spark, folder, "part").select(
        "p_partkey", "p_name", (F.col("p_size") > 25).alias("large"), dec("p_retailprice").alias("price"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("type"))
    hashed = row_hash(["p_partkey", "p_name", "large", "price", "type"], {"large": "bool", "price": "decimal"})
    return df.select("p_partkey", hashed.alias("staged_hash"))


@query("""SELECT s_suppkey, upper(sha256(CAST(s_suppkey AS VARCHAR) || chr(31) || s_name || chr(31)
          || CAST(s_nationkey AS VARCHAR))) AS row_hash FROM supplier""")
def separated_row_hash(spark, folder):
    hashed = row_hash(["s_suppkey", "s_name", "s_nationkey"], sep="\u001f")
    return table(spark, folder, "supplier").select("s_suppkey", hashed.alias("row_hash"))


@query(ORDER_SQL + """
SELECT id, staged_hash, final_hash FROM staged JOIN final ON pre_id = id""")
def final_hash_pair(spark, folder):
    return matching.final_hashes(order_staged(spark, folder), order_final(spark, folder), ORDERS)


@query(ORDER_SQL + """
SELECT id, staged_hash, final_hash FROM staged JOIN final ON pre_id = id""")
def hash_archive(spark, folder):
    pair = matching.final_hashes(order_staged(spark, folder), order_final(spark, folder), ORDERS)
    return table_sinks.write_hash_archive(
        pair, scratch_path(spark, "hashes"), ORDERS.name, 2, "20240101.000000", ORDERS.keys,
        (names.STAGED_HASH, names.FINAL_HASH))


# --- reconciliation --------------------------------------------------------------------

@query(CUSTOMER_SQL + summary_sql("staged", "pre_file_hash", "staged_hash"))
def recon1_summary(spark, folder):
    staged = matching.with_staged_hash(customer_staged(spark, folder), CUSTOMER)
    return matching.recon_summary(staged, names.PRE_FILE_HASH, names.STAGED_HASH)


@query(CUSTOMER_SQL + """
SELECT pre_file_hash = staged_hash AS matched, count(*) AS "count" FROM staged GROUP BY 1""")
def recon1_breakdown(spark, folder):
    staged = matching.with_staged_hash(customer_staged(spark, folder), CUSTOMER)
    return matching.recon_breakdown(staged, names.PRE_FILE_HASH, names.STAGED_HASH)


@query(CUSTOMER_SQL + """
SELECT id, name, segment, file_hash, pre_id, pre_name, pre_segment, staged_hash
FROM file LEFT JOIN staged ON CAST(id AS BIGINT) = pre_id""")
def match_file_to_staged(spark, folder):
    staged = matching.with_staged_hash(customer_staged(spark, folder), CUSTOMER)
    return matching.match_file_to_staged(customer_file(spark, folder), staged, CUSTOMER).select(
        "id", "name", "segment", "file_hash", "pre_id", "pre_name", "pre_segment", "staged_hash")


@query(CUSTOMER_SQL + ", joined AS (SELECT * FROM file LEFT JOIN staged ON CAST(id AS BIGINT) = pre_id)" + detail_sql(
    "joined", [(c, f"pre_{c}") for c in ("id", "name", "nation", "balance", "segment")],
    ("data_file", "file_hash", ["file_hash"]),
    ("preliminary_table", "staged_hash", ["pre_file_hash", "pre_origin_file", "staged_hash"]), "CAST(id AS BIGINT)",
    "pre_file_hash"))
def recon1_detail(spark, folder):
    return reports.recon1_detail(customer_file(spark, folder), customer_staged(spark, folder), CUSTOMER)


@query(ITEM_SQL + summary_sql("staged", "pre_file_hash", "staged_hash"))
def recon1_items_summary(spark, folder):
    staged = matching.with_staged_hash(item_staged(spark, folder), ITEMS)
    return matching.recon_summary(staged, names.PRE_FILE_HASH, names.STAGED_HASH)


_ITEM_ORDER = (
    "CAST(order_id AS BIGINT), CAST(line AS BIGINT), CAST(part AS BIGINT), CAST(supplier AS BIGINT), "
    "file_hash, quantity, price, flag, staged_hash, pre_quantity, pre_price, pre_flag")


# Rows of a key that repeats on both sides meet by position; the shorter side starts over.
@query(ITEM_SQL + """, lefts AS (
  SELECT *, count(*) OVER k AS m, row_number() OVER (k ORDER BY file_hash, quantity, price, flag) - 1 AS i
  FROM file WINDOW k AS (PARTITION BY order_id, line, part, supplier)
), rights AS (
  SELECT *, count(*) OVER k AS n, row_number() OVER (k ORDER BY pre_file_hash, pre_quantity, pre_price, pre_flag) - 1 AS j
  FROM staged WINDOW k AS (PARTITION BY pre_order_id, pre_line, pre_part, pre_supplier)
), joined AS (
  SELECT * EXCLUDE (m, i, n, j) FROM lefts LEFT JOIN rights ON CAST(order_id AS BIGINT) = pre_order_id
    AND CAST(line AS INTEGER) = pre_line AND CAST(part AS BIGINT) = pre_part AND CAST(supplier AS BIGINT) = pre_supplier
    AND CASE WHEN m <= n THEN i = j % m ELSE j = i % n END)""" + detail_sql(
    "joined", [(c.name, f"pre_{c.name}") for c in ITEMS.columns], ("data_file", "file_hash", ["file_hash"]),
    ("preliminary_table", "staged_hash", ["pre_file_hash", "pre_origin_file", "staged_hash"]), _ITEM_ORDER,
    "pre_file_hash"))
def recon1_items_detail(spark, folder):
    return reports.recon1_detail(item_file(spark, folder), item_staged(spark, folder), ITEMS)


@query(ORDER_SQL + ", joined AS (SELECT * FROM staged JOIN final ON pre_id = id)" + summary_sql(
    "joined", "staged_hash", "final_hash"))
def recon2_summary(spark, folder):
    hashes = matching.final_hashes(order_staged(spark, folder), order_final(spark, folder), ORDERS)
    return matching.recon_summary(hashes, names.STAGED_HASH, names.FINAL_HASH)


@query(ORDER_SQL + ", joined AS (SELECT * FROM staged JOIN final ON pre_id = id)" + detail_sql(
    "joined", [(f"pre_{c.name}", c.name) for c in ORDERS.columns], ("preliminary_table", "staged_hash", []),
    ("final_table", "final_hash", []), "id"))
def recon2_detail(spark, folder):
    staged, final = order_staged(spark, folder), order_final(spark, folder)
    return reports.recon2_detail(staged, final, ORDERS)


@query(CUSTOMER_SQL + """
, sides AS (SELECT CASE WHEN id IS NULL THEN 'right_only' WHEN pre_id IS NULL THEN 'left_only' ELSE 'matched' END AS side
            FROM file FULL JOIN staged ON CAST(id AS BIGINT) = pre_id)
SELECT side, count(*) AS "count" FROM sides GROUP BY side""")
def recon_coverage(spark, folder):
    left = customer_file(spark, folder).select(F.col("id").try_cast("bigint").alias("id"))
    return matching.coverage(left, customer_staged(spark, folder), [("id", "pre_id")])


@query(CUSTOMER_SQL + """
, totals AS (SELECT count(*) AS total, count(*) FILTER (pre_file_hash = staged_hash) AS passed FROM staged)
SELECT 'STAGE 1 - [reconciliation_outcome,count][FAILED,' || (total - passed) || '][PASSED,' || passed || ']'
  AS recon_summary FROM totals""")
def recon_summary_line(spark, folder):
    return tracker.summary_line(recon1_summary(spark, folder), 1)


@query(CUSTOMER_SQL + """
SELECT segment, pre_segment, count(*) AS n FROM file JOIN staged ON CAST(id AS BIGINT) = pre_id
WHERE segment <> pre_segment GROUP BY ALL""")
def sql_over_frames(spark, folder):
    """Frames queried by SQL text."""
    return query_frames(
        spark, """SELECT segment, pre_segment, count(*) AS n FROM {file} JOIN {staged}
                  ON try_cast(id AS BIGINT) = pre_id WHERE segment <> pre_segment GROUP BY ALL""",
        file=customer_file(spark, folder), staged=customer_staged(spark, folder))


@query("""WITH changed AS (
          SELECT CASE WHEN o_orderkey % 307 = 5 THEN o_orderkey + 100000000 ELSE o_orderkey END AS o_orderkey, o_custkey,
                 CASE WHEN o_orderkey % 211 = 3 THEN 'CHANGED' ELSE o_orderpriority END AS o_orderpriority, o_totalprice, o_orderdate
          FROM orders WHERE o_orderkey % 401 <> 1
        ), gone AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, o_orderdate FROM orders EXCEPT ALL SELECT * FROM changed),
        fresh AS (SELECT * FROM changed EXCEPT ALL SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, o_orderdate FROM orders),
        counted AS (
          SELECT o_orderkey, sum(l)::BIGINT AS left_rows, sum(r)::BIGINT AS right_rows FROM (
            SELECT o_orderkey, 1 AS l, 0 AS r FROM gone UNION ALL SELECT o_orderkey, 0, 1 FROM fresh) GROUP BY o_orderkey)
        SELECT *, CASE WHEN right_rows = 0 THEN 'left_only' WHEN left_rows = 0 THEN 'right_only' ELSE 'changed' END AS kind FROM counted""")
def hash_tree_difference(spark, folder):
    """Orders against a copy with one key in a hundred changed, lost or renamed: only unequal leaves are compared row by row."""
    key = F.col("o_orderkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    copy = orders.filter(key % 401 != 1).withColumn(
        "o_orderpriority", F.when(key % 211 == 3, "CHANGED").otherwise(F.col("o_orderpriority"))).withColumn(
        "o_orderkey", F.when(key % 307 == 5, key + 100_000_000).otherwise(key))
    return table_difference(orders, copy, [("o_orderkey", "o_orderkey")], [(c, c) for c in orders.columns[1:]])


@query("""SELECT 'l_partkey' AS "column", 'part' AS parent, CAST(l_partkey AS VARCHAR) AS value FROM lineitem
          WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 50 <> 7) GROUP BY ALL
          UNION ALL SELECT 'l_suppkey', 'supplier', CAST(l_suppkey AS VARCHAR) FROM lineitem
          WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey <> 3) GROUP BY ALL
          UNION ALL SELECT 'l_orderkey', 'orders', CAST(l_orderkey AS VARCHAR) FROM lineitem
          WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 1000 <> 1) GROUP BY ALL""")
def reference_orphans(spark, folder):
    """Values of three references that have no parent, by one scan of the child."""
    parents = {
        "part": table(spark, folder, "part").filter("p_partkey % 50 <> 7"),
        "supplier": table(spark, folder, "supplier").filter("s_nationkey <> 3"),
        "orders": table(spark, folder, "orders").filter("o_orderkey % 1000 <> 1")}
    return audit.reference_orphans(table(spark, folder, "lineitem"), [
        ("l_partkey", "part", parents["part"], "p_partkey"), ("l_suppkey", "supplier", parents["supplier"], "s_suppkey"),
        ("l_orderkey", "orders", parents["orders"], "o_orderkey")])


# --- whole jobs over real folders --------------------------------------------------------

def _both_reports(spark: SparkSession, done: reconcile.ReconPaths) -> DataFrame:
    """The summary report with the lines of the detail report, both read back."""
    reader = spark.read.option("header", True).option("escape", '"')
    lines = reader.csv(done.detail).groupBy(names.OUTCOME).agg(F.count(F.lit(1)).alias("detail_lines"))
    report = reader.csv(done.summary).select(names.OUTCOME, F.col(names.COUNT).cast("bigint").alias(names.COUNT))
    return report.join(lines, names.OUTCOME, "left").fillna(0, ["detail_lines"])


_RUN_SQL = """SELECT CASE WHEN {fault} THEN 'FAILED' ELSE 'PASSED' END AS reconciliation_outcome, count(*) AS "count",
              2 * count(*) AS detail_lines FROM {table} GROUP BY 1"""


@query(_RUN_SQL.format(fault="c_nationkey IN (5, 6)", table="customer"))
def stage1_run(spark, folder):
    """Extract to a file, load it into staging, damage values and carried hashes there, reconcile, read both reports back."""
    root = scratch_path(spark, "stage1")
    path = file_sinks.extract_table(
        customer_rows(spark, folder), CUSTOMER.hash_columns, root, CUSTOMER.name, "20240101.000000")
    load.load_stage1(spark, path, CUSTOMER_FILE, CUSTOMER, f"{root}/staging")
    staged = read_staged(spark, f"{root}/staging", CUSTOMER, CUSTOMER_FILE).withColumns({
        "pre_name": F.when(F.col("pre_nation") == 5, "changed").otherwise(F.col("pre_name")),
        names.PRE_FILE_HASH: F.when(F.col("pre_nation") == 6, "damaged").otherwise(F.col(names.PRE_FILE_HASH))})
    table_sinks.reload_file(staged, table_path(f"{root}/staging", CUSTOMER.staged_name), names.PRE_ORIGIN_FILE, [CUSTOMER_FILE])
    done = reconcile.reconcile_stage1(
        spark, path, CUSTOMER_FILE, CUSTOMER, f"{root}/staging", f"{root}/reports", f"{root}/hashes")
    return _both_reports(spark, done)


@query(_RUN_SQL.format(fault="o_orderpriority = '5-LOW'", table="orders"))
def stage2_run(spark, folder):
    """Stage, load into the final table with its parents, damage values there, reconcile, and read both reports back.

    Loads that would break the final table (an unknown customer, a missing value, a stored key) are refused first.
    """
    root = scratch_path(spark, "stage2")
    rows = order_staged(spark, folder).withColumn(names.PRE_FILE_HASH, F.lit(None).cast("string"))
    staged = mapping.with_origin_file(rows, ORDER_FILE)
    spec = replace(ORDERS, foreign_keys=(ForeignKey("customer", "CUSTOMER"),))
    parents = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    parents.write.parquet(f"{root}/final/CUSTOMER")
    table_sinks.write_staged(staged, f"{root}/staging", spec)
    first = F.col("pre_id") == staged.agg(F.min("pre_id")).first()[0]
    for column, value in (("pre_customer", F.lit(-1)), ("pre_priority", F.lit(None))):
        broken = staged.withColumn(column, F.when(first, value).otherwise(F.col(column)))
        _must_refuse(lambda rows=broken: table_sinks.write_final(
            load.run_final(rows, spec, ORDER_FILE), f"{root}/final", spec))
    load.load_stage2(spark, ORDER_FILE, spec, f"{root}/staging", f"{root}/final")
    _must_refuse(lambda: table_sinks.write_final(
        load.run_final(staged.filter(first), spec, "ORDERS~2.2.csv"), f"{root}/final", spec))
    final = read_final(spark, f"{root}/final", spec, ORDER_FILE).withColumn(
        "priority", F.when(F.col("priority") == "5-LOW", "changed").otherwise(F.col("priority")))
    table_sinks.reload_file(final, table_path(f"{root}/final", spec.final_name), names.ORIGIN_FILE, [ORDER_FILE])
    done = reconcile.reconcile_stage2(
        spark, ORDER_FILE, spec, f"{root}/staging", f"{root}/final", f"{root}/reports", f"{root}/hashes")
    return _both_reports(spark, done)


def _must_refuse(write: Callable[[], None]) -> None:
    try:
        write()
    except ValueError:
        return
    raise AssertionError("a load that breaks the final table was not refused")


@query("""SELECT c_custkey AS id, c_name AS title, upper(sha256(CAST(c_custkey AS VARCHAR) || c_name)) AS final_hash FROM customer""")
def configured_run(spark, folder):
    """Both stages by a configuration that renames tables and columns, the key among them."""
    spec = specs_from_config({"tables": {"CUSTOMER": {
        "prelim_name": "STAGED_CUSTOMERS", "final_name": "CUSTOMERS",
        "mappings_prelim": [["number", "string", "cust_no", "string"], ["name", "string", "cust_name", "string"]],
        "mappings_final": [["cust_no", "bigint", "id", "bigint"], ["cust_name", "string", "title", "string"]],
        "primary_keys": ["id"], "pre_exclude_from_hash": False}}})["CUSTOMER"]
    root = scratch_path(spark, "configured")
    rows = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("number"), F.col("c_name").alias("name"))
    path = file_sinks.extract_table(rows, ["number", "name"], root, "CUSTOMER", "20240101.000000")
    load.load_stage1(spark, path, CUSTOMER_FILE, spec, f"{root}/staging")
    load.load_stage2(spark, CUSTOMER_FILE, spec, f"{root}/staging", f"{root}/final")
    final = read_final(spark, f"{root}/final", spec, CUSTOMER_FILE)
    return matching.with_mapped_hash(final, ["id", "title"], names.FINAL_HASH).select("id", "title", names.FINAL_HASH)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment,
          upper(sha256(concat(CAST(c_custkey AS VARCHAR), c_name, c_mktsegment))) AS file_hash FROM customer""")
def extract_roundtrip(spark, folder):
    rows = customer_rows(spark, folder).select("id", "name", "segment")
    path = file_sinks.extract_table(
        rows, ["id", "name", "segment"], scratch_path(spark, "extract"), "CUSTOMER", "20240101.000000")
    return file_sources.read_flat_file(spark, path)


@query("""SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING' ELSE 'OTHER' END AS origin, count(*) AS "rows"
          FROM customer GROUP BY 1""")
def extract_counts(spark, folder):
    origin = F.when(F.col("segment") == "BUILDING", "BUILDING").otherwise("OTHER")
    return file_sinks.extract_counts(customer_rows(spark, folder).withColumn("origin", origin), "origin")


@query("SELECT doc_id, text, lang, source FROM documents")
def flat_file_scan(spark, folder):
    """Whole texts with commas, quotes and line breaks through a delimited file and back."""
    path = scratch_path(spark, "documents")
    rows = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    rows.write.options(**file_sinks.WRITE_OPTIONS).csv(path)
    back = file_sources.read_flat_file(spark, path, rows.columns, multi_line=True)
    return back.withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query("SELECT doc_id, text, lang, source FROM documents")
def quoted_file_scan(spark, folder):
    """The same through large files that many tasks read each: blocks are cut at true record ends."""
    path = scratch_path(spark, "quoted")
    rows = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    file_sinks.write_large_files(rows, path)
    back = read_quoted_file(spark, path, rows.columns)
    return back.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _in_file_order(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Records of a dataset with their places in it: part files by name, then as in the file."""
    rows = file_sources.read_flat_file(spark, path, columns, multi_line=True).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    return numbering.number_rows(rows, ["_file", "_row"], start=1, name="place", tie_break=()).drop("_file", "_row")


@query("""SELECT *, row_number() OVER (ORDER BY source, p_partkey) AS place FROM (
            SELECT 1 AS source, p_partkey, p_name, p_brand FROM part
            UNION ALL SELECT 0, s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) FROM supplier)""")
def merge_csv(spark, folder):
    root = scratch_path(spark, "merge")
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("p_name"),
        F.col("s_nationkey").cast("string").alias("p_brand"))
    for source, name in ((part, "first"), (supplier, "second")):
        source.orderBy("p_partkey").write.options(**file_sinks.WRITE_OPTIONS).csv(f"{root}/{name}")
    merged = file_sources.merge_csv_files(spark, [f"{root}/second", f"{root}/first"])
    file_sinks.write_merged(merged, f"{root}/merged")
    back = _in_file_order(spark, f"{root}/merged", part.columns)
    source = F.when(F.col("p_name").startswith("Supplier"), 0).otherwise(1)
    return back.select(source.alias("source"), F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_brand", "place")


@query("SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS place FROM documents")
def compact_roundtrip(spark, folder):
    """Texts with line breaks and quotes: whole, and in the order of the many files."""
    root = scratch_path(spark, "compact")
    rows = table(spark, folder, "documents").select("doc_id", "text")
    rows.repartitionByRange(input_slots(rows, least=16), "doc_id").sortWithinPartitions("doc_id").write.options(**file_sinks.WRITE_OPTIONS).csv(f"{root}/many")
    file_sinks.compact_dataset(spark, f"{root}/many", f"{root}/few", target_files=3)
    return _in_file_order(spark, f"{root}/few", rows.columns).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query("SELECT doc_id, text, lang FROM documents")
def archive_roundtrip(spark, folder):
    """Texts with line breaks and quotes; the source goes only once the copy holds the same."""
    root = scratch_path(spark, "archive")
    rows = table(spark, folder, "documents").select("doc_id", "text", "lang")
    rows.write.options(**file_sinks.WRITE_OPTIONS).csv(f"{root}/plain")
    file_sinks.archive_dataset(spark, f"{root}/plain", f"{root}/packed", drop_source=True)
    back = file_sources.read_flat_file(spark, f"{root}/packed", rows.columns, multi_line=True)
    return back.withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query("""SELECT 'o_year=' || year(o_orderdate) AS part_folder, CAST(1 AS BIGINT) AS files, true AS has_bytes
          FROM orders GROUP BY year(o_orderdate)""")
def file_manifest(spark, folder):
    path = scratch_path(spark, "manifest")
    rows = table(spark, folder, "orders").withColumn("o_year", F.year("o_orderdate"))
    rows.repartition("o_year").write.partitionBy("o_year").parquet(path)
    listed = file_sources.file_manifest(spark, path, prefix="part-")
    parent = F.element_at(F.split("path", "/"), -2)
    return listed.groupBy(parent.alias("part_folder")).agg(
        F.count(F.lit(1)).alias("files"), (F.min("length") > 0).alias("has_bytes"))


_YEAR_FILE = "'ORDERS~' || year(o_orderdate) || '.1.csv'"


def _orders_by_year(spark, folder) -> DataFrame:
    year = F.year("o_orderdate").cast("string")
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.concat(F.lit("ORDERS~"), year, F.lit(".1.csv")).alias(names.PRE_ORIGIN_FILE))


@query(f"""SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1996 THEN 'R' ELSE o_orderstatus END AS o_orderstatus,
           {_YEAR_FILE} AS pre_origin_file FROM orders""")
def reload_file(spark, folder):
    path = scratch_path(spark, "reload")
    rows = _orders_by_year(spark, folder)
    rows.write.partitionBy(names.PRE_ORIGIN_FILE).parquet(path)
    again = rows.filter(F.col(names.PRE_ORIGIN_FILE) == "ORDERS~1996.1.csv").withColumn("o_orderstatus", F.lit("R"))
    table_sinks.reload_file(again, path, names.PRE_ORIGIN_FILE)
    return snapshots.read(spark, path)


@query(f"""SELECT o_orderkey, o_orderstatus, {_YEAR_FILE} AS pre_origin_file FROM orders
           WHERE year(o_orderdate) NOT IN (1996, 1997)""")
def reload_nothing(spark, folder):
    """One file reloaded with no rows, one deleted: neither leaves any."""
    path = scratch_path(spark, "reload")
    rows = _orders_by_year(spark, folder)
    rows.write.partitionBy(names.PRE_ORIGIN_FILE).parquet(path)
    table_sinks.reload_file(rows.filter("false"), path, names.PRE_ORIGIN_FILE, ["ORDERS~1996.1.csv"])
    table_sinks.delete_file(spark, path, "ORDERS~1997.1.csv")
    return snapshots.read(spark, path)


@query(f"""SELECT o_orderkey, o_orderstatus, {_YEAR_FILE} AS pre_origin_file FROM orders
           WHERE year(o_orderdate) <> 1996""")
def delete_by_file(spark, folder):
    return table_sinks.delete_by_file(_orders_by_year(spark, folder), "ORDERS~1996.1.csv")


@query("""SELECT o_orderkey AS pre_id, o_custkey AS pre_customer FROM orders WHERE year(o_orderdate) = 1997""")
def staged_scan(spark, folder):
    """The staged rows of one file: only its partition is opened."""
    root = scratch_path(spark, "staged")
    year = F.year("pre_ordered_at").cast("string")
    rows = order_staged(spark, folder).withColumns({
        names.PRE_FILE_HASH: F.lit(None).cast("string"),
        names.PRE_ORIGIN_FILE: F.concat(F.lit("ORDERS~"), year, F.lit(".1.csv"))})
    table_sinks.write_staged(rows, root, ORDERS)
    return read_staged(spark, root, ORDERS, "ORDERS~1997.1.csv").select("pre_id", "pre_customer")


@query("""SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE year(o_orderdate) = 1997""")
def final_scan(spark, folder):
    root = scratch_path(spark, "final")
    rows = mapping.apply_mapping(order_staged(spark, folder), ORDERS.final_mappings)
    labelled = rows.withColumn(
        names.ORIGIN_FILE, F.concat(F.lit("ORDERS~"), F.year("ordered_at").cast("string"), F.lit(".1.csv")))
    table_sinks.write_final(labelled, root, ORDERS)
    return read_final(spark, root, ORDERS, "ORDERS~1997.1.csv").select("id", "status")


# --- mapping and cleaning ----------------------------------------------------------------

@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS pre_id, CAST(o_custkey AS VARCHAR) AS pre_customer,
           o_orderpriority AS pre_priority, upper(sha256(CAST(o_orderkey AS VARCHAR) || o_orderpriority))
           AS pre_file_hash, '{ORDER_FILE}' AS pre_origin_file FROM orders""")
def map_to_staging(spark, folder):
    spec = TableSpec("ORDERS", (Column("id", "bigint"), Column("customer", "bigint"), Column("priority", "string")))
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("not_mapped"))
    hashed = rows.withColumn(names.FILE_HASH, row_hash(["id", "priority"], nulls="empty"))
    return load.run_staging(hashed, spec, ORDER_FILE)


@query(f"""SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status,
           CAST(o_totalprice AS DECIMAL(12,2)) AS total, CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS ordered_at,
           o_orderpriority AS priority, '{ORDER_FILE}' AS origin_file FROM orders""")
def map_to_final(spark, folder):
    staged = mapping.stringify(order_staged(spark, folder))
    final = load.run_final(staged, ORDERS, ORDER_FILE)
    return final.withColumn("ordered_at", F.col("ordered_at").cast("string"))


@query("""SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'abc' ELSE CAST(o_custkey AS VARCHAR) END
          AS BIGINT) AS customer FROM orders""")
def coerce_declared(spark, folder):
    customer = F.when(F.col("o_orderstatus") == "P", "abc").otherwise(F.col("o_custkey").cast("string"))
    rows = table(spark, folder, "orders").select("o_orderkey", customer.alias("customer"))
    return mapping.coerce_declared(rows, [Column("customer", "bigint")])


@query("SELECT c_custkey AS pre_c_custkey, c_name AS pre_c_name, c_mktsegment AS pre_c_mktsegment FROM customer")
def add_prefix(spark, folder):
    return mapping.add_prefix(table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"))


@query("SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS telephone, CAST(NULL AS VARCHAR) AS email FROM supplier")
def cast_voids(spark, folder):
    rows = table(spark, folder, "supplier").select(
        "s_suppkey", "s_name", F.lit(None).alias("telephone"), F.lit(None).alias("email"))
    return mapping.cast_voids(rows)


@query("SELECT s_name, 'yes' AS active, s_suppkey, 1 AS version FROM supplier")
def conform_columns(spark, folder):
    rows = table(spark, folder, "supplier")
    return mapping.conform_columns(rows, ["s_name", "active", "s_suppkey", "version"], {"active": "yes", "version": 1})


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS total,
          CAST(o_orderdate AS VARCHAR) AS o_orderdate, CAST(o_totalprice > 100000 AS VARCHAR) AS large FROM orders""")
def stringify(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", dec("o_totalprice", "decimal(12,2)").alias("total"), "o_orderdate",
        (F.col("o_totalprice") > 100000).alias("large"))
    return mapping.stringify(rows)


@query("""SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN '1' WHEN p_brand = 'Brand#2' THEN NULL ELSE p_type END
          AS type, CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE p_brand END AS brand FROM part""")
def clean_blanks(spark, folder):
    blank_type = F.when(F.col("p_type") == "ECONOMY", "").when(F.col("p_brand") != "Brand#2", F.col("p_type"))
    rows = table(spark, folder, "part").select(
        "p_partkey", blank_type.alias("type"),
        F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_brand")).alias("brand"))
    return cleaning.blank_to_null(cleaning.blank_to_default(rows, {"type": "1"}), ["brand"])


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1900-01-01 00:00:00'
          ELSE CAST(o_orderdate AS TIMESTAMP) + INTERVAL 8 HOUR END AS at FROM orders""")
def clean_times(spark, folder):
    """ISO texts, some unreadable, shifted by eight hours, and a constant for the unreadable."""
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "").otherwise(iso).alias("at"))
    shifted = cleaning.parse_and_shift(rows, ["at"], hours=8)
    return cleaning.null_to_default(shifted, {"at": "1900-01-01 00:00:00"})


@query("SELECT event_id, upper(event_type) || '-' || user_id AS label FROM events")
def derive_column(spark, folder):
    rows = cleaning.derive(table(spark, folder, "events"), "label", "concat(upper(event_type), '-', user_id)")
    return rows.select("event_id", "label")


@query("""SELECT event_id, strftime(ts, '%d/%m/%Y %H-%M-%S %y %j %a %A %b %B %I %p %f %%')
          || strftime(ts, ' %H:%M:%S %Y') AS at FROM events""")
def format_times(spark, folder):
    return table(spark, folder, "events").select("event_id", times.format_ts(
        F.col("ts"), "%d/%m/%Y %H-%M-%S %y %j %a %A %b %B %I %p %f %% %X %G").alias("at"))


@query("SELECT event_id, CAST(ts AS TIMESTAMP) + INTERVAL 8 HOUR AS local_ts FROM events")
def local_time(spark, folder):
    return table(spark, folder, "events").select("event_id", times.to_local_time(F.col("ts")).alias("local_ts"))


@query("SELECT s_suppkey, CAST(year(current_date) AS VARCHAR) AS loaded_in FROM supplier")
def with_now(spark, folder):
    return cleaning.with_now(table(spark, folder, "supplier").select("s_suppkey"), "loaded_in", "%Y")


@query("SELECT 36 AS uuid_length, count(*) AS ids, count(*) AS different FROM lineitem")
def with_uuid(spark, folder):
    """The ids are random, so only their form and that no two are equal can be compared."""
    ids = pin(cleaning.with_uuid(table(spark, folder, "lineitem").select("l_orderkey"), "row_uuid"), "ids")
    return ids.groupBy(F.length("row_uuid").alias("uuid_length")).agg(
        F.count(F.lit(1)).alias("ids"), F.count_distinct("row_uuid").alias("different"))


@query("""WITH lists AS (SELECT doc_id, string_split(text, ',') AS parts FROM documents),
     items AS (SELECT doc_id, i, nullif(trim(parts[i], ' '), '') AS item
               FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM lists))
SELECT doc_id, item, CAST(row_number() OVER (ORDER BY doc_id, i) - 1 AS BIGINT) AS id FROM items""")
def explode_list(spark, folder):
    return cleaning.explode_list(table(spark, folder, "documents"), "doc_id", "text", "doc_id", "item", "id")


# --- audits ------------------------------------------------------------------------------

@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
          WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 45)""")
def fk_orphans(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return audit.fk_orphans(items, table(spark, folder, "part").filter("p_size <= 45"), "l_partkey", "p_partkey")


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN p_partkey IS NULL THEN 0 ELSE l_partkey END AS l_partkey
          FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 45) p ON p_partkey = l_partkey""")
def fk_repair(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return audit.fk_repair(items, table(spark, folder, "part").filter("p_size <= 45"), "l_partkey", "p_partkey")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem
          GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def pk_duplicates(spark, folder):
    return audit.pk_duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


_AUDITED = (
    Column("id", "int"), Column("name", "string", True, 17), Column("nation", "int", False),
    Column("balance", "decimal(5,2)"),
)


@query("""WITH rows_in AS (
  SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS id, c_name AS name,
         CASE WHEN c_nationkey = 3 THEN 'abc' ELSE CAST(c_nationkey AS VARCHAR) END AS nation,
         CASE WHEN c_nationkey = 4 THEN 'n/a' ELSE CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS VARCHAR) END AS balance
  FROM customer)
SELECT 'not_null' AS rule, 'id' AS "column", count(*) FILTER (id IS NULL) AS violations FROM rows_in
UNION ALL SELECT 'castable', 'id', 0 FROM rows_in HAVING true
UNION ALL SELECT 'not_null', 'name', count(*) FILTER (name IS NULL) FROM rows_in
UNION ALL SELECT 'length', 'name', count(*) FILTER (length(name) > 17) FROM rows_in
UNION ALL SELECT 'castable', 'nation', count(*) FILTER (nation = 'abc') FROM rows_in
UNION ALL SELECT 'not_null', 'balance', count(*) FILTER (balance IS NULL) FROM rows_in
UNION ALL SELECT 'castable', 'balance', count(*) FILTER (balance = 'n/a') FROM rows_in
UNION ALL SELECT 'range', 'balance', count(*) FILTER (abs(TRY_CAST(balance AS DECIMAL(18,2))) >= 1000) FROM rows_in""")
def constraint_audit(spark, folder):
    nation = F.col("c_nationkey")
    rows = table(spark, folder, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("name"),
        F.when(nation == 3, "abc").otherwise(nation.cast("string")).alias("nation"),
        F.when(nation == 4, "n/a").otherwise(dec("c_acctbal").cast("string")).alias("balance"))
    return audit.constraint_audit(rows, _AUDITED)


@query("SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey <> 0")
def distinct_keys(spark, folder):
    return audit.distinct_keys(table(spark, folder, "lineitem"), "l_suppkey")


# --- numbering ---------------------------------------------------------------------------

@query("""SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS o_orderkey,
          o_orderkey AS old_o_orderkey, o_custkey FROM orders""")
def renumber_rows(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return numbering.renumber(rows, "o_orderkey", ["o_orderdate"]).drop("o_orderdate")


@query("""WITH renumbered AS (SELECT o_orderkey AS old_key,
            CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS new_key FROM orders)
SELECT new_key AS l_orderkey, l_linenumber, l_partkey FROM lineitem LEFT JOIN renumbered ON l_orderkey = old_key""")
def remap_keys(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    keys = numbering.key_map(numbering.renumber(orders, "o_orderkey", ["o_orderdate"]), "o_orderkey")
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return numbering.remap_fk(items, keys, "l_orderkey")


@query("""WITH parents AS (SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS new_key FROM customer)
SELECT CAST(row_number() OVER (ORDER BY new_key, o_orderkey) AS BIGINT) AS o_orderkey,
       CAST(dense_rank() OVER (ORDER BY new_key) AS BIGINT) AS o_custkey, o_totalprice, o_orderkey AS old_o_orderkey
FROM orders JOIN parents ON o_custkey = c_custkey""")
def reorder_children(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    keys = numbering.key_map(numbering.renumber(customers, "c_custkey", ["c_name"]), "c_custkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return numbering.reorder_children(orders, keys, "o_custkey", "o_orderkey")


@query("""WITH firsts AS (SELECT o_custkey, min((o_orderdate, o_orderkey)) AS f FROM orders GROUP BY o_custkey),
     numbered AS (SELECT o_custkey, CAST(row_number() OVER (ORDER BY f) AS BIGINT) AS group_id FROM firsts)
SELECT o_orderkey, o_custkey, group_id FROM orders JOIN numbered USING (o_custkey)""")
def number_groups(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return numbering.number_groups(rows, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""SELECT CAST(row_number() OVER (ORDER BY md5('7:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS BIGINT)
          AS o_orderkey, o_orderkey AS old_o_orderkey, o_custkey FROM orders""")
def shuffle_rows(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return numbering.shuffle_rows(rows, "o_orderkey", 7, name="o_orderkey")


# --- prices and points -------------------------------------------------------------------

@query("""SELECT l_orderkey, CAST(sum(floor(CAST(p_retailprice AS DECIMAL(10,2))
            * (1 - CAST(l_discount AS DECIMAL(4,2))) * CAST(l_quantity AS INTEGER) * 100) / 100) AS DECIMAL(18,2)) AS total
          FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""")
def order_totals(spark, folder):
    items = ledger.price_items(
        table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_discount", "l_quantity"),
        table(spark, folder, "part"), "l_partkey", "p_partkey", "p_retailprice")
    price = dec("p_retailprice") * (F.lit(1) - dec("l_discount", "decimal(4,2)"))
    return ledger.order_totals(items, "l_orderkey", price, F.col("l_quantity").cast("int"))


@query("""SELECT band, count(*) AS n FROM (
  SELECT CASE WHEN price <= 10 THEN 'low' WHEN price <= 25 THEN 'medium' WHEN price <= 50 THEN 'high'
         ELSE 'very_high' END AS band
  FROM (SELECT CAST(CAST(l_extendedprice AS DECIMAL(12,2)) / 1000 AS DECIMAL(10,2)) AS price FROM lineitem))
GROUP BY band""")
def price_band(spark, folder):
    price = (dec("l_extendedprice", "decimal(12,2)") / F.lit(1000)).cast("decimal(10,2)")
    return table(spark, folder, "lineitem").groupBy(money.price_band(price).alias("band")).agg(
        F.count(F.lit(1)).alias("n"))


def _orders_with_points(spark, folder) -> DataFrame:
    """Orders of members (all but one market segment) with points gained; urgent orders spend points."""
    card = F.when(F.col("c_mktsegment") == "BUILDING", money.NO_CARD).otherwise(F.col("c_name"))
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
        dec("o_totalprice", "decimal(12,2)").alias("total"))
    customers = table(spark, folder, "customer").select("c_custkey", card.alias("card"))
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    member = money.is_member(F.col("card"))
    return joined.select(
        "o_orderkey", "o_custkey", "o_orderdate", "total",
        money.reward_points(member, F.col("total")).alias("gained"),
        (member & (F.col("o_orderpriority") == "1-URGENT")).alias("spends"))


_POINTS_SQL = """
WITH priced AS (
  SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(12,2)) AS total,
         coalesce(c_mktsegment <> 'BUILDING', false) AS member, o_orderpriority = '1-URGENT' AS urgent
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
), points AS (
  SELECT *, CASE WHEN member THEN CAST(floor(total * 10) / 100 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS gained,
         member AND urgent AS spends
  FROM priced
)"""


@query(_POINTS_SQL + " SELECT o_orderkey, gained FROM points")
def reward_points(spark, folder):
    return _orders_with_points(spark, folder).select("o_orderkey", "gained")


@query(_POINTS_SQL + """
SELECT o_orderkey, CAST(least(gained * 20, total) AS DECIMAL(18,2)) AS cap FROM points""")
def spend_cap(spark, folder):
    rows = _orders_with_points(spark, folder)
    return rows.select("o_orderkey", money.spend_cap(F.col("gained") * F.lit(20), F.col("total")).alias("cap"))


@query(_POINTS_SQL + """
SELECT o_orderkey, o_custkey, CAST(sum(gained - CASE WHEN spends THEN CAST(5 AS DECIMAL(18,2)) ELSE 0 END) OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DECIMAL(18,2)) AS balance FROM points""")
def points_ledger(spark, folder):
    rows = _orders_with_points(spark, folder).withColumn(
        "used", F.when(F.col("spends"), F.lit(5)).otherwise(F.lit(0)).cast(money.MONEY))
    return ledger.points_ledger(rows, "o_custkey", ["o_orderdate", "o_orderkey"], "gained", "used").select(
        "o_orderkey", "o_custkey", "balance")


_SPENDING_SQL = _POINTS_SQL + """
, ordered AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM points),
walked AS (
  SELECT o_custkey, list(o_orderkey ORDER BY n) AS keys,
         list({'g': gained, 't': total, 's': spends, 'u': CAST(0 AS DECIMAL(18,2)), 'b': CAST(0 AS DECIMAL(18,2))}
              ORDER BY n) AS steps
  FROM ordered GROUP BY o_custkey
), balances AS (
  SELECT o_custkey, keys, list_reduce(
    list_transform(steps, lambda x: [x]),
    lambda acc, x: list_concat(acc, [{
      'g': x[1].g, 't': x[1].t, 's': x[1].s,
      'u': CAST(CASE WHEN x[1].s THEN least(acc[-1].b + x[1].g, x[1].t) ELSE 0 END AS DECIMAL(18,2)),
      'b': CAST(acc[-1].b + x[1].g - CASE WHEN x[1].s THEN least(acc[-1].b + x[1].g, x[1].t) ELSE 0 END AS DECIMAL(18,2))}]),
    [{'g': CAST(0 AS DECIMAL(18,2)), 't': CAST(0 AS DECIMAL(12,2)), 's': false, 'u': CAST(0 AS DECIMAL(18,2)),
      'b': CAST(0 AS DECIMAL(18,2))}]) AS walk
  FROM walked
)
SELECT keys[i] AS o_orderkey, walk[i + 1].u AS points_used, walk[i + 1].b AS balance
FROM (SELECT keys, walk, unnest(range(1, len(keys) + 1)) AS i FROM balances)"""


@query(_SPENDING_SQL)
def points_spending(spark, folder):
    rows = _orders_with_points(spark, folder)
    spent = ledger.spend_points(rows, "o_custkey", ["o_orderdate", "o_orderkey"], "gained", "total", "spends")
    return spent.select("o_orderkey", "points_used", "balance")


@query(_SPENDING_SQL)
def points_spending_continued(spark, folder):
    """The same in two files: the second starts from the state the first left, and reopens customers with late rows."""
    rows, order = _orders_with_points(spark, folder), ["o_orderdate", "o_orderkey"]
    early = (F.year("o_orderdate") < 1997) & (F.col("o_orderkey") % 50 != 3)
    columns, args = ["o_custkey", "o_orderkey", "points_used", "balance"], ("o_custkey", order, "gained", "total", "spends")
    none = rows.limit(0)
    first = ledger.continue_spending(rows.filter(early), none, ledger.empty_state(rows, "o_custkey", order), *args)
    second = ledger.continue_spending(rows.filter(~early), rows.filter(early), first.state, *args)
    whole = ledger.taken_up(first.rows.select(*columns), replace(second, rows=second.rows.select(*columns)), "o_custkey")
    return whole.drop("o_custkey")


@query(_POINTS_SQL + """
SELECT c_custkey, CAST(coalesce(points, 0) AS DECIMAL(18,2)) AS points FROM customer LEFT JOIN (
  SELECT o_custkey, sum(gained - CASE WHEN spends THEN CAST(5 AS DECIMAL(18,2)) ELSE 0 END) AS points
  FROM points GROUP BY o_custkey) ON c_custkey = o_custkey""")
def customer_balance(spark, folder):
    rows = _orders_with_points(spark, folder).withColumn(
        "used", F.when(F.col("spends"), F.lit(5)).otherwise(F.lit(0)).cast(money.MONEY))
    customers = table(spark, folder, "customer").select("c_custkey")
    return ledger.customer_balance(customers, rows, "c_custkey", "o_custkey", "gained", "used")


# --- tracker -----------------------------------------------------------------------------

def _status_log(spark, folder) -> DataFrame:
    """Events read as a status log: user as file, event type as table, low values without a summary."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("F~"), F.col("user_id")).alias("file_name"),
        F.col("event_type").alias("executing_for_table"),
        F.concat(F.lit("STATUS "), F.col("props")).alias("mig_sts"),
        F.when(F.col("value") >= 20, F.concat(F.lit("SUMMARY "), F.col("event_id"))).alias("recon_summary"),
        "ts", "event_id",
    )


_STATUS_SQL = """
WITH log AS (SELECT 'F~' || user_id AS file_name, event_type AS executing_for_table, 'STATUS ' || props AS mig_sts,
  CASE WHEN value >= 20 THEN 'SUMMARY ' || event_id END AS recon_summary, ts, event_id FROM events),
latest AS (SELECT file_name, executing_for_table, arg_max(mig_sts, (ts, event_id)) AS mig_sts,
  arg_max(recon_summary, (ts, event_id)) FILTER (recon_summary IS NOT NULL) AS recon_summary,
  arg_max(event_id, (ts, event_id)) AS event_id
  FROM log GROUP BY file_name, executing_for_table)"""


def _tracked(spark, folder) -> DataFrame:
    log = _status_log(spark, folder)
    noon = F.lit("2024-01-01 12:00:00").cast("timestamp")
    before, after = log.filter(F.col("ts") < noon), log.filter(F.col("ts") >= noon)
    keep = {"keys": tracker.TRACKER_KEYS, "order": ["ts", "event_id"], "keep_when_null": ["recon_summary"]}
    current = tracker.upsert_latest(before.limit(0), before, **keep)
    return tracker.upsert_latest(current, after, **keep)


@query(_STATUS_SQL + " SELECT * FROM latest")
def tracker_upsert(spark, folder):
    return _tracked(spark, folder).drop("ts")


@query(_STATUS_SQL + " SELECT * FROM latest")
def tracker_stored(spark, folder):
    """The same as a stored table: the second upsert rewrites only the buckets that its changes fall into."""
    log, path = _status_log(spark, folder), scratch_path(spark, "tracker")
    noon = F.lit("2024-01-01 12:00:00").cast("timestamp")
    for changes in (log.filter(F.col("ts") < noon), log.filter(F.col("ts") >= noon)):
        table_sinks.upsert_stored(changes, path, tracker.TRACKER_KEYS, ["ts", "event_id"], ["recon_summary"], buckets=16)
    return table_sinks.read_stored(spark, path).drop("ts")


@query(_STATUS_SQL + """ SELECT file_name, mig_sts FROM latest WHERE executing_for_table = 'error'""")
def tracker_poll(spark, folder):
    return tracker.poll_status(
        _tracked(spark, folder), "file_name, mig_sts, no_such_column", executing_for_table="error", nothing="x")


def _file_names(spark, folder) -> DataFrame:
    """One file name per order, those of one status breaking the naming rule."""
    stamp = F.date_format("o_orderdate", "yyyyMMdd.HHmmss")
    good = F.concat(F.lit("PRODUCT_DETAILS~"), stamp, F.lit(".csv"))
    by_status = (
        F.when(F.col("o_orderstatus") == "O", good)
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("PRODUCT_BRAND~"), stamp, F.lit(".txt")))
        .otherwise(F.concat(F.lit("ORDERS2~X~"), stamp, F.lit(".csv"))))
    return table(spark, folder, "orders").select("o_orderkey", by_status.alias("file_name"))


_FILE_NAMES_SQL = r"""
WITH named AS (SELECT o_orderkey, CASE o_orderstatus
    WHEN 'O' THEN 'PRODUCT_DETAILS~' || strftime(o_orderdate, '%Y%m%d.%H%M%S') || '.csv'
    WHEN 'F' THEN 'PRODUCT_BRAND~' || strftime(o_orderdate, '%Y%m%d.%H%M%S') || '.txt'
    ELSE 'ORDERS2~X~' || strftime(o_orderdate, '%Y%m%d.%H%M%S') || '.csv' END AS file_name FROM orders),
parsed AS (SELECT *, nullif(regexp_extract(file_name, '^([^~]*)~(\d+\.\d+)\.[^.]+$', 1), '') AS table_name,
    nullif(regexp_extract(file_name, '^([^~]*)~(\d+\.\d+)\.[^.]+$', 2), '') AS file_datetime,
    regexp_full_match(file_name, '[a-zA-Z_]+~\d+\.\d+\.[a-zA-Z0-9]*') AS is_valid FROM named)"""


@query(_FILE_NAMES_SQL + " SELECT * FROM parsed")
def parse_file_names(spark, folder):
    return tracker.parse_file_name(_file_names(spark, folder))


@query(_FILE_NAMES_SQL + """
SELECT o_orderkey, table_name, table_name AS target_table FROM parsed WHERE table_name IS NOT NULL
UNION ALL SELECT o_orderkey, table_name, 'PRODUCT_SECONDARY_CATEGORY' FROM parsed WHERE table_name = 'PRODUCT_DETAILS'""")
def route_files(spark, folder):
    from stagecheck.plans.tables import ROUTING
    parsed = tracker.parse_file_name(_file_names(spark, folder)).select("o_orderkey", "table_name")
    return tracker.route_files(parsed, ROUTING)


@query(_FILE_NAMES_SQL + """
SELECT o_orderkey, table_name FROM parsed WHERE table_name IS DISTINCT FROM 'PRODUCT_DETAILS'""")
def rejected_requests(spark, folder):
    from stagecheck.plans.tables import ROUTING
    parsed = tracker.parse_file_name(_file_names(spark, folder)).select("o_orderkey", "table_name")
    wanted = parsed.withColumn("target_table", F.lit("PRODUCT_SECONDARY_CATEGORY"))
    return tracker.rejected_requests(wanted, ROUTING).drop("target_table")


@query(_FILE_NAMES_SQL + r"""
SELECT o_orderkey, regexp_replace(file_name, '\.[^.]+$', '') || '_STAGE1_RECON1.csv' AS report FROM named""")
def report_names(spark, folder):
    return _file_names(spark, folder).select(
        "o_orderkey", text.report_name(F.col("file_name"), F.lit(1), F.lit("RECON1")).alias("report"))


_CAUSES_SQL = r"""
WITH kinds AS (SELECT event_id, user_id, value, CASE event_type WHEN 'error' THEN 'Exception'
    WHEN 'click' THEN 'States.TaskFailed' WHEN 'view' THEN 'Lambda.Unknown'
    WHEN 'purchase' THEN 'Lambda.AWSLambdaException' ELSE 'Other' END AS error_type FROM events),
causes AS (SELECT *, CASE error_type
    WHEN 'Exception' THEN '{"errorMessage": "{\"error_type\": \"E' || user_id || '\", \"exception_cause\": \"event '
        || event_id || '\", \"lambda_name\": \"loader\"}"}'
    WHEN 'States.TaskFailed' THEN CASE WHEN value < 10 THEN '{"JobName": "job' || user_id || '"}'
        ELSE '{"ERRORMESSAGE": "event ' || event_id || '", "jobname": "job' || user_id || '"}' END
    WHEN 'Lambda.Unknown' THEN 'Run failed. Returned payload: {"errorMessage": "event ' || event_id || '"}'
    ELSE '{"errorMessage": "event ' || event_id || '"}' END AS cause FROM kinds)"""


@query(_CAUSES_SQL + r"""
, parsed AS (SELECT event_id, error_type <> 'Other' AS is_handled,
    CASE error_type WHEN 'Exception' THEN json_extract_string(json_extract_string(cause, '$.errorMessage'), '$.error_type')
      WHEN 'States.TaskFailed' THEN 'Glue Runtime Error' ELSE error_type END AS error_kind,
    CASE error_type WHEN 'Exception'
        THEN json_extract_string(json_extract_string(cause, '$.errorMessage'), '$.exception_cause')
      WHEN 'States.TaskFailed' THEN coalesce(json_extract_string(cause, '$.ERRORMESSAGE'), '<UNKNOWN>')
      WHEN 'Lambda.Unknown' THEN json_extract_string(string_split(cause, 'Returned payload: ')[2], '$.errorMessage')
      ELSE json_extract_string(cause, '$.errorMessage') END AS error_cause,
    CASE error_type WHEN 'Exception' THEN json_extract_string(json_extract_string(cause, '$.errorMessage'), '$.lambda_name')
      WHEN 'States.TaskFailed' THEN coalesce(json_extract_string(cause, '$.JobName'), json_extract_string(cause, '$.jobname'))
      ELSE '<UNKNOWN>' END AS job_name
  FROM causes)
SELECT *, 'STAGE 1 ERROR' AS mig_sts, 'Stage 1 data pipeline for file F is failing at job ' || job_name
  || ' with error:' || chr(10) || '[' || error_kind || '] ' || error_cause || '.' || chr(10) || chr(10)
  || 'If any fields are specified as "UNKNOWN", check step function execution directly, as specific details '
  || 'cannot be obtained due to Step Function limitations.' AS error_msg FROM parsed""")
def parse_errors(spark, folder):
    kind = F.col("event_type")
    event, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    error_type = (
        F.when(kind == "error", "Exception").when(kind == "click", "States.TaskFailed")
        .when(kind == "view", "Lambda.Unknown").when(kind == "purchase", "Lambda.AWSLambdaException").otherwise("Other"))
    managed = F.format_string(
        r'{"errorMessage": "{\"error_type\": \"E%s\", \"exception_cause\": \"event %s\", \"lambda_name\": \"loader\"}"}',
        user, event)
    failed_job = F.when(F.col("value") < 10, F.format_string('{"JobName": "job%s"}', user)).otherwise(
        F.format_string('{"ERRORMESSAGE": "event %s", "jobname": "job%s"}', event, user))
    plain = F.format_string('{"errorMessage": "event %s"}', event)
    cause = (
        F.when(kind == "error", managed).when(kind == "click", failed_job)
        .when(kind == "view", F.concat(F.lit("Run failed. Returned payload: "), plain)).otherwise(plain))
    rows = table(spark, folder, "events").select(
        "event_id", error_type.alias("error_type"), cause.alias("cause"), F.lit("F").alias("file_name"),
        F.lit(1).alias("pipeline_stage"))
    return tracker.parse_error_events(rows).drop("error_type", "cause", "file_name", "pipeline_stage")
