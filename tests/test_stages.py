"""Ten tables through both stages, with and without planted faults."""

import csv
import datetime
import hashlib
import pathlib

import pytest
from pyspark.sql import functions as F

from stagecheck import names, snapshots
from stagecheck.plans import load, reconcile
from stagecheck.plans.tables import ROUTING, SPECS, spec_for
from stagecheck.sinks.tables import delete_file, reload_file, stored_collisions
from stagecheck.sources.tables import read_final, read_staged, table_path
from stagecheck.spec import specs_from_config
from stagecheck.streaming.arrivals import load_arrivals

SAMPLE = {"int": "7", "boolean": "1", "timestamp": "2024-05-06 07:08:09", "date": "1990-01-02", "decimal(10,2)": "9.5"}


def cell(column, row):
    if column.name == "id":
        return str(row)
    return SAMPLE.get(column.type, f"{column.name} {row}")


def source_file(folder, spec, rows=5, stamp="20240101.000000", change=None):
    """A data file with correct hashes, as an extractor would leave it."""
    path = pathlib.Path(folder) / f"{spec.name}~{stamp}.csv"
    columns = [c.name for c in spec.columns]
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(columns + ["file_hash"])
        for row in range(1, rows + 1):
            values = {c.name: cell(c, row) for c in spec.columns}
            if change:
                change(values, row)
            text = "".join(values[c] for c in spec.hash_columns)
            writer.writerow([values[c] for c in columns] + [hashlib.sha256(text.encode()).hexdigest().upper()])
    return str(path), path.name


def report(spark, path):
    rows = spark.read.option("header", True).csv(path).collect()
    return {r[names.OUTCOME]: r[names.COUNT] for r in rows}


def both_stages(spark, root, spec, path, name):
    load.load_stage1(spark, path, name, spec, f"{root}/staging")
    first = reconcile.reconcile_stage1(spark, path, name, spec, f"{root}/staging", f"{root}/reports", f"{root}/hashes")
    load.load_stage2(spark, name, spec, f"{root}/staging", f"{root}/final", check_references=False)
    second = reconcile.reconcile_stage2(
        spark, name, spec, f"{root}/staging", f"{root}/final", f"{root}/reports", f"{root}/hashes")
    return first, second


@pytest.mark.parametrize("table", [t for t in SPECS if not SPECS[t].excluded])
def test_clean_file_passes_both_stages(spark, tmp_path, table):
    spec = spec_for(table)
    path, name = source_file(tmp_path, spec)
    first, second = both_stages(spark, tmp_path, spec, path, name)
    assert report(spark, first.summary) == {"FAILED": "0", "PASSED": "5"}
    assert report(spark, second.summary) == {"FAILED": "0", "PASSED": "5"}
    final = read_final(spark, f"{tmp_path}/final", spec, name)
    assert final.schema == spec.final_schema and final.count() == 5
    assert spark.read.parquet(first.archive).columns == ["pre_id", "pre_file_hash", "staged_hash"]
    assert spark.read.parquet(second.archive).columns == ["id", "staged_hash", "final_hash"]


def test_planted_faults_are_counted(spark, tmp_path):
    spec = spec_for("CUSTOMER_DETAILS")
    path, name = source_file(tmp_path, spec, rows=8)
    load.load_stage1(spark, path, name, spec, f"{tmp_path}/staging")
    staged = read_staged(spark, f"{tmp_path}/staging", spec).withColumns({
        "pre_first_name": F.when(F.col("pre_id") == 2, "changed").otherwise(F.col("pre_first_name")),
        "pre_email": F.when(F.col("pre_id") != 3, F.col("pre_email")),
    }).filter("pre_id <> 4")
    faulty = f"{tmp_path}/faulty"
    staged.write.partitionBy(names.PRE_ORIGIN_FILE).parquet(table_path(faulty, spec.staged_name))
    done = reconcile.reconcile_stage1(spark, path, name, spec, faulty, f"{tmp_path}/reports", f"{tmp_path}/hashes")
    assert report(spark, done.summary) == {"FAILED": "2", "PASSED": "5"}
    lines = spark.read.option("header", True).option("escape", '"').csv(done.detail).collect()
    assert [(r["id <> pre_id"], r["data_source"], r[names.OUTCOME]) for r in lines[:6]] == [
        ("2", "data_file", "FAILED"), ("2", "preliminary_table", "FAILED"),
        ("3", "data_file", "FAILED"), ("3", "preliminary_table", "FAILED"),
        ("4", "data_file", "FAILED"), (None, "preliminary_table", "FAILED")]
    assert len(lines) == 16


def test_detail_of_an_empty_file_has_a_header(spark, tmp_path):
    spec = spec_for("PRODUCT_COUNTRY")
    path, name = source_file(tmp_path, spec, rows=0)
    filled, other = source_file(tmp_path, spec, rows=1, stamp="20240102.000000")
    load.load_stage1(spark, filled, other, spec, f"{tmp_path}/staging")
    done = reconcile.reconcile_stage1(
        spark, path, name, spec, f"{tmp_path}/staging", f"{tmp_path}/reports", f"{tmp_path}/hashes")
    assert report(spark, done.summary) == {"FAILED": "0"}
    text = "".join(p.read_text() for p in pathlib.Path(done.detail).glob("part-*"))
    assert text.startswith("id <> pre_id,name <> pre_name,file_hash,")


def test_category_cleaning(spark, tmp_path):
    spec = spec_for("PRODUCT_CATEGORY")

    def change(values, row):
        values["created_at"] = "2024-01-01T20:00:00Z" if row == 1 else ""
        values["modified_by"] = "" if row == 1 else "4"

    path, name = source_file(tmp_path, spec, rows=2, change=change)
    first, second = both_stages(spark, tmp_path, spec, path, name)
    assert report(spark, first.summary) == {"FAILED": "0", "PASSED": "2"}
    got = {r.id: (r.created_at, r.modified_by) for r in read_final(spark, f"{tmp_path}/final", spec).collect()}
    assert got == {1: (datetime.datetime(2024, 1, 2, 4), 1), 2: (datetime.datetime(1900, 1, 1), 4)}


def test_product_file_feeds_two_tables(spark, tmp_path):
    spec, second = spec_for("PRODUCT_DETAILS"), spec_for("PRODUCT_SECONDARY_CATEGORY")
    assert ROUTING["PRODUCT_DETAILS"] == (spec.name, second.name)
    path, name = source_file(tmp_path, spec, rows=3)
    lines = pathlib.Path(path).read_text().splitlines()
    extra = ["id_category_secondary", '"8, 9"', '""', '"11"']
    pathlib.Path(path).write_text("\n".join(f"{e},{line}" for e, line in zip(extra, lines)) + "\n")
    first, _ = both_stages(spark, tmp_path, spec, path, name)
    assert report(spark, first.summary) == {"FAILED": "0", "PASSED": "3"}

    load.load_stage1(spark, path, name, second, f"{tmp_path}/staging")
    done = reconcile.reconcile_stage1(
        spark, path, name, second, f"{tmp_path}/staging", f"{tmp_path}/reports", f"{tmp_path}/hashes")
    assert report(spark, done.summary) == {"EXCLUDED": "EXCLUDED"} and done.detail is None
    got = sorted(map(tuple, read_staged(spark, f"{tmp_path}/staging", second).select(
        "pre_id", "pre_id_prod", "pre_id_cat").collect()))
    assert got == [(0, 1, 8), (1, 1, 9), (2, 2, None), (3, 3, 11)]


def test_ids_of_a_derived_table_go_on_over_files(spark, tmp_path):
    spec, staging, final = spec_for("PRODUCT_SECONDARY_CATEGORY"), f"{tmp_path}/staging", f"{tmp_path}/final"
    lists = {"1.1": ['"8, 9"', "5"], "2.2": ["4", '"1,2,3"'], "3.3": ["6"]}
    for day, (stamp, cells) in enumerate(lists.items()):
        path = tmp_path / f"PRODUCT_DETAILS~{stamp}.csv"
        path.write_text("id,id_category_secondary,file_hash\n" + "".join(f"{10 * day + i},{c},x\n" for i, c in enumerate(cells)))
        load.load_stage1(spark, str(path), path.name, spec, staging)
        load.load_stage2(spark, path.name, spec, staging, final, check_references=False)
    rows = lambda: sorted(tuple(r)[:3] for r in read_final(spark, final, spec).collect())
    want = [(0, 0, 8), (1, 0, 9), (2, 1, 5), (3, 10, 4), (4, 11, 1), (5, 11, 2), (6, 11, 3), (7, 20, 6)]
    assert rows() == want
    name = "PRODUCT_DETAILS~2.2.csv"
    load.load_stage1(spark, str(tmp_path / name), name, spec, staging, mode="overwrite")
    load.load_stage2(spark, name, spec, staging, final, mode="overwrite", check_references=False)
    assert rows() == want


def test_reload_is_idempotent_and_keeps_other_files(spark, tmp_path):
    spec, staging = spec_for("PRODUCT_COUNTRY"), f"{tmp_path}/staging"
    one, one_name = source_file(tmp_path, spec, rows=3, stamp="1.1")
    two, two_name = source_file(tmp_path, spec, rows=4, stamp="2.2")
    load.load_stage1(spark, one, one_name, spec, staging)
    load.load_stage1(spark, two, two_name, spec, staging)
    for _ in range(2):
        load.load_stage1(spark, one, one_name, spec, staging, mode="overwrite")
    counts = {r[0]: r[1] for r in read_staged(spark, staging, spec).groupBy(names.PRE_ORIGIN_FILE).count().collect()}
    assert counts == {one_name: 3, two_name: 4}
    fewer = read_staged(spark, staging, spec, two_name).filter("pre_id = 1")
    reload_file(spark.createDataFrame(fewer.collect(), fewer.schema), table_path(staging, spec.staged_name),
                names.PRE_ORIGIN_FILE)
    assert read_staged(spark, staging, spec).count() == 4


def test_keys_are_enforced(spark, tmp_path):
    spec, staging, final = spec_for("PRODUCT_COUNTRY"), f"{tmp_path}/staging", f"{tmp_path}/final"
    one, one_name = source_file(tmp_path, spec, rows=3, stamp="1.1")
    two, two_name = source_file(tmp_path, spec, rows=4, stamp="2.2")
    load.load_stage1(spark, one, one_name, spec, staging)
    with pytest.raises(ValueError, match="not unique"):
        load.load_stage1(spark, one, one_name, spec, staging)
    load.load_stage1(spark, two, two_name, spec, staging)
    load.load_stage2(spark, one_name, spec, staging, final)
    with pytest.raises(ValueError, match="not unique"):
        load.load_stage2(spark, two_name, spec, staging, final)
    load.load_stage2(spark, one_name, spec, staging, final, mode="overwrite")
    assert read_final(spark, final, spec).count() == 3


def test_partition_pruning(spark, tmp_path):
    spec = spec_for("PRODUCT_COUNTRY")
    path, name = source_file(tmp_path, spec)
    load.load_stage1(spark, path, name, spec, f"{tmp_path}/staging")
    load.load_stage1(spark, *source_file(tmp_path, spec, stamp="2.2"), spec, f"{tmp_path}/staging")
    files = read_staged(spark, f"{tmp_path}/staging", spec, name).inputFiles()
    assert files and all(f"pre_origin_file={name}/" in f for f in files)
    assert read_staged(spark, f"{tmp_path}/staging", spec, "NO~1.1.csv").count() == 0


def test_an_empty_reload_leaves_no_rows(spark, tmp_path):
    spec, staging, final = spec_for("PRODUCT_COUNTRY"), f"{tmp_path}/staging", f"{tmp_path}/final"
    one, one_name = source_file(tmp_path, spec, rows=3, stamp="1.1")
    load.load_stage1(spark, one, one_name, spec, staging)
    load.load_stage2(spark, one_name, spec, staging, final)
    source_file(tmp_path, spec, rows=0, stamp="1.1")
    load.load_stage1(spark, one, one_name, spec, staging, mode="overwrite")
    load.load_stage2(spark, one_name, spec, staging, final, mode="overwrite")
    assert read_staged(spark, staging, spec).count() == read_final(spark, final, spec).count() == 0


def test_a_file_is_deleted_from_a_stored_table(spark, tmp_path):
    spec, staging = spec_for("PRODUCT_COUNTRY"), f"{tmp_path}/staging"
    for stamp in ("1.1", "2.2"):
        path, name = source_file(tmp_path, spec, rows=3, stamp=stamp)
        load.load_stage1(spark, path, name, spec, staging)
    assert delete_file(spark, table_path(staging, spec.staged_name), name)
    left = read_staged(spark, staging, spec).select(names.PRE_ORIGIN_FILE).distinct().collect()
    assert [r[0] for r in left] == ["PRODUCT_COUNTRY~1.1.csv"]


def test_references_and_required_values_are_enforced(spark, tmp_path):
    staff, brand = spec_for("STAFF_DETAILS"), spec_for("PRODUCT_BRAND")
    staging, final = f"{tmp_path}/staging", f"{tmp_path}/final"

    def change(values, row):
        values["modified_by"] = "9" if row == 2 else "1"
        values["modified_at"] = "no time" if row == 3 else values["modified_at"]

    path, name = source_file(tmp_path, brand, rows=3, change=change)
    load.load_stage1(spark, path, name, brand, staging)
    with pytest.raises(ValueError, match="required values are missing: {'modified_at': 1}"):
        load.load_stage2(spark, name, brand, staging, final)
    with pytest.raises(ValueError, match="has no row in STAFF_DETAILS"):
        load.load_stage2(spark, name, brand, staging, final, check_rows=False)
    parents, parent_name = source_file(tmp_path, staff, rows=4)
    load.load_stage1(spark, parents, parent_name, staff, staging)
    load.load_stage2(spark, parent_name, staff, staging, final)
    with pytest.raises(ValueError, match="modified_by 9 has no row"):
        load.load_stage2(spark, name, brand, staging, final, check_rows=False)
    path, name = source_file(tmp_path, brand, rows=3, stamp="3.3", change=lambda v, row: v.update(modified_by=str(row)))
    load.load_stage1(spark, path, name, brand, staging)
    load.load_stage2(spark, name, brand, staging, final)
    assert read_final(spark, final, brand).count() == 3


def test_stored_keys_are_not_shuffled(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "stored"))
    spark.range(5).write.parquet(str(tmp_path / "new"))
    found = stored_collisions(spark.read.parquet(str(tmp_path / "new")), spark.read.parquet(str(tmp_path / "stored")), ["id"])
    assert found.count() == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_more_failures_than_any_limit_through_the_reconciliation(spark, tmp_path):
    spec = spec_for("PRODUCT_COUNTRY")
    path, name = source_file(tmp_path, spec, rows=1500)
    load.load_stage1(spark, path, name, spec, f"{tmp_path}/staging")
    faulty = f"{tmp_path}/faulty"
    read_staged(spark, f"{tmp_path}/staging", spec).withColumn("pre_name", F.lit("changed")).write.partitionBy(
        names.PRE_ORIGIN_FILE).parquet(table_path(faulty, spec.staged_name))
    done = reconcile.reconcile_stage1(spark, path, name, spec, faulty, f"{tmp_path}/reports", f"{tmp_path}/hashes")
    assert report(spark, done.summary) == {"FAILED": "1500"}
    assert spark.read.option("header", True).csv(done.detail).count() == 3000
    cut = reconcile.reconcile_stage1(
        spark, path, name, spec, faulty, f"{tmp_path}/reports", f"{tmp_path}/hashes", passed=1, failed=20)
    assert spark.read.option("header", True).csv(cut.detail).count() == 40


def test_unknown_table():
    with pytest.raises(ValueError):
        spec_for("NO_TABLE")


def test_specs_from_config(spark, tmp_path):
    config = {"prelim_column_prefix": "pre_", "tables": {"BRAND": {
        "mappings_prelim": [["id", "string", "pre_id", "string"], ["price", "string", "pre_price", "string"]],
        "mappings_final": [["pre_id", "int", "id", "int"], ["pre_price", "decimal", "price", "decimal"]],
        "primary_keys": ["id"], "pre_exclude_from_hash": False}}}
    spec = specs_from_config(config)["BRAND"]
    assert spec.column("price").type == "decimal(10,2)" and spec.kinds() == {"price": "decimal"}
    path, name = source_file(tmp_path, spec)
    first, _ = both_stages(spark, tmp_path, spec, path, name)
    assert report(spark, first.summary) == {"FAILED": "0", "PASSED": "5"}


def test_config_mappings_hold_as_written(spark, tmp_path):
    config = {"tables": {"BRAND": {
        "prelim_name": "STAGED_BRANDS", "final_name": "BRANDS",
        "mappings_prelim": [["number", "string", "brand_no", "string"], ["title", "string", "brand_title", "string"]],
        "mappings_final": [["brand_no", "int", "id", "int"], ["brand_title", "string", "name", "string"]],
        "primary_keys": ["id"], "pre_exclude_from_hash": False}}}
    spec = specs_from_config(config)["BRAND"]
    assert (spec.staged_keys, spec.source_keys, spec.staged_name) == (("brand_no",), ("number",), "STAGED_BRANDS")
    path = tmp_path / "BRAND~1.1.csv"
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest().upper()
    path.write_text("number,title,file_hash\n" + "".join(f"{i},t{i},{digest(f'{i}t{i}')}\n" for i in range(4)))
    first, second = both_stages(spark, tmp_path, spec, str(path), path.name)
    assert report(spark, first.summary) == report(spark, second.summary) == {"FAILED": "0", "PASSED": "4"}
    assert snapshots.read(spark, f"{tmp_path}/final/BRANDS").columns == ["id", "name", "origin_file"]
    assert "brand_title" in snapshots.read(spark, f"{tmp_path}/staging/STAGED_BRANDS").columns


def test_stream_loads_each_file_once(spark, tmp_path):
    spec, staging = spec_for("PRODUCT_BRAND"), f"{tmp_path}/staging"
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    columns = [c.name for c in spec.columns] + [names.FILE_HASH]
    for stamp, rows in (("1.1", 3), ("2.2", 4)):
        source_file(inbox, spec, rows=rows, stamp=stamp)
        load_arrivals(spark, str(inbox), columns, spec, staging, f"{tmp_path}/checkpoint").awaitTermination(120)
    counts = {r[0]: r[1] for r in read_staged(spark, staging, spec).groupBy(names.PRE_ORIGIN_FILE).count().collect()}
    assert counts == {"PRODUCT_BRAND~1.1.csv": 3, "PRODUCT_BRAND~2.2.csv": 4}
    with pytest.raises(ValueError):
        load_arrivals(spark, str(inbox), columns, spec_for("PRODUCT_SECONDARY_CATEGORY"), staging, "x")


def test_quoted_line_breaks_through_stages_and_stream(spark, tmp_path):
    spec = spec_for("PRODUCT_COUNTRY")
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    path, name = source_file(inbox, spec, rows=3, change=lambda v, row: v.update(name=f"two\nlines, \"{row}\""))
    staging = f"{tmp_path}/staging"
    load.load_stage1(spark, path, name, spec, staging, multi_line=True)
    done = reconcile.reconcile_stage1(spark, path, name, spec, staging, f"{tmp_path}/reports", f"{tmp_path}/hashes", multi_line=True)
    assert report(spark, done.summary) == {"FAILED": "0", "PASSED": "3"}
    want = sorted(tuple(r) for r in read_staged(spark, staging, spec).collect())
    load_arrivals(spark, str(inbox), [c.name for c in spec.columns] + [names.FILE_HASH], spec, f"{tmp_path}/streamed",
                  f"{tmp_path}/checkpoint", multi_line=True).awaitTermination(120)
    assert sorted(tuple(r) for r in read_staged(spark, f"{tmp_path}/streamed", spec).collect()) == want
