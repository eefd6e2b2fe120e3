import json

from pyspark.sql import functions as F

from stagecheck.operators import tracker
from stagecheck.plans.tables import ROUTING

SCHEMA = "file_name string, executing_for_table string, mig_sts string, recon_summary string, seq int"


def test_upsert_keeps_summary_and_is_idempotent(spark):
    current = spark.createDataFrame([("f", "T", "", "", 1), ("g", "T", "OLD", "s", 1)], SCHEMA)
    changes = spark.createDataFrame([
        ("f", "T", "STAGE 1 STARTED", None, 2), ("f", "T", "STAGE 1 COMPLETED", "STAGE 1 - [x]", 3),
        ("f", "T", "STAGE 2 STARTED", None, 4), ("h", "U", "STAGE 1 STARTED", None, 2)], SCHEMA)
    keep = {"keys": tracker.TRACKER_KEYS, "order": ["seq"], "keep_when_null": ["recon_summary"]}
    once = tracker.upsert_latest(current, changes, **keep)
    want = [("f", "T", "STAGE 2 STARTED", "STAGE 1 - [x]", 4), ("g", "T", "OLD", "s", 1),
            ("h", "U", "STAGE 1 STARTED", None, 2)]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, tracker.upsert_latest(once, changes, **keep).collect())) == want


def test_upsert_may_set_null(spark):
    current = spark.createDataFrame([("f", "T", "X", "s", 1)], SCHEMA)
    change = spark.createDataFrame([("f", "T", None, None, 2)], SCHEMA)
    got = tracker.upsert_latest(current, change, tracker.TRACKER_KEYS, ["seq"])
    assert [tuple(r) for r in got.collect()] == [("f", "T", None, None, 2)]


def test_poll(spark):
    df = spark.createDataFrame([("f", "T", "X", "s", 1), ("g", "T", "Y", "s", 1)], SCHEMA)
    got = tracker.poll_status(df, "mig_sts, bogus , file_name", file_name="g", bogus=1)
    assert got.columns == ["mig_sts", "file_name"] and [tuple(r) for r in got.collect()] == [("Y", "g")]
    assert tracker.poll_status(df).columns == ["file_name", "executing_for_table", "mig_sts", "recon_summary"]


def test_summary_line(spark):
    df = spark.createDataFrame([("PASSED", 5), ("FAILED", 0)], "reconciliation_outcome string, count long")
    assert tracker.summary_line(df, 2).first()[0] == (
        "STAGE 2 - [reconciliation_outcome,count][FAILED,0][PASSED,5]")


def test_routing(spark):
    df = spark.createDataFrame([("PRODUCT_DETAILS",), ("STAFF_DETAILS",), ("NONE",)], "table_name string")
    got = sorted(map(tuple, tracker.route_files(df, ROUTING).collect()))
    assert got == [("PRODUCT_DETAILS", "PRODUCT_DETAILS"), ("PRODUCT_DETAILS", "PRODUCT_SECONDARY_CATEGORY"),
                   ("STAFF_DETAILS", "STAFF_DETAILS")]
    bad = tracker.rejected_requests(df.withColumn("target_table", F.lit("STAFF_DETAILS")), ROUTING)
    assert sorted(r.table_name for r in bad.collect()) == ["NONE", "PRODUCT_DETAILS"]


def test_error_events(spark):
    managed = json.dumps({"errorMessage": json.dumps(
        {"error_type": "KeyError", "exception_cause": "no key", "lambda_name": "start"})})
    rows = [
        ("Exception", managed),
        ("States.TaskFailed", json.dumps({"ErrorMessage": "boom", "JobName": "load"})),
        ("Glue.ConcurrentRunsExceededException", json.dumps({"JOBNAME": "load"})),
        ("Lambda.Unknown", 'Died. Returned payload: {"errorMessage": "timed out"}'),
        ("Lambda.AWSLambdaException", json.dumps({"errorMessage": "throttled"})),
        ("Other", "not json"),
        ("Exception", None),
    ]
    df = spark.createDataFrame([(*r, "F~1.2.csv", 1) for r in rows],
                               "error_type string, cause string, file_name string, pipeline_stage int")
    out = tracker.parse_error_events(df)
    got = [(r.error_kind, r.error_cause, r.job_name, r.is_handled) for r in out.collect()]
    assert got == [
        ("KeyError", "no key", "start", True),
        ("Glue Runtime Error", "boom", "load", True),
        ("Glue Runtime Error", "<UNKNOWN>", "load", True),
        ("Lambda.Unknown", "timed out", "<UNKNOWN>", True),
        ("Lambda.AWSLambdaException", "throttled", "<UNKNOWN>", True),
        ("Other", "<UNKNOWN>", "<UNKNOWN>", False),
        ("<UNKNOWN>", "<UNKNOWN>", "<UNKNOWN>", True),
    ]
    first = out.first()
    assert first.mig_sts == "STAGE 1 ERROR" and "at job start with error:\n[KeyError] no key.\n" in first.error_msg
