"""Column names and labels shared by loads, reconciliations and reports."""

FILE_HASH = "file_hash"
PRE_FILE_HASH = "pre_file_hash"
STAGED_HASH = "staged_hash"
FINAL_HASH = "final_hash"
PRE_ORIGIN_FILE = "pre_origin_file"
ORIGIN_FILE = "origin_file"
STAGED_PREFIX = "pre_"

OUTCOME = "reconciliation_outcome"
COUNT = "count"

# Labels that users of the reports rely on.
PASSED = "PASSED"
FAILED = "FAILED"
EXCLUDED = "EXCLUDED"
NOT_APPLICABLE = "-NA-"
