"""Every registered query against its SQL at the smallest scale."""

import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from check import compare, connect


@pytest.fixture(scope="module")
def db():
    return connect(SMOKE_DIR)


def test_entry(spark):
    assert entry(spark).columns == ["reconciliation_outcome", "count"]
    assert entry(spark).count() == 2


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    outcome, remark = compare(spark, db, SMOKE_DIR, name)
    assert outcome in ("ok", "rows"), remark
