"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
import oracle
from ledgerbrook.catalog import bindings, registry

SF_DIR = os.environ.get("TEST_SF_DIR", driver.SMOKE_DIR)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, connection, name):
    sql = driver.oracle_sql()[name]
    assert oracle.differences(driver.queries()[name](spark, SF_DIR), connection, sql) == []


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) == set(registry.queries()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(bindings.SCHEMAS))
def test_stated_schema_is_the_stored_one(spark, name):
    stored = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    assert stored.dtypes == bindings.table(spark, SF_DIR, name).dtypes


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and "total_score" in df.columns
