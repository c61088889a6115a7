"""Every registered query against its SQL on the smallest warehouse."""

from __future__ import annotations

import os

import pytest
from compare import compare

import __spark_entry__ as registered
from tallymart.plans import catalog, oracle

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, name):
    assert compare(spark, FOLDER, name) == ""


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == [
        "ORDER_DATE",
        "COUNTRY",
        "CATEGORY",
        "TOTAL_ORDERS",
        "TOTAL_QUANTITY",
        "TOTAL_REVENUE_LOCAL",
        "TOTAL_REVENUE_USD",
    ]
    assert not df.isEmpty()
