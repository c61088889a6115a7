"""Queries of the training-data operators against their SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare

from tallymart.llm import registry

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compare(spark, SMALL, name) == ""


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.queries())
    assert numbers == list(range(1, 14))
