"""Registered queries against their SQL, on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
import check
from barmart.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_each_operator_is_registered_once():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and {*QUERIES, "pipeline"} <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert check.differences(spark, check.database(SF), name, SF) == ""
