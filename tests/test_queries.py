"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
import check
from barmart.queries.catalog import QUERIES
from barmart.queries.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check.database(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert check.differences(spark, db, name, SF) == ""


def test_entry(spark):
    df = registry.entry(spark)
    assert len(df.columns) == 21 and not df.isEmpty()
