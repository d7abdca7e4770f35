"""Every query against its SQL check at the smallest scale."""

from __future__ import annotations

import os

import pytest
from parity import connect, oracle_rows, spark_rows

import __spark_entry__ as entry
from newsmart.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == oracle_rows(oracle, ORACLES[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
