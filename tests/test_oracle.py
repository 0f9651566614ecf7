"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, sf_dir, name):
    _, faults = compare(spark, con, sf_dir, QUERIES[name], ORACLES[name])
    assert not faults


def test_entry(spark):
    assert entry.entry(spark).columns == ["date_vyd_d", "glob_id", "k_vid_cred", "fpd", "spd", "tpd"]
