"""Results stay right when one key holds a third of all rows."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from loanmart.fixtures import TABLES
from tests.conftest import SF_DIR
from tests.oracle import compare, connect

THIRD = "row_number() over () % 3 = 0"
HOT = {
    "lineitem": f"case when {THIRD} then 7 else l_orderkey end as l_orderkey, "
                f"case when {THIRD} then 3 else l_suppkey end as l_suppkey",
    "orders": "case when o_orderkey % 3 = 0 then 5 else o_custkey end as o_custkey",
    "events": "case when event_id % 3 = 0 then 8 else user_id end as user_id",
}


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    path = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for t in TABLES:
        star = f"* replace ({HOT[t]})" if t in HOT else "*"
        con.execute(f"copy (select {star} from '{SF_DIR}/{t}.parquet') to '{path}/{t}.parquet'")
    return str(path)


@pytest.mark.parametrize("name", ["q_default_days", "q_contract_register", "q_snapshot", "q_days_past_due",
                                  "q_running_sum", "q_dense_rank", "q_daily_unique", "q_dedupe", "q_first_movement",
                                  "q_anti_backfill", "q_app_mart"])
def test_hot_key(spark, hot_dir, name):
    _, faults = compare(spark, connect(hot_dir), hot_dir, entry.queries()[name], entry.oracle_sql()[name])
    assert not faults
