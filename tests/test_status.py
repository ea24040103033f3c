"""Models take sales of every status; only the extraction of a window leaves out what is not completed."""

from __future__ import annotations

import duckdb
import pytest

from tests.oracle_check import compare
from tidemark.plans import inputs
from tidemark.plans.catalog import ORACLES, QUERIES
from tidemark.sources.extract import extract_window
from tidemark.plans.row_queries import DAY

# Queries whose whole job is all sales, whatever their status.
ANY_STATUS = (
    "dim_regions dim_stores daily_sales payment_mix monthly_revenue batch_monitor latest_batches sales_with_payment revenue_by_dim "
    "region_pivot kpi_unpivot cumulative_28d revenue_metrics insert_update_tally batch_scan typed_staging enrich_amounts date_parts "
    "amount_validity validated quarantine union_live_deletes dq_gate gate_admitted_rows reconcile_batch batch_row_count "
    "daily_completeness compare_relations row_differences cdc_merge cdc_merge_actions cdc_merge_tally merge_stored_fact replayed_batch "
    "upsert_fact delete_by_markers incremental_fact lookback_delta incremental_daily incremental_daily_touched rollback_batch "
    "schema_append delete_insert scd2_history scd2_current scd2_as_of scd2_hard_deletes snapshot_check csv_round_trip insert_overwrite "
    "clustered_fact_scan"
).split()

# 48 orders of two lines each: four batches, all regions, every ninth line a delete and every 17th far too cheap.
# Half of the days lie before the cut; the later half ship versions of the earlier orders' first lines as well.
_TABLES = {
    "region": "SELECT CAST(i AS INTEGER) AS r_regionkey, ['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'][i + 1] AS r_name FROM range(5) t(i)",
    "nation": "SELECT CAST(i AS INTEGER) AS n_nationkey, 'N' || i AS n_name, CAST(i % 5 AS INTEGER) AS n_regionkey FROM range(10) t(i)",
    "customer": "SELECT i AS c_custkey, CAST(i % 10 AS INTEGER) AS c_nationkey FROM range(20) t(i)",
    "part": "SELECT i AS p_partkey, 100.0 + i AS p_retailprice FROM range(12) t(i)",
    "orders": """SELECT i AS o_orderkey, i % 20 AS o_custkey, '{status}' AS o_orderstatus,
  CASE i % 4 WHEN 0 THEN TIMESTAMP '1998-06-10' WHEN 1 THEN TIMESTAMP '1999-03-01' WHEN 2 THEN TIMESTAMP '2000-09-05'
    ELSE TIMESTAMP '2001-07-26' + to_days(CAST(i % 3 AS INTEGER)) END AS o_orderdate, ['1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'][i % 3 + 1] AS o_orderpriority
  FROM range(48) t(i)""",
    "lineitem": """SELECT i % 48 AS l_orderkey, i % 12 AS l_partkey, i % 3 AS l_suppkey, CAST(i % 96 // 48 AS INTEGER) AS l_linenumber,
  CAST(i % 5 + 1 AS DOUBLE) AS l_quantity, (i % 5 + 1) * (100.0 + i % 12) * CASE WHEN i % 17 = 3 THEN 0.1 ELSE 1 END AS l_extendedprice,
  CAST(i % 3 AS DOUBLE) / 100 AS l_discount, CAST(i % 2 AS DOUBLE) / 100 AS l_tax,
  CASE WHEN i % 9 = 4 THEN 'R' WHEN i >= 96 THEN 'A' ELSE 'N' END AS l_returnflag,
  CASE WHEN i >= 96 THEN TIMESTAMP '2001-07-30' WHEN i % 4 = 0 THEN TIMESTAMP '1998-06-15' WHEN i % 4 = 1 THEN TIMESTAMP '1999-03-04'
    WHEN i % 4 = 2 THEN TIMESTAMP '2000-09-09' ELSE TIMESTAMP '2001-07-29' END AS l_shipdate
  FROM range(130) t(i)""",
}


def tables(folder, status: str):
    """Small tables with all orders of one status, and a connection that sees them."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name, rows in _TABLES.items():
        con.execute(f"COPY ({rows.format(status=status)}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return str(folder), con


@pytest.fixture(scope="module")
def open_orders(tmp_path_factory):
    return tables(tmp_path_factory.mktemp("open"), "O")


@pytest.fixture(scope="module")
def done_orders(tmp_path_factory):
    return tables(tmp_path_factory.mktemp("done"), "F")


@pytest.mark.parametrize("name", ANY_STATUS)
def test_open_sales_count_like_completed_ones(spark, open_orders, done_orders, name):
    path, con = open_orders
    done = done_orders[1].execute(ORACLES[name]).fetchall()
    assert done
    assert sorted(con.execute(ORACLES[name]).fetchall(), key=str) == sorted(done, key=str)
    assert compare(QUERIES[name](spark, path), con, ORACLES[name]) == []


def test_inputs_with_and_without_open_sales(spark, open_orders, done_orders):
    for model in (inputs.validated, inputs.fact, inputs.before_cut, inputs.after_cut, inputs.old_fact, inputs.changes):
        open_rows, done_rows = model(spark, open_orders[0]).count(), model(spark, done_orders[0]).count()
        assert open_rows == done_rows > 0
        assert model(spark, open_orders[0], completed_only=True).count() == 0
        assert model(spark, done_orders[0], completed_only=True).count() == done_rows


def test_extraction_still_takes_completed_sales_only(spark, open_orders):
    assert extract_window(inputs.sales(spark, open_orders[0]), DAY).count() == 0
