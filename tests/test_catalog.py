"""Catalogue against the DuckDB oracle on sf0.001, the driver entry point, and plan checks."""

import duckdb
import pytest

import __spark_entry__ as E
from starmart.plans import catalog
from tools.oracle_check import TABLES, rows_of

from .conftest import SF

FAST_KEYS = [
    "extract_outbox_by_id", "stage_documents_full", "stage_documents_incremental", "normalise_documents",
    "stage_api_snapshot", "upsert_last_wins", "upsert_partial_columns", "upsert_alternate_key", "insert_if_absent",
    "jsonb_canonical", "dedupe_last", "duplicate_key_report", "cursor_per_type", "surrogate_keys",
    "cursor_filter_inclusive", "cursor_filter_strict", "json_parse_quarantine", "timestamp_parts", "cast_decimals",
    "text_split", "explode_json_array", "shred_text_parity", "payout_bands", "settlement_fee_math",
    "conform_types", "explode_payments", "lookup_rejects", "join_fanout", "agg_count_distinct",
    "dq_not_null", "dq_ranges", "dq_foreign_keys", "scd2_build", "scd2_apply", "scd2_asof",
]
WAREHOUSE_KEYS = ["dm_users", "dm_products", "dm_orders", "fct_product_sales", "dm_settlement_report",
                  "dm_courier_ledger", "dm_courier_ledger_avg_rate"]
STREAM_KEYS = ["stream_ingest_once", "stream_daily_totals", "stream_merge_versions", "stream_settlement", "stream_late_rows"]
REFRESH_KEYS = ["refresh_second_run", "refresh_second_run_ledger", "refresh_rejected_orders", "agg_count_distinct_monthly",
                "stage_api_paged", "dq_observed_write", "ledger_co_partitioned", "settlement_co_partitioned"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_oracle_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())
    assert len(catalog.queries()) >= 72


@pytest.mark.parametrize("key", FAST_KEYS + WAREHOUSE_KEYS + STREAM_KEYS + REFRESH_KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[key])
    b, bc = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert ac == bc
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["restaurant_id", "restaurant_name", "settlement_date"]
    assert df.count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["dm_settlement_report", "explode_payments", "scd2_asof", "upsert_last_wins",
                                 "insert_if_absent", "normalise_documents"])
def test_no_python_in_plans(spark, key):
    p = _plan(E.queries()[key](spark, SF))
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_mart_plan_reads_tables_and_filters_status(spark):
    df = E.queries()["dm_settlement_report"](spark, SF)
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(order_status), EqualTo(order_status,CLOSED)" in p
    assert "BroadcastHashJoin" in p
