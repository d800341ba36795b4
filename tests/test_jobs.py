"""Staging jobs and the warehouse refresh against tables on storage (J12, J13, B14)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from starmart.plans import refresh, staging_jobs
from starmart.schemas import create_tables
from starmart.session import scratch_path

from . import fixtures as fx


def ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


@pytest.fixture()
def wh(spark):
    return refresh.Warehouse(spark, scratch_path(spark, "test-wh"))


def test_create_tables_once(spark, wh):
    v1 = create_tables(spark, wh.root)
    assert len(v1) == 21 and create_tables(spark, wh.root) == v1
    assert wh.read("dds.dm_orders").count() == 0


def test_stage_bonus_incremental(spark, wh):
    outbox = spark.createDataFrame([(1, ts("2023-11-01 10:00:00"), "bonus_transaction", "{}"),
                                    (2, ts("2023-11-01 11:00:00"), "user_rank", '{"r":1}'),
                                    (3, ts("2023-11-01 12:00:00"), "bonus_transaction", '{"n":3}')],
                                   "id bigint, event_ts timestamp_ntz, event_type string, event_value string")
    staging_jobs.stage_bonus(wh, outbox.where("id < 3"))
    out = staging_jobs.stage_bonus(wh, outbox)            # only id 3 is new
    assert sorted(r.id for r in out["bonussystem_events"].collect()) == [1, 2, 3]
    cur = {r.workflow_key: (r.id, r.workflow_settings) for r in out["srv_wf_settings_posgresql"].collect()}
    assert cur == {"bonus_transaction": (3, '{"n":3}'), "user_rank": (2, '{"r":1}')}
    again = staging_jobs.stage_bonus(wh, outbox)          # nothing new: unchanged
    assert again["bonussystem_events"].count() == 3


def _orders_coll(spark, rows):
    return spark.createDataFrame(
        [(o, st, ts(d), {"id": u}, {"id": r}, ts(upd)) for o, u, r, d, st, upd in rows],
        "_id string, final_status string, date timestamp_ntz, user struct<id:string>, "
        "restaurant struct<id:string>, update_ts timestamp_ntz")


def test_stage_orders_system_cursor_and_update(spark, wh):
    first = [(o, u, r, d, st, d) for o, u, r, d, st in fx.ORDERS]
    staging_jobs.stage_orders_system(wh, {"orders": _orders_coll(spark, first)})
    # o3 closed later (T7 input); o1 unchanged and older than the cursor
    second = first + [("o3", "u1", "r2", "2023-11-02 09:00:00", "CLOSED", "2023-11-03 08:00:00")]
    out = staging_jobs.stage_orders_system(wh, {"orders": _orders_coll(spark, second)})
    t = out["stg.ordersystem_orders"]
    assert t.count() == 4
    o3 = json.loads(t.where("object_id = 'o3'").first().object_value)
    assert o3["final_status"] == "CLOSED"
    assert str(out["stg.srv_wf_settings_mongodb"].first().last_update_ts) == "2023-11-03 08:00:00"


def test_stage_api_window_and_insert_absent(spark, wh):
    couriers = spark.createDataFrame([("c1", "Ann"), ("c2", "Bo")], "_id string, name string")
    items = spark.createDataFrame([("o1", "2023-11-01 10:00:00", "c1", 5, 50.0), ("o2", "2023-11-05 10:00:00", "c1", 4, 0.0),
                                   ("o3", "2023-11-09 10:00:00", "c2", 3, 10.0)],
                                  "order_id string, order_ts string, courier_id string, rate int, tip_sum double")
    staging_jobs.stage_api(wh, couriers, items, "2023-11-06 00:00:00")   # first run: 7 days back
    out = staging_jobs.stage_api(wh, couriers, items, "2023-11-10 00:00:00")   # from the previous run
    assert out["couriers"].count() == 2
    got = sorted(json.loads(r.deliveri_info)["order_id"] for r in out["deliveries"].collect())
    assert got == ["o1", "o2", "o3"]


def test_refresh_twice_is_stable(spark, wh):
    stg = fx.staging(spark, deliveries=fx.DELIVERIES + [("o4", "c2", 5, "1.00")])
    first = refresh.refresh_all(spark, stg, wh.root, floor="2023-10-22 00:00:00")
    second = refresh.refresh_all(spark, stg, wh.root, floor="2023-10-22 00:00:00")
    for t in ("dm_orders", "fct_product_sales", "dm_settlement_report", "dm_courier_ledger"):
        a = sorted(tuple(r) for r in first[t].collect())
        b = sorted(tuple(r) for r in second[t].collect())
        assert a == b, t
    assert second["dm_orders"].count() == 4
