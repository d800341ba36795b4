"""End-to-end golden test on the hand-made data set (FIXTURES.md section 3)."""

from decimal import Decimal as D

import pytest

from starmart.plans import dds, marts
from starmart.plans.refresh import build_marts, build_warehouse

from . import fixtures as fx

FLOOR = "2023-10-22 00:00:00"


@pytest.fixture(scope="module")
def wh(spark):
    return build_warehouse(spark, fx.staging(spark), floor=FLOOR)


def test_orders_lose_undelivered(wh):
    keys = sorted(r.order_key for r in wh["dm_orders"].collect())
    assert keys == ["o1", "o2", "o3"]          # o4 has no delivery (T9)


def test_rejects_name_the_missed_lookup(spark, wh):
    stg = fx.staging(spark)
    rej = dds.order_rejects(stg["orders"], wh["dm_users"], wh["dm_restaurants"], wh["dm_timestamps"],
                            wh["deliveries"], floor=FLOOR)
    assert [(r.order_key, r.reason) for r in rej.collect()] == [("o4", "no delivery")]


def test_product_sales_rounded_once(wh):
    f = wh["fct_product_sales"].join(wh["dm_products"].selectExpr("id product_id", "product_id pid"), "product_id") \
        .join(wh["dm_orders"].selectExpr("id order_id", "order_key"), "order_id")
    rows = {(r.order_key, r.pid): r for r in f.collect()}
    assert len(rows) == 4                              # o4 lost, the rank event adds nothing (T12)
    assert rows[("o1", "p1")].bonus_payment == D("100.01")   # 100.005 rounded at the store (T22)
    assert rows[("o1", "p2")].total_sum == D("3000.00")


def test_settlement_report(wh):
    rows = build_marts(wh)["dm_settlement_report"].collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.restaurant_name, str(r.settlement_date), r.orders_count) == ("Soup", "2023-11-01", 2)
    assert (r.orders_total_sum, r.orders_bonus_payment_sum, r.orders_bonus_granted_sum) == (
        D("4101.02"), D("100.02"), D("200.00"))
    assert r.order_processing_fee == D("1025.26")
    assert r.restaurant_reward_sum == D("2975.75")     # not 2975.74 from the rounded fee (T23)


def test_ledger_row_rate_as_coded(wh):
    rows = build_marts(wh, "row_rate")["dm_courier_ledger"].collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.courier_name, r.settlement_year, r.settlement_month, r.orders_count) == ("Ann", 2023, 11, 2)
    assert (r.orders_total_sum, r.order_processing_fee, r.rate_avg) == (D("4101.02"), D("1025.26"), 5)
    assert r.courier_order_sum == D("650.00")          # minimum per product line (T4)
    assert r.courier_tips_sum == D("100.00")           # tip of o1 counted per line (T5)
    assert r.courier_reward_sum == D("745.00")


def test_ledger_avg_rate_as_documented(wh):
    rows = build_marts(wh, "avg_rate")["dm_courier_ledger"].collect()
    r = rows[0]
    assert r.rate_avg == 5                             # 4.5 stored rounded, band 8 %
    assert r.courier_order_sum == D("495.00")
    assert r.courier_tips_sum == D("50.00")
    assert r.courier_reward_sum == D("542.50")


def test_restaurant_aware_product_join(spark):
    menus = dict(fx.MENUS)
    menus["r2"] = ("Rice", [("p3", "Plain", "20.00"), ("p1", "Pea too", "90.00")])   # p1 on two menus (T10)
    stg = fx.staging(spark, menus=menus)
    w = build_warehouse(spark, stg, floor=FLOOR)
    o1 = w["dm_orders"].where("order_key = 'o1'").first().id
    n_parity = w["fct_product_sales"].where(f"order_id = {o1}").count()
    aware = dds.build_product_sales(stg["events"], w["dm_products"], w["dm_orders"], None, floor=FLOOR,
                                    restaurant_aware=True)
    n_aware = aware.where(f"order_id = {o1}").count()
    assert (n_parity, n_aware) == (3, 2)


def test_unknown_courier_is_dropped(spark):
    stg = fx.staging(spark, deliveries=fx.DELIVERIES + [("o4", "c9", 5, "1.00")])   # T28
    w = build_warehouse(spark, stg, floor=FLOOR)
    assert sorted(r.order_id for r in w["deliveries"].collect()) == ["o1", "o2", "o3"]


def test_append_mode_duplicates_boundary_rows(spark, wh):
    stg = fx.staging(spark, deliveries=fx.DELIVERIES + [("o4", "c2", 5, "1.00")])
    w = build_warehouse(spark, stg, floor=FLOOR, orders_mode="append")
    cursor = w["srv_wf_settings_ts"]
    assert str(cursor.first().last_update_date) == "2023-11-02 10:00:00"
    again = dds.build_orders(stg["orders"], w["dm_users"], w["dm_restaurants"], w["dm_timestamps"],
                             w["deliveries"], w["dm_orders"], cursor=cursor, floor=FLOOR, mode="append")
    keys = sorted(r.order_key for r in again.collect())
    assert keys == ["o1", "o2", "o3", "o4", "o4"]      # T7: boundary order inserted again
    upserted = dds.build_orders(stg["orders"], w["dm_users"], w["dm_restaurants"], w["dm_timestamps"],
                                w["deliveries"], w["dm_orders"], cursor=cursor, floor=FLOOR, mode="upsert")
    assert sorted(r.order_key for r in upserted.collect()) == ["o1", "o2", "o3", "o4"]
    ids = [r.id for r in again.collect()]
    assert len(set(ids)) == len(ids)


def test_mart_refresh_keeps_ids_and_vanished_groups(spark, wh):
    rows = marts.settlement_report(wh["fct_product_sales"], wh["dm_orders"], wh["dm_restaurants"],
                                   wh["dm_timestamps"])
    empty = spark.createDataFrame([], marts.CDM["dm_settlement_report"])
    first = marts.refresh_mart(empty, rows, "dm_settlement_report")
    second = marts.refresh_mart(first, rows.limit(0), "dm_settlement_report")            # T20 upsert keeps it
    assert [r.id for r in second.collect()] == [r.id for r in first.collect()] == [1]
    assert marts.refresh_mart(first, rows.limit(0), "dm_settlement_report", mode="replace").count() == 0
