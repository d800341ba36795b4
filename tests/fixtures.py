"""Golden data set (hand-made, see FIXTURES.md section 3) as staged frames."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import SparkSession

UPDATE_TS = "2023-10-25 00:00:00"
ORDERS = [  # object_id, user, restaurant, date, final_status
    ("o1", "u1", "r1", "2023-11-01 10:00:00", "CLOSED"),
    ("o2", "u2", "r1", "2023-11-01 12:00:00", "CLOSED"),
    ("o3", "u1", "r2", "2023-11-02 09:00:00", "CANCELLED"),
    ("o4", "u2", "r2", "2023-11-02 10:00:00", "CLOSED"),
]
DELIVERIES = [  # order, courier, rate, tip
    ("o1", "c1", 5, "50.00"), ("o2", "c1", 4, "0.00"), ("o3", "c2", 3, "10.00"),
]
PAYMENTS = [  # order, product, cost, bonus_payment, bonus_grant
    ("o1", "p1", "1000.00000", "100.00500", "45.00000"),
    ("o1", "p2", "3000.00000", "0.00000", "150.00000"),
    ("o2", "p2", "101.02000", "0.01000", "5.00000"),
    ("o3", "p3", "40.00000", "0.00000", "2.00000"),
    ("o4", "p3", "60.00000", "0.00000", "3.00000"),
]
MENUS = {"r1": ("Soup", [("p1", "Pea", "100.00"), ("p2", "Bean", "50.50")]), "r2": ("Rice", [("p3", "Plain", "20.00")])}


def _ts(s):
    import datetime as dt
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def order_doc(oid, user, rest, date, status):
    return json.dumps({"_id": oid, "final_status": status, "date": date, "user": {"id": user},
                       "restaurant": {"id": rest}, "update_ts": date})


def restaurant_doc(rid, name, menu):
    items = ", ".join(json.dumps({"_id": p, "name": n, "price": 0}).replace('"price": 0', f'"price": {price}')
                      for p, n, price in menu)
    return '{"_id": "%s", "name": "%s", "menu": [%s], "update_ts": "%s"}' % (rid, name, items, UPDATE_TS)


def event_doc(order, lines):
    pays = ", ".join('{"product_id": "%s", "quantity": 1, "price": %s, "product_cost": %s, "bonus_payment": %s, '
                     '"bonus_grant": %s}' % (p, cost, cost, bp, bg) for p, cost, bp, bg in lines)
    return '{"order_id": "%s", "product_payments": [%s]}' % (order, pays)


def staging(spark: SparkSession, orders=ORDERS, deliveries=DELIVERIES, payments=PAYMENTS, menus=MENUS,
            extra_events=True) -> dict:
    users = spark.createDataFrame(
        [(u, json.dumps({"_id": u, "name": u.upper(), "login": u}), _ts(UPDATE_TS)) for u in ("u1", "u2")],
        "object_id string, object_value string, update_ts timestamp_ntz")
    rests = spark.createDataFrame(
        [(r, restaurant_doc(r, n, m), _ts(UPDATE_TS)) for r, (n, m) in menus.items()],
        "object_id string, object_value string, update_ts timestamp_ntz")
    ords = spark.createDataFrame([(o[0], order_doc(*o), _ts(o[3])) for o in orders],
                                 "object_id string, object_value string, update_ts timestamp_ntz")
    couriers = spark.createDataFrame([(json.dumps({"_id": c, "name": n}),) for c, n in (("c1", "Ann"), ("c2", "Bo"))],
                                     "courier_info string")
    date_of = {o[0]: o[3] for o in orders}
    dl = spark.createDataFrame(
        [('{"order_id": "%s", "order_ts": "%s", "courier_id": "%s", "rate": %d, "tip_sum": %s}'
          % (o, date_of.get(o, "2023-11-01 00:00:00"), c, r, tip),) for o, c, r, tip in deliveries],
        "deliveri_info string")
    by_order = {}
    for o, p, cost, bp, bg in payments:
        by_order.setdefault(o, []).append((p, cost, bp, bg))
    evs = [(i + 1, _ts(date_of[o]), "bonus_transaction", event_doc(o, lines))
           for i, (o, lines) in enumerate(sorted(by_order.items()))]
    if extra_events:
        evs.append((100, _ts("2023-11-01 11:00:00"), "user_rank", '{"user_id": "u1", "rank": "gold"}'))
    events = spark.createDataFrame(evs, "id bigint, event_ts timestamp_ntz, event_type string, event_value string")
    return {"users": users, "restaurants": rests, "orders": ords, "couriers": couriers, "deliveries": dl,
            "events": events}


D = Decimal
