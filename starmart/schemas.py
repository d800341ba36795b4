"""Table and document schemas of the three layers (staging, detail, marts).

Schemas are Spark DDL strings so they read like the table definitions they mirror.
Surrogate ``id`` columns are plain ``bigint``: Parquet tables have no identity
columns, so ids are assigned by :func:`starmart.operators.keys.assign_surrogate`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

# ---- staging ---------------------------------------------------------------
STG = {
    "bonussystem_users": "id int, order_user_id string",
    "bonussystem_ranks": "id int, name string, bonus_percent decimal(19,5), min_payment_threshold decimal(19,5)",
    "bonussystem_events": "id bigint, event_ts timestamp_ntz, event_type string, event_value string",
    "srv_wf_settings_posgresql": "id int, workflow_key string, workflow_settings string",
    "ordersystem_users": "id bigint, object_id string, object_value string, update_ts timestamp_ntz",
    "ordersystem_orders": "id bigint, object_id string, object_value string, update_ts timestamp_ntz",
    "ordersystem_restaurants": "id bigint, object_id string, object_value string, update_ts timestamp_ntz",
    "srv_wf_settings_mongodb": "id smallint, last_update_ts timestamp_ntz",
    "couriers": "courier_info string",
    "deliveries": "deliveri_info string",
}

# ---- detail data store -----------------------------------------------------
DDS = {
    "srv_wf_settings_ts": "id smallint, last_update_date timestamp_ntz",
    "dm_users": "id bigint, user_id string, user_name string, user_login string",
    "dm_restaurants": "id bigint, restaurant_id string, restaurant_name string, active_from timestamp_ntz, active_to timestamp_ntz",
    "dm_products": ("id bigint, restaurant_id bigint, product_id string, product_name string, "
                    "product_price decimal(14,2), active_from timestamp_ntz, active_to timestamp_ntz"),
    "dm_timestamps": "id bigint, ts timestamp_ntz, year smallint, month smallint, day smallint, time string, date date",
    "couriers": "id bigint, courier_id string, courier_name string",
    "deliveries": "id bigint, order_id string, order_ts timestamp_ntz, courier_id bigint, rate smallint, tip_sum decimal(14,2)",
    "dm_orders": ("id bigint, user_id bigint, restaurant_id bigint, courier_id bigint, timestamp_id bigint, "
                  "order_key string, order_status string"),
    "fct_product_sales": ("id bigint, product_id bigint, order_id bigint, count int, price decimal(14,2), "
                          "total_sum decimal(14,2), bonus_payment decimal(14,2), bonus_grant decimal(14,2)"),
}

# ---- common data marts -----------------------------------------------------
CDM = {
    "dm_settlement_report": (
        "id bigint, restaurant_id bigint, restaurant_name string, settlement_date date, orders_count int, "
        "orders_total_sum decimal(14,2), orders_bonus_payment_sum decimal(14,2), "
        "orders_bonus_granted_sum decimal(14,2), order_processing_fee decimal(14,2), "
        "restaurant_reward_sum decimal(14,2)"),
    "dm_courier_ledger": (
        "id bigint, courier_id bigint, courier_name string, settlement_year smallint, settlement_month smallint, "
        "orders_count int, orders_total_sum decimal(14,2), rate_avg smallint, order_processing_fee decimal(14,2), "
        "courier_order_sum decimal(14,2), courier_tips_sum decimal(14,2), courier_reward_sum decimal(14,2)"),
}

LAYERS = {"stg": STG, "dds": DDS, "cdm": CDM}

# ---- documents (schema on read) -------------------------------------------
DOC_ORDER = "_id string, final_status string, date string, user struct<id:string>, restaurant struct<id:string>, update_ts string"
DOC_RESTAURANT = "_id string, name string, menu array<struct<_id:string,name:string,price:decimal(14,2)>>, update_ts string"
DOC_USER = "_id string, name string, login string, update_ts string"
DOC_EVENT = ("order_id string, product_payments array<struct<product_id:string,quantity:int,price:decimal(19,5),"
             "product_cost:decimal(19,5),bonus_payment:decimal(19,5),bonus_grant:decimal(19,5)>>")
DOC_COURIER = "_id string, name string"
DOC_DELIVERY = "order_id string, order_ts string, courier_id string, rate smallint, tip_sum decimal(14,2)"

# ---- key columns that upserts match on (unique constraints) ---------------
KEYS = {
    "stg.bonussystem_users": ["id"],
    "stg.bonussystem_ranks": ["id"],
    "stg.bonussystem_events": ["event_ts"],
    "stg.srv_wf_settings_posgresql": ["workflow_key"],
    "stg.ordersystem_users": ["object_id"],
    "stg.ordersystem_orders": ["object_id"],
    "stg.ordersystem_restaurants": ["object_id"],
    "stg.srv_wf_settings_mongodb": ["id"],
    "stg.couriers": ["courier_info"],
    "stg.deliveries": ["deliveri_info"],
    "dds.srv_wf_settings_ts": ["id"],
    "dds.dm_users": ["user_id"],
    "dds.dm_restaurants": ["restaurant_id"],
    "dds.dm_products": ["restaurant_id", "product_id"],
    "dds.dm_timestamps": ["ts"],
    "dds.couriers": ["courier_id"],
    "dds.deliveries": ["order_id", "order_ts"],
    "cdm.dm_settlement_report": ["restaurant_id", "settlement_date"],
    "cdm.dm_courier_ledger": ["courier_id", "settlement_year", "settlement_month"],
}

# Fixed values that must equal the source system's for right results.
OPEN_END = "2099-12-31 00:00:00"           # active_to of a current row
DEFAULT_FLOOR = "2023-10-22 00:00:00"      # first value of both timestamp cursors


def schema(qualified: str) -> StructType:
    """``schema('dds.dm_orders')`` -> StructType."""
    layer, name = qualified.split(".", 1)
    return StructType.fromDDL(LAYERS[layer][name])


def create_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Create every table of the three layers as an empty first version under
    ``root`` when it has none yet. Returns ``{qualified name: version}``."""
    from .plans.refresh import Warehouse
    wh = Warehouse(spark, root)
    out = {}
    for layer, tables in LAYERS.items():
        for name, ddl in tables.items():
            q = f"{layer}.{name}"
            if wh.version(q) is None:
                wh.write(q, spark.createDataFrame([], StructType.fromDDL(ddl)))
            out[q] = wh.version(q)
    return out
