"""Detail data store jobs (J1-J9): staged documents -> dimensions and facts.

Every job is a function of DataFrames: it reads the staged rows at or after the
DDS cursor (inclusive, with a floor when no cursor exists), shreds the JSON once,
resolves natural keys to surrogate ids and returns the table's next snapshot.
Keyed tables are upserted; ``dm_orders`` and ``fct_product_sales`` have no
natural unique key in the source, so ``mode='append'`` reproduces the source's
plain inserts (reruns add boundary rows again) while the default
``mode='upsert'`` keys them on ``order_key`` / ``(product_id, order_id)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import casts
from ..functions.timefmt import timestamp_parts
from ..operators.keys import BROADCAST_MAX_ROWS, lookup, next_id, number_rows, with_surrogate
from ..operators.shred import explode_menu, explode_payments
from ..operators.upsert import check_unique, dedupe_last, max_cursor, upsert
from ..schemas import DDS, DEFAULT_FLOOR, DOC_DELIVERY, DOC_EVENT, DOC_ORDER, DOC_USER, OPEN_END
from ..sources.extract import since

SMALL_DIM_ROWS = BROADCAST_MAX_ROWS


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], StructType.fromDDL(DDS[table]))


def _since(df: DataFrame, col, cursor, floor) -> DataFrame:
    if cursor is None:
        return df.where(F.col(col) >= F.lit(floor).cast("timestamp_ntz")) if isinstance(col, str) \
            else df.where(col >= F.lit(floor).cast("timestamp_ntz"))
    return since(df, col, cursor, inclusive=True, floor=floor)


def merge_dimension(target: DataFrame | None, batch: DataFrame, keys, order_by=None, update_cols=None,
                    dedupe: str = "last", with_ids: bool = True, columns: list[str] | None = None) -> DataFrame:
    """Upsert ``batch`` into the dimension ``target`` (with ``id``) and give new
    natural keys the next surrogate ids. ``target=None`` is a first load (no
    table yet): the batch is deduplicated and numbered, nothing else runs."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if dedupe == "last":
        batch = dedupe_last(batch, keys, order_by)
    elif dedupe == "error":
        batch = check_unique(batch, keys)
    if target is None:
        cols = columns or [c for c in batch.columns if c != "id"]
        snap = batch.select(*cols)
        if not with_ids:
            return snap.select(F.lit(None).cast("bigint").alias("id"), *cols)
        return with_surrogate(snap, keys)
    # the id rides through the upsert as a column that is never updated: matched
    # keys keep theirs, new keys arrive with NULL and are numbered after max(id).
    # A batch proven small is broadcast, so the target is scanned, not shuffled.
    cols = [c for c in target.columns if c != "id"]
    update_cols = update_cols or [c for c in cols if c not in keys]
    b = batch.select(*cols, F.lit(None).cast("bigint").alias("id"))
    snap = upsert(target.select("id", *cols), b, keys, update_cols=update_cols, dedupe="none",
                  small_batch=SMALL_DIM_ROWS)
    if not with_ids:
        return snap
    known = snap.where(F.col("id").isNotNull())
    new = snap.where(F.col("id").isNull()).drop("id")
    numbered = number_rows(new, keys, start=next_id(target)).select("id", *cols)
    return known.unionByName(numbered)


def _columns(table: str) -> list[str]:
    return [f.name for f in StructType.fromDDL(DDS[table]).fields if f.name != "id"]


# ---- J1 users ----------------------------------------------------------------
def users_batch(stg_users: DataFrame, cursor=None, floor=DEFAULT_FLOOR) -> DataFrame:
    s = _since(stg_users, "update_ts", cursor, floor)
    # parsed in a projection of its own: several fields of one from_json are parsed one by one
    s = s.select("object_id", F.from_json("object_value", DOC_USER).alias("_d"), "update_ts")
    return s.select(F.col("object_id").alias("user_id"), F.col("_d.name").alias("user_name"),
                    F.col("_d.login").alias("user_login"), "update_ts")


def build_users(stg_users, target, cursor=None, floor=DEFAULT_FLOOR, with_ids=True) -> DataFrame:
    return merge_dimension(target, users_batch(stg_users, cursor, floor), "user_id", "update_ts",
                           with_ids=with_ids, columns=_columns("dm_users"))


# ---- J2 restaurants (SCD1 as coded: active_to untouched on update) ----------
def restaurants_batch(stg_restaurants: DataFrame, cursor=None, floor=DEFAULT_FLOOR) -> DataFrame:
    s = _since(stg_restaurants, "update_ts", cursor, floor)
    return s.select(F.col("object_id").alias("restaurant_id"),
                    F.get_json_object("object_value", "$.name").alias("restaurant_name"),
                    F.col("update_ts").alias("active_from"),
                    F.lit(OPEN_END).cast("timestamp_ntz").alias("active_to"))


def build_restaurants(stg_restaurants, target, cursor=None, floor=DEFAULT_FLOOR, with_ids=True) -> DataFrame:
    return merge_dimension(target, restaurants_batch(stg_restaurants, cursor, floor), "restaurant_id",
                           "active_from", update_cols=["restaurant_name", "active_from"], with_ids=with_ids,
                           columns=_columns("dm_restaurants"))


# ---- J3 timestamps --------------------------------------------------------------
def timestamps_batch(stg_orders: DataFrame, cursor=None, floor=DEFAULT_FLOOR) -> DataFrame:
    s = _since(stg_orders, "update_ts", cursor, floor)
    ts = casts.to_ts(F.get_json_object("object_value", "$.date"))
    return timestamp_parts(s.select(ts.alias("ts"), "update_ts"), "ts")


def build_timestamps(stg_orders, target, cursor=None, floor=DEFAULT_FLOOR, dedupe="last",
                     with_ids=True) -> DataFrame:
    """``dedupe='error'`` reproduces the source (two orders in one second abort
    the load); ``'last'`` keeps one row per timestamp."""
    return merge_dimension(target, timestamps_batch(stg_orders, cursor, floor), "ts", "update_ts",
                           dedupe=dedupe, with_ids=with_ids, columns=_columns("dm_timestamps"))


# ---- J4 couriers (no cursor) -------------------------------------------------------
def couriers_batch(stg_couriers: DataFrame) -> DataFrame:
    return stg_couriers.select(F.get_json_object("courier_info", "$._id").alias("courier_id"),
                               F.get_json_object("courier_info", "$.name").alias("courier_name"))


def build_couriers(stg_couriers, target, with_ids=True) -> DataFrame:
    return merge_dimension(target, couriers_batch(stg_couriers), "courier_id", "courier_name",
                           with_ids=with_ids, columns=_columns("couriers"))


# ---- J5 products ---------------------------------------------------------------------
def products_batch(stg_restaurants: DataFrame, restaurants: DataFrame, cursor=None,
                   floor=DEFAULT_FLOOR) -> DataFrame:
    s = _since(stg_restaurants, "update_ts", cursor, floor)
    items = explode_menu(s, keep=("object_id", "update_ts"))
    j = lookup(items, restaurants, {"object_id": "restaurant_id"},
               {"id": "restaurant_id", "active_from": "active_from", "active_to": "active_to"},
               broadcast_max_rows=SMALL_DIM_ROWS)
    return j.select("restaurant_id", "product_id", "product_name", "product_price", "active_from", "active_to",
                    "update_ts")


def build_products(stg_restaurants, restaurants, target, cursor=None, floor=DEFAULT_FLOOR, with_ids=True):
    return merge_dimension(target, products_batch(stg_restaurants, restaurants, cursor, floor),
                           ["restaurant_id", "product_id"], "update_ts", with_ids=with_ids,
                           columns=_columns("dm_products"))


# ---- J6 deliveries ---------------------------------------------------------------------
def deliveries_batch(stg_deliveries: DataFrame, couriers: DataFrame, cursor=None, floor=DEFAULT_FLOOR):
    d = stg_deliveries.select(F.from_json("deliveri_info", DOC_DELIVERY).alias("d"))
    d = d.select(F.col("d.order_id").alias("order_id"), casts.to_ts(F.col("d.order_ts")).alias("order_ts"),
                 F.col("d.courier_id").alias("_courier"), F.col("d.rate").alias("rate"),
                 F.col("d.tip_sum").alias("tip_sum"))
    d = _since(d, "order_ts", cursor, floor)
    j = lookup(d, couriers, {"_courier": "courier_id"}, {"id": "courier_id"}, broadcast_max_rows=SMALL_DIM_ROWS)
    return j.select("order_id", "order_ts", "courier_id", "rate", "tip_sum")


def build_deliveries(stg_deliveries, couriers, target, cursor=None, floor=DEFAULT_FLOOR, with_ids=True):
    batch = deliveries_batch(stg_deliveries, couriers, cursor, floor)
    return merge_dimension(target, batch, ["order_id", "order_ts"], "order_ts", with_ids=with_ids,
                           columns=_columns("deliveries"))


# ---- J7 orders -------------------------------------------------------------------------------
LOOKED_UP = {"user_id": "no user", "restaurant_id": "no restaurant", "timestamp_id": "no timestamp", "_delivered": "no delivery"}


def looked_up_orders(stg_orders: DataFrame, users, restaurants, timestamps, deliveries, cursor=None,
                     floor=DEFAULT_FLOOR, how: str = "inner") -> DataFrame:
    """Staged orders with what J7 looks up. With ``how="left"`` an order stays whose lookup misses, with NULL in that column of
    :data:`LOOKED_UP`: one pass then serves :func:`orders_batch` and :func:`order_rejects`."""
    s = _since(stg_orders, "update_ts", cursor, floor)
    s = s.select("object_id", F.from_json("object_value", DOC_ORDER).alias("_d"), "update_ts")      # parsed once
    o = s.select(F.col("object_id").alias("order_key"), F.col("_d.final_status").alias("order_status"),
                 F.col("_d.user.id").alias("_user"), F.col("_d.restaurant.id").alias("_rest"),
                 casts.to_ts(F.col("_d.date")).alias("_ts"), "update_ts")
    o = lookup(o, users, {"_user": "user_id"}, {"id": "user_id"}, how)
    o = lookup(o, restaurants, {"_rest": "restaurant_id"}, {"id": "restaurant_id"}, how, broadcast_max_rows=SMALL_DIM_ROWS)
    o = lookup(o, timestamps, {"_ts": "ts"}, {"id": "timestamp_id"}, how)
    o = lookup(o, deliveries, {"order_key": "order_id"}, {"courier_id": "courier_id", "order_id": "_delivered"}, how)
    return o.select("user_id", "restaurant_id", "courier_id", "timestamp_id", "order_key", "order_status",
                    "update_ts", "_delivered")


def orders_batch(stg_orders: DataFrame, users=None, restaurants=None, timestamps=None, deliveries=None, cursor=None,
                 floor=DEFAULT_FLOOR) -> DataFrame:
    """Rows of ``dm_orders``, from staged orders or from what :func:`looked_up_orders` kept of them (``how="left"``)."""
    if "_delivered" in stg_orders.columns:
        o = stg_orders.dropna(subset=list(LOOKED_UP))
    else:
        o = looked_up_orders(stg_orders, users, restaurants, timestamps, deliveries, cursor, floor)
    return o.drop("_delivered")


def order_rejects(stg_orders: DataFrame, users=None, restaurants=None, timestamps=None, deliveries=None, cursor=None,
                  floor=DEFAULT_FLOOR) -> DataFrame:
    """Staged orders the inner lookups of J7 lose, with the missed lookup; also from what :func:`looked_up_orders` kept of them."""
    from ..operators.keys import lookup_rejects
    if "_delivered" in stg_orders.columns:
        return lookup_rejects(stg_orders, [(reason, None, c) for c, reason in LOOKED_UP.items()], ["order_key"])
    s = _since(stg_orders, "update_ts", cursor, floor)
    s = s.select("object_id", F.from_json("object_value", DOC_ORDER).alias("_d"))
    o = s.select(F.col("object_id").alias("order_key"), F.col("_d.user.id").alias("_user"),
                 F.col("_d.restaurant.id").alias("_rest"), casts.to_ts(F.col("_d.date")).alias("_ts"))
    return lookup_rejects(o, [("no user", users, {"_user": "user_id"}),
                              ("no restaurant", restaurants, {"_rest": "restaurant_id"}),
                              ("no timestamp", timestamps, {"_ts": "ts"}),
                              ("no delivery", deliveries, {"order_key": "order_id"})], ["order_key"])


def build_orders(stg_orders, users, restaurants, timestamps, deliveries, target, cursor=None,
                 floor=DEFAULT_FLOOR, mode: str = "upsert") -> DataFrame:
    batch = orders_batch(stg_orders, users, restaurants, timestamps, deliveries, cursor, floor)
    cols = _columns("dm_orders")
    if mode == "append":
        new = number_rows(batch.select(*cols), ["order_key", "timestamp_id", "courier_id"],
                          start=next_id(target) if target is not None else 1).select("id", *cols)
        return new if target is None else target.unionByName(new)
    if mode == "upsert":
        return merge_dimension(target, batch, "order_key", ["update_ts", "courier_id"], columns=cols)
    raise ValueError("mode must be 'append' or 'upsert'")


# ---- J8 product sales ----------------------------------------------------------------------
def sales_batch(stg_events: DataFrame, products, orders, cursor=None, floor=DEFAULT_FLOOR,
                restaurant_aware: bool = False) -> DataFrame:
    """Payments -> (product id, order id) sums. Amounts are summed at scale 5 and
    rounded to scale 2 once, when stored. An event meets its order before its payments are taken apart, and these are
    summed where they lie, per order and named product: the products then meet the sums. ``_doc`` holds events parsed already."""
    s = _since(stg_events, "event_ts", cursor, floor)
    e = s.select(F.col("_doc") if "_doc" in s.columns else F.from_json("event_value", DOC_EVENT).alias("_doc"))
    o = orders.select(F.col("id").alias("order_id_sk"), F.col("order_key").alias("_ok"),
                      F.col("restaurant_id").alias("_ord_rest"))
    e = e.select("_doc", F.col("_doc.order_id").alias("_named")).join(o, F.col("_named") == F.col("_ok"))
    p = explode_payments(e, "_doc", keep=("_named", "order_id_sk", "_ord_rest"))
    j = p.groupBy("_named", "order_id_sk", "_ord_rest", "product_id").agg(
        F.sum("count").alias("count"), F.sum("price").alias("price"), F.sum("total_sum").alias("total_sum"),
        F.sum("bonus_payment").alias("bonus_payment"), F.sum("bonus_grant").alias("bonus_grant"))
    prod = products.select(F.col("id").alias("product_id_sk"), F.col("product_id").alias("_pid"),
                           F.col("restaurant_id").alias("_prod_rest"))
    cond = j["product_id"] == prod["_pid"]
    if restaurant_aware:
        cond = cond & (j["_ord_rest"] == prod["_prod_rest"])
    g = j.join(prod, cond)      # ids are unique, so no (product, order) comes twice
    g = g.select(F.col("product_id_sk").alias("product_id"), F.col("order_id_sk").alias("order_id"),
                 "count", "price", "total_sum", "bonus_payment", "bonus_grant")
    return casts.conform(g, StructType(StructType.fromDDL(DDS["fct_product_sales"]).fields[1:]))


def build_product_sales(stg_events, products, orders, target, cursor=None, floor=DEFAULT_FLOOR,
                        mode: str = "upsert", restaurant_aware: bool = False) -> DataFrame:
    batch = sales_batch(stg_events, products, orders, cursor, floor, restaurant_aware)
    cols = _columns("fct_product_sales")
    if mode == "append":
        new = number_rows(batch, ["order_id", "product_id"],
                          start=next_id(target) if target is not None else 1).select("id", *cols)
        return new if target is None else target.unionByName(new)
    if mode == "upsert":
        return merge_dimension(target, batch, ["product_id", "order_id"], dedupe="none", columns=cols)
    raise ValueError("mode must be 'append' or 'upsert'")


# ---- J9 cursor ---------------------------------------------------------------------------------
def advance_cursor(stg_orders: DataFrame, cursors: DataFrame | None) -> DataFrame:
    """``srv_wf_settings_ts`` next snapshot: id 1 = max(update_ts) of staged orders;
    an empty staging table keeps the previous value."""
    new = stg_orders.agg(max_cursor(stg_orders, "update_ts").alias("last_update_date"))
    new = new.select(F.lit(1).cast("smallint").alias("id"), "last_update_date").where(
        F.col("last_update_date").isNotNull())
    return new if cursors is None else upsert(cursors, new, "id", dedupe="none")
