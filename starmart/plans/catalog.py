"""Query catalogue: one entry per operator of the blueprint's inventory.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``.
Every query reads the driver tables (whole tables, no sampling or id subsets)
through the source mapping of :mod:`starmart.plans.landing` and runs the
library's operator on them; the oracle restates the answer in DuckDB SQL over
the raw columns. Cut dates below are cursor / window values, i.e. the feature
under test, not row caps.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import dds, landing, marts, oracle as O
from .landing import Tables
from .refresh import build_marts, build_warehouse
from ..functions import casts, json as J, money
from ..functions.timefmt import format_datetime, parse_datetime, timestamp_parts
from ..operators import keys as K, quality as Q, scd2, shred, upsert as U
from ..schemas import DDS, DOC_DELIVERY, DOC_ORDER, DOC_RESTAURANT
from ..sources import api, documents, extract

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


FLOOR = landing.FIRST_LOAD_FLOOR

_STAGING: dict = {}


def _stg(spark: SparkSession, sf: str) -> dict:
    """The staging layer derived from the driver tables, each table written once per session
    and source folder as it is first read (the detail-layer jobs of the source system read stored
    staging tables too)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STAGING:
        _STAGING[key] = landing.staging(Tables(spark, sf), materialise=True)
    return _STAGING[key]


# ============================== A: sources ==============================
OUTBOX_CUT = "2024-01-15 00:00:00"


@query("extract_outbox_by_id", f"""
SELECT event_id AS id, ts AS event_ts, event_type, props AS event_value FROM events
WHERE event_id > (SELECT coalesce(max(event_id), 0) FROM events WHERE ts < TIMESTAMP '{OUTBOX_CUT}')""")
def q_extract_outbox_by_id(spark, sf):
    ob = landing.outbox(Tables(spark, sf))
    loaded = ob.where(F.col("event_ts") < _ts(OUTBOX_CUT))
    settings = U.cursor_per_type(loaded, "event_type", "id", "event_value")   # cursor table of the last run
    return extract.extract_incremental(ob, "id", extract.cursor_value(settings, "id"))


@query("extract_full_snapshot", "SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS order_user_id FROM customer")
def q_extract_full_snapshot(spark, sf):
    c = Tables(spark, sf)["customer"].select(F.col("c_custkey").alias("id"),
                                             F.col("c_custkey").cast("string").alias("order_user_id"))
    return extract.extract_full(c, "id bigint, order_user_id string")


@query("stage_documents_full", f"""
SELECT CAST(c_custkey AS VARCHAR) object_id,
       json_object('_id', CAST(c_custkey AS VARCHAR), 'name', c_name, 'login', lower(c_name),
                   'update_ts', strftime({O.U_TS}, {O.FMT}))::VARCHAR object_value,
       {O.U_TS} update_ts
FROM customer""")
def q_stage_documents_full(spark, sf):
    return documents.stage_documents(landing.users_collection(Tables(spark, sf)))


DOC_CUT = "1998-01-01 00:00:00"


@query("stage_documents_incremental", f"""
SELECT CAST(o_orderkey AS VARCHAR) object_id, {O.order_doc()} object_value, o_orderdate update_ts FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{DOC_CUT}')""")
def q_stage_documents_incremental(spark, sf):
    coll = landing.orders_collection(Tables(spark, sf))
    # cursor = newest update_ts of the previous load
    prev = coll.where(F.col("update_ts") < _ts(DOC_CUT)).select(F.col("update_ts").alias("last_update_ts"))
    return documents.stage_documents(coll, cursor=prev)


def extended_json_orders(t: Tables) -> DataFrame:
    """Orders as a document-store export in Extended JSON (object ids and dates wrapped)."""
    o = t["orders"]
    oid = F.lpad(F.lower(F.hex("o_orderkey")), 24, "0")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    text = F.to_json(F.struct(
        F.struct(oid.alias("$oid")).alias("_id"), landing._status("o_orderstatus").alias("final_status"),
        F.struct(iso.alias("$date")).alias("date"),
        F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"),
        F.struct((F.col("o_orderkey") % landing.n_suppliers(t)).cast("string").alias("id")).alias("restaurant"),
        F.struct(iso.alias("$date")).alias("update_ts")))
    schema = ("`_id` struct<`$oid`:string>, final_status string, date struct<`$date`:string>, "
              "user struct<id:string>, restaurant struct<id:string>, update_ts struct<`$date`:string>")
    return o.select(F.from_json(text, schema).alias("d")).select("d.*")


@query("normalise_documents", f"""
SELECT lpad(lower(hex(o_orderkey)), 24, '0') object_id,
       {O.order_doc("lpad(lower(hex(o_orderkey)), 24, '0')")} object_value, o_orderdate update_ts
FROM orders""")
def q_normalise_documents(spark, sf):
    return documents.stage_documents(extended_json_orders(Tables(spark, sf)))


@query("stage_api_snapshot", """
SELECT json_object('_id', CAST(n_nationkey AS VARCHAR), 'name', n_name)::VARCHAR courier_info FROM nation""")
def q_stage_api_snapshot(spark, sf):
    staged = api.stage_api(landing.courier_items(Tables(spark, sf)), "courier_info")
    empty = spark.createDataFrame([], "courier_info string")
    return U.insert_absent(empty, staged, canonical_json="courier_info")


API_RUN_DATE = "1998-08-02 00:00:00"


PAGE_ROWS = 50      # fixed value: rows of a page of the endpoint


@query("stage_api_paged", """
SELECT CAST(o_orderkey AS VARCHAR) order_id, o_orderdate order_ts, CAST(c_nationkey AS VARCHAR) courier_id,
       CAST(1 + o_orderkey % 5 AS SMALLINT) rate, CAST(o_orderkey % 200 AS DECIMAL(14,2)) tip_sum
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'O'""")
def q_stage_api_paged(spark, sf):
    """All pages of the endpoint up to its empty one, read by a stream whose offset is the next page."""
    from ..sources.pages import LandedPages
    from ..streaming.streams import ingest_once
    spark.dataSource.register(LandedPages)
    landed, ckpt, tables = _stream_dirs(spark, "pages")
    landing.land_pages(Tables(spark, sf), landed, PAGE_ROWS)
    for _ in range(2):      # the second run finds no new page
        ingest_once(spark.readStream.format("landed_pages").option("path", landed).load(), tables, ckpt)
    d = F.from_json("item", DOC_DELIVERY)
    return spark.read.parquet(tables).select(d["order_id"].alias("order_id"), casts.to_ts(d["order_ts"]).alias("order_ts"),
                                             d["courier_id"].alias("courier_id"), d["rate"].alias("rate"), d["tip_sum"].alias("tip_sum"))


@query("stage_api_window", f"""
SELECT CAST(o_orderkey AS VARCHAR) order_id, o_orderdate order_ts, CAST(c_nationkey AS VARCHAR) courier_id,
       CAST(1 + o_orderkey % 5 AS SMALLINT) rate, CAST(o_orderkey % 200 AS DECIMAL(14,2)) tip_sum
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus <> 'O' AND o_orderdate >= TIMESTAMP '{API_RUN_DATE}' - INTERVAL 7 DAY
  AND o_orderdate < TIMESTAMP '{API_RUN_DATE}'""")
def q_stage_api_window(spark, sf):
    t = Tables(spark, sf)
    runs = spark.range(1).select(_ts(API_RUN_DATE).alias("run_date"), F.lit(None).cast("timestamp_ntz").alias("prev"))
    w = extract.run_window(runs, "run_date", "prev").first()
    docs = api.stage_api(landing.delivery_items(t), "deliveri_info", window=(w.window_from, w.window_to),
                         ts_col="order_ts")
    d = F.from_json("deliveri_info", DOC_DELIVERY)
    return docs.select(d["order_id"].alias("order_id"), casts.to_ts(d["order_ts"]).alias("order_ts"),
                       d["courier_id"].alias("courier_id"), d["rate"].alias("rate"), d["tip_sum"].alias("tip_sum"))


@query("run_window", """
SELECT o_orderkey run_id,
       coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate - INTERVAL 1 DAY END,
                o_orderdate - INTERVAL 7 DAY) window_from,
       o_orderdate window_to
FROM orders""")
def q_run_window(spark, sf):
    o = Tables(spark, sf)["orders"]
    # run log: one run per order date; cancelled runs lost their stored date
    log = o.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("run_date"),
                   F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") - F.expr("INTERVAL 1 DAY"))
                   .alias("prev_run_date"))
    return extract.run_window(log, "run_date", "prev_run_date").select("run_id", "window_from", "window_to")


# ============================== B: sinks, upserts, keys ==============================
USERS_SQL = f"(SELECT c_custkey, c_name, {O.U_TS} ts FROM customer)"
TARGET_CUT = "1996-06-01 00:00:00"
BATCH_FROM = "1996-01-01 00:00:00"


def _users(t: Tables) -> DataFrame:
    c = landing.users_collection(t)
    return c.select(F.col("_id").alias("user_id"), F.col("name").alias("user_name"),
                    F.col("login").alias("user_login"), "update_ts")


@query("upsert_last_wins", f"""
SELECT CAST(c_custkey AS VARCHAR) user_id,
       CASE WHEN ts >= TIMESTAMP '{BATCH_FROM}' THEN upper(c_name) ELSE c_name END user_name,
       lower(c_name) user_login
FROM {USERS_SQL} WHERE ts < TIMESTAMP '{TARGET_CUT}' OR ts >= TIMESTAMP '{BATCH_FROM}'""")
def q_upsert_last_wins(spark, sf):
    u = _users(Tables(spark, sf))
    target = u.where(F.col("update_ts") < _ts(TARGET_CUT)).drop("update_ts")
    b = u.where(F.col("update_ts") >= _ts(BATCH_FROM))
    # two versions per user in one batch: the later one must win
    v1 = b.withColumn("user_name", F.concat("user_name", F.lit(" (old)")))
    v2 = b.withColumn("user_name", F.upper("user_name")).withColumn(
        "update_ts", F.col("update_ts") + F.expr("INTERVAL 1 HOUR"))
    return U.upsert(target, v1.unionByName(v2), "user_id", dedupe="last", order_by="update_ts")


@query("upsert_partial_columns", f"""
SELECT CAST(s_suppkey AS VARCHAR) restaurant_id, upper(s_name) restaurant_name,
       {O.S_TS} + INTERVAL 30 DAY active_from,
       CASE WHEN {O.S_TS} < TIMESTAMP '{TARGET_CUT}' THEN {O.S_TS} + INTERVAL 365 DAY
            ELSE TIMESTAMP '2099-12-31' END active_to
FROM supplier""")
def q_upsert_partial_columns(spark, sf):
    s = dds.restaurants_batch(_stg(spark, sf)["restaurants"], floor=FLOOR)
    target = s.where(F.col("active_from") < _ts(TARGET_CUT)).withColumn(
        "active_to", F.col("active_from") + F.expr("INTERVAL 365 DAY"))
    batch = s.withColumns({"restaurant_name": F.upper("restaurant_name"),
                           "active_from": F.col("active_from") + F.expr("INTERVAL 30 DAY")})
    return U.upsert(target, batch, "restaurant_id", update_cols=["restaurant_name", "active_from"],
                    dedupe="last", order_by="active_from")


EV_TARGET_CUT = "2024-01-20 00:00:00"
EV_BATCH_FROM = "2024-01-10 00:00:00"


@query("upsert_alternate_key", f"""
SELECT CASE WHEN ts >= TIMESTAMP '{EV_BATCH_FROM}' THEN event_id + 1000000 ELSE event_id END id, ts event_ts,
       event_type, CASE WHEN ts >= TIMESTAMP '{EV_BATCH_FROM}' THEN upper(props) ELSE props END event_value
FROM events""")
def q_upsert_alternate_key(spark, sf):
    ob = landing.outbox(Tables(spark, sf))
    target = ob.where(F.col("event_ts") < _ts(EV_TARGET_CUT))
    batch = ob.where(F.col("event_ts") >= _ts(EV_BATCH_FROM)).withColumns(
        {"id": F.col("id") + 1000000, "event_value": F.upper("event_value")})
    # conflict on event_ts: the stored id is overwritten by the batch's id
    return U.upsert(target, batch, "event_ts", dedupe="last", order_by="id")


DLV_CUT = "1998-01-01 00:00:00"
DLV_FROM = "1997-01-01 00:00:00"


@query("insert_if_absent", """
SELECT CAST(o_orderkey AS VARCHAR) order_id, o_orderdate order_ts, CAST(c_nationkey AS VARCHAR) courier_id,
       CAST(1 + o_orderkey % 5 AS SMALLINT) rate, CAST(o_orderkey % 200 AS DECIMAL(14,2)) tip_sum
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'O'""")
def q_insert_if_absent(spark, sf):
    items = landing.delivery_items(Tables(spark, sf))
    target = api.stage_api(items.where(F.col("order_ts") < DLV_CUT), "deliveri_info")
    later = items.where(F.col("order_ts") >= DLV_FROM)
    # the same documents sent again with another key order and number format
    resent = later.select(J.to_document(F.col("tip_sum").cast("double").alias("tip_sum"), "rate", "courier_id",
                                        "order_ts", "order_id").alias("deliveri_info"))
    batch = api.stage_api(later, "deliveri_info").unionByName(resent)
    snap = U.insert_absent(target, batch, canonical_json="deliveri_info")
    d = F.from_json("deliveri_info", DOC_DELIVERY)
    return snap.select(d["order_id"].alias("order_id"), casts.to_ts(d["order_ts"]).alias("order_ts"),
                       d["courier_id"].alias("courier_id"), d["rate"].alias("rate"), d["tip_sum"].alias("tip_sum"))


@query("jsonb_canonical", """
SELECT '{"k":' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) || '}' doc, 3 * count(*) copies
FROM events GROUP BY 1""")
def q_jsonb_canonical(spark, sf):
    p = Tables(spark, sf)["events"].select("props")
    k = F.get_json_object("props", "$.k")
    variants = p.unionByName(p.select(F.concat(F.lit('{ "k" : '), k, F.lit(".0 }")).alias("props"))) \
                .unionByName(p.select(F.concat(F.lit('{"k":'), k, F.lit("}")).alias("props")))
    return variants.groupBy(J.canonical("props").alias("doc")).agg(F.count(F.lit(1)).alias("copies"))


@query("append_boundary_duplicates", """
SELECT CAST(o_orderkey AS VARCHAR) order_key, CASE o_orderstatus WHEN 'F' THEN 'CLOSED' ELSE 'CANCELLED' END order_status
FROM orders WHERE o_orderstatus <> 'O'
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), CASE o_orderstatus WHEN 'F' THEN 'CLOSED' ELSE 'CANCELLED' END
FROM orders WHERE o_orderstatus <> 'O' AND o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def q_append_boundary_duplicates(spark, sf):
    t = Tables(spark, sf)
    stg = _stg(t.spark, t.sf_dir)
    w = _warehouse(spark, sf, "dm_users", "dm_restaurants", "dm_timestamps", "deliveries")
    first = dds.build_orders(stg["orders"], w["dm_users"], w["dm_restaurants"], w["dm_timestamps"],
                             w["deliveries"], None, floor=FLOOR, mode="append")
    cursor = dds.advance_cursor(stg["orders"], dds.empty(spark, "srv_wf_settings_ts"))
    # second run with the inclusive cursor: boundary orders are inserted again
    second = dds.build_orders(stg["orders"], w["dm_users"], w["dm_restaurants"], w["dm_timestamps"],
                              w["deliveries"], first, cursor=cursor, floor=FLOOR, mode="append")
    return second.select("order_key", "order_status")


LI_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice"]


@query("dedupe_last", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC) rn FROM lineitem)
WHERE rn = 1""")
def q_dedupe_last(spark, sf):
    li = Tables(spark, sf)["lineitem"].select(*LI_COLS)
    return U.dedupe_last(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_quantity",
                                                               "l_extendedprice"])


@query("duplicate_key_report", """
SELECT l_orderkey, l_linenumber, count(*) n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_duplicate_key_report(spark, sf):
    return U.duplicate_keys(Tables(spark, sf)["lineitem"], ["l_orderkey", "l_linenumber"])


@query("cursor_max_ts", """
SELECT CAST(1 AS SMALLINT) id, max(o_orderdate) last_update_date FROM orders""")
def q_cursor_max_ts(spark, sf):
    t = Tables(spark, sf)
    prev = spark.createDataFrame([(1, None)], "id smallint, last_update_date timestamp_ntz").where("false")
    return dds.advance_cursor(_stg(t.spark, t.sf_dir)["orders"], prev)


@query("cursor_per_type", """
SELECT max(event_id) id, event_type workflow_key, arg_max(props, event_id) workflow_settings
FROM events GROUP BY event_type""")
def q_cursor_per_type(spark, sf):
    return U.cursor_per_type(landing.outbox(Tables(spark, sf)), "event_type", "id", "event_value")


SK_CUT = "1996-01-01 00:00:00"


@query("surrogate_keys", f"""
WITH u AS (SELECT CAST(c_custkey AS VARCHAR) user_id, ts FROM {USERS_SQL}),
k AS (SELECT user_id, row_number() OVER (ORDER BY user_id) id FROM u WHERE ts < TIMESTAMP '{SK_CUT}'),
n AS (SELECT user_id, (SELECT count(*) FROM k) + row_number() OVER (ORDER BY user_id) id
      FROM u WHERE user_id NOT IN (SELECT user_id FROM k))
SELECT user_id, CAST(id AS BIGINT) id FROM k UNION ALL SELECT user_id, CAST(id AS BIGINT) FROM n""")
def q_surrogate_keys(spark, sf):
    u = _users(Tables(spark, sf))
    known = K.number_rows(u.where(F.col("update_ts") < _ts(SK_CUT)).select("user_id"), "user_id")
    return K.assign_surrogate(u, known, "user_id")


@query("apply_defaults", O.with_(O.PAY) + """SELECT order_id, product_id, count, total_sum,
     CAST(0 AS DECIMAL(19,5)) bonus_payment, CAST(0 AS DECIMAL(19,5)) bonus_grant FROM pay""")
def q_apply_defaults(spark, sf):
    pays = shred.explode_payments(_stg(spark, sf)["events"])
    schema = StructType.fromDDL("order_id string, product_id string, count int, total_sum decimal(19,5), "
                                "bonus_payment decimal(19,5), bonus_grant decimal(19,5)")
    insert = pays.select("order_id", "product_id", "count", "total_sum")   # bonus columns not in the insert list
    return U.apply_defaults(insert, {"bonus_payment": 0, "bonus_grant": 0}, schema)


# ============================== C, D: predicates and scalar functions ==============================
CURSOR_CUT = "1998-01-01 00:00:00"


def _stored_cursor(t: Tables) -> DataFrame:
    """DDS cursor table as a previous run left it (newest order before the cut)."""
    prev = _stg(t.spark, t.sf_dir)["orders"].where(F.col("update_ts") < _ts(CURSOR_CUT))
    return dds.advance_cursor(prev, dds.empty(t.spark, "srv_wf_settings_ts"))


@query("cursor_filter_inclusive", f"""
SELECT CAST(o_orderkey AS VARCHAR) object_id, o_orderdate update_ts FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{CURSOR_CUT}')""")
def q_cursor_filter_inclusive(spark, sf):
    t = Tables(spark, sf)
    s = extract.since(_stg(t.spark, t.sf_dir)["orders"], "update_ts", _stored_cursor(t), inclusive=True,
                      floor="2023-10-22 00:00:00")
    return s.select("object_id", "update_ts")


@query("cursor_default_floor", f"""
SELECT CAST(o_orderkey AS VARCHAR) object_id, o_orderdate update_ts FROM orders
WHERE o_orderdate >= TIMESTAMP '{CURSOR_CUT}'""")
def q_cursor_default_floor(spark, sf):
    t = Tables(spark, sf)
    empty_cursor = dds.empty(spark, "srv_wf_settings_ts")
    s = extract.since(_stg(t.spark, t.sf_dir)["orders"], "update_ts", empty_cursor, inclusive=True, floor=CURSOR_CUT)
    return s.select("object_id", "update_ts")


@query("cursor_filter_strict", f"""
SELECT CAST(o_orderkey AS VARCHAR) object_id, o_orderdate update_ts FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{CURSOR_CUT}')""")
def q_cursor_filter_strict(spark, sf):
    t = Tables(spark, sf)
    s = extract.since(_stg(t.spark, t.sf_dir)["orders"], "update_ts", _stored_cursor(t), inclusive=False)
    return s.select("object_id", "update_ts")


@query("filter_status", """
SELECT CAST(o_orderkey AS VARCHAR) order_key, 'CLOSED' order_status FROM orders WHERE o_orderstatus = 'F'""")
def q_filter_status(spark, sf):
    s = _stg(spark, sf)["orders"]
    d = J.parse("object_value", DOC_ORDER)
    o = s.select(F.col("object_id").alias("order_key"), d["final_status"].alias("order_status"))
    return o.where(F.col("order_status") == marts.CLOSED)


@query("json_text_field", f"""
SELECT CAST(o_orderkey AS VARCHAR) object_id, {O.STATUS} final_status, strftime(o_orderdate, {O.FMT}) date
FROM orders""")
def q_json_text_field(spark, sf):
    s = _stg(spark, sf)["orders"]
    return s.select("object_id", J.json_text("object_value", "final_status").alias("final_status"),
                    J.json_text("object_value", "date").alias("date"))


@query("json_nested_field", f"""
SELECT CAST(o_orderkey AS VARCHAR) object_id, CAST(o_custkey AS VARCHAR) user_id,
       CAST(o_orderkey % {O.NS} AS VARCHAR) restaurant_id FROM orders""")
def q_json_nested_field(spark, sf):
    s = _stg(spark, sf)["orders"]
    return s.select("object_id", J.json_path("object_value", "user", "id").alias("user_id"),
                    J.json_path("object_value", "restaurant", "id").alias("restaurant_id"))


@query("json_parse_quarantine", """
SELECT CAST(o_orderkey AS VARCHAR) object_id,
       CASE WHEN o_orderstatus = 'P' THEN 'malformed json' ELSE 'missing date' END reason
FROM orders WHERE o_orderstatus IN ('P', 'O')""")
def q_json_parse_quarantine(spark, sf):
    s = _stg(spark, sf)["orders"]
    st = F.get_json_object("object_value", "$.final_status")
    # a damaged export: cancelled orders cut short, open orders without their date
    broken = s.withColumn("object_value", F.when(st == "CANCELLED", F.expr("substr(object_value, 1, length(object_value) - 1)"))
                          .when(st == "OPEN", F.regexp_replace("object_value", '"date":"[^"]*",', ""))
                          .otherwise(F.col("object_value")))
    good, bad = Q.quarantine(broken, "object_value", DOC_ORDER, required=["final_status", "date"])
    return bad.select("object_id", "reason")


@query("cast_timestamp", """
SELECT CAST(o_orderkey AS VARCHAR) order_id, o_orderdate order_ts FROM orders WHERE o_orderstatus <> 'O'""")
def q_cast_timestamp(spark, sf):
    s = _stg(spark, sf)["deliveries"]
    return s.select(J.json_text("deliveri_info", "order_id").alias("order_id"),
                    casts.to_ts(J.json_text("deliveri_info", "order_ts")).alias("order_ts"))


@query("timestamp_parts", """
SELECT DISTINCT o_orderdate ts, CAST(year(o_orderdate) AS SMALLINT) AS year, CAST(month(o_orderdate) AS SMALLINT) AS month,
       CAST(day(o_orderdate) AS SMALLINT) AS day, strftime(o_orderdate, '%H:%M:%S') AS time, CAST(o_orderdate AS DATE) AS date
FROM orders""")
def q_timestamp_parts(spark, sf):
    b = dds.timestamps_batch(_stg(spark, sf)["orders"], floor=FLOOR)
    return b.drop("update_ts").dropDuplicates(["ts"])


@query("cast_integers", """
SELECT CAST(o_orderkey AS VARCHAR) order_id, CAST(1 + o_orderkey % 5 AS SMALLINT) rate,
       CAST(o_orderkey % 200 AS INTEGER) tip_whole FROM orders WHERE o_orderstatus <> 'O'""")
def q_cast_integers(spark, sf):
    s = _stg(spark, sf)["deliveries"]
    return s.select(J.json_text("deliveri_info", "order_id").alias("order_id"),
                    casts.to_int(J.json_text("deliveri_info", "rate"), "smallint").alias("rate"),
                    casts.to_int(J.json_text("deliveri_info", "tip_sum"), "int").alias("tip_whole"))


@query("cast_decimals", O.with_(O.PAY) + """
SELECT order_id, product_id, total_sum, CAST(bonus_payment AS DECIMAL(14,2)) bonus_payment_2,
       CAST(bonus_grant AS DECIMAL(14,2)) bonus_grant_2 FROM pay""")
def q_cast_decimals(spark, sf):
    ev = _stg(spark, sf)["events"]
    # each document is parsed once; its fields stay the texts they are written as
    d = F.from_json("event_value", "order_id string, product_payments array<struct<product_id string, product_cost string, "
                                   "bonus_payment string, bonus_grant string>>")
    items = ev.select(d.alias("d")).select(F.col("d.order_id").alias("order_id"), F.explode("d.product_payments").alias("p"))
    txt = lambda f: F.col("p")[f]
    return items.select("order_id", txt("product_id").alias("product_id"),
                        casts.to_decimal(txt("product_cost"), 19, 5).alias("total_sum"),
                        casts.to_decimal(txt("bonus_payment"), 14, 2).alias("bonus_payment_2"),
                        casts.to_decimal(txt("bonus_grant"), 14, 2).alias("bonus_grant_2"))


@query("trim_chars", """
SELECT event_id, trim(props, '{}') inner_text, trim(c_name, 'C#0') trimmed_name
FROM events JOIN customer ON user_id = c_custkey""")
def q_trim_chars(spark, sf):
    t = Tables(spark, sf)
    e, c = t["events"], t["customer"]
    j = e.join(c, e["user_id"] == c["c_custkey"])
    return j.select("event_id", J.trim_chars("props", "{}").alias("inner_text"),
                    J.trim_chars("c_name", "C#0").alias("trimmed_name"))


@query("text_replace", """
SELECT event_id, replace(props, '": ', '"=') replaced FROM events""")
def q_text_replace(spark, sf):
    e = Tables(spark, sf)["events"]
    return e.select("event_id", J.replace("props", '": ', '"=').alias("replaced"))


@query("text_split", """
SELECT c_custkey, CAST(len(string_split(c_name, '#')) AS INTEGER) n_parts, string_split(c_name, '#')[1] first_part,
       string_split(c_name, '#')[-1] last_part,
       CAST(len(CASE WHEN c_mktsegment = 'BUILDING' THEN [] ELSE string_split(c_mktsegment, 'I') END) AS INTEGER) n_seg
FROM customer""")
def q_text_split(spark, sf):
    c = Tables(spark, sf)["customer"]
    parts = J.split_text("c_name", "#")
    # an empty text gives an empty array (not [''])
    seg = J.split_text(F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.col("c_mktsegment")), "I")
    return c.select("c_custkey", F.size(parts).alias("n_parts"), parts[0].alias("first_part"),
                    F.element_at(parts, -1).alias("last_part"), F.size(seg).alias("n_seg"))


MENU_SQL = f"""
SELECT CAST(p_partkey % {O.NS} AS VARCHAR) restaurant_id, CAST(p_partkey AS VARCHAR) product_id,
       p_name product_name, CAST(p_retailprice AS DECIMAL(14,2)) product_price FROM part"""


@query("explode_json_array", MENU_SQL)
def q_explode_json_array(spark, sf):
    r = _stg(spark, sf)["restaurants"]
    return shred.explode_menu(r).withColumnRenamed("object_id", "restaurant_id")


@query("payout_bands", O.with_(O.PAY) + f"""
, tot AS (SELECT l_orderkey, sum(total_sum) total FROM pay GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) order_id, CAST(1 + o_orderkey % 5 AS SMALLINT) rate,
       CAST({O.BANDS.format(r='CAST(1 + o_orderkey % 5 AS SMALLINT)', t='total')} AS DECIMAL(14,2)) payout
FROM orders JOIN tot ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'O'""")
def q_payout_bands(spark, sf):
    t = Tables(spark, sf)
    pays = shred.explode_payments(_stg(t.spark, t.sf_dir)["events"])
    tot = pays.groupBy("order_id").agg(F.sum("total_sum").alias("total"))
    d = _stg(t.spark, t.sf_dir)["deliveries"].select(F.from_json("deliveri_info", DOC_DELIVERY).alias("d")).select("d.*")
    j = d.join(tot, "order_id")
    return j.select("order_id", "rate", money.payout("total", "rate").cast("decimal(14,2)").alias("payout"))


@query("settlement_fee_math", O.with_(O.PAY) + """
, s AS (SELECT order_id, sum(total_sum) t, sum(bonus_payment) bp FROM pay GROUP BY 1)
SELECT order_id, CAST(t AS DECIMAL(14,2)) total, CAST(t * 0.25 AS DECIMAL(14,2)) fee,
       CAST(t - t * 0.25 - bp AS DECIMAL(14,2)) reward,
       CAST(t - CAST(t * 0.25 AS DECIMAL(14,2)) - bp AS DECIMAL(14,2)) reward_from_rounded_fee FROM s""")
def q_settlement_fee_math(spark, sf):
    pays = shred.explode_payments(_stg(spark, sf)["events"])
    s = pays.groupBy("order_id").agg(F.sum("total_sum").alias("t"), F.sum("bonus_payment").alias("bp"))
    return s.select("order_id", F.col("t").cast("decimal(14,2)").alias("total"),
                    money.fee("t").cast("decimal(14,2)").alias("fee"),
                    money.restaurant_reward("t", "bp").cast("decimal(14,2)").alias("reward"),
                    # the trap: subtracting the already rounded fee can differ by a cent
                    (F.col("t") - money.fee("t").cast("decimal(14,2)") - F.col("bp")).cast("decimal(14,2)")
                    .alias("reward_from_rounded_fee"))


@query("format_datetime", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') ts_text,
       strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') ts_seconds,
       CAST(ts - INTERVAL 7 DAY AS DATE) week_before FROM events""")
def q_format_datetime(spark, sf):
    e = Tables(spark, sf)["events"]
    txt = format_datetime("ts")
    return e.select("event_id", txt.alias("ts_text"), parse_datetime(txt).alias("ts_seconds"),
                    F.date_sub(F.to_date("ts"), 7).alias("week_before"))


@query("conform_types", """
SELECT CAST(o_custkey AS VARCHAR) user_id, CAST(round(avg(1 + o_orderkey % 5)) AS SMALLINT) rate_avg,
       CAST(sum(CAST(o_totalprice AS DECIMAL(14,2)) * 0.035) AS DECIMAL(14,2)) bonus
FROM orders GROUP BY o_custkey""")
def q_conform_types(spark, sf):
    o = Tables(spark, sf)["orders"]
    g = o.groupBy(F.col("o_custkey").cast("string").alias("user_id")).agg(
        F.avg(F.lit(1) + F.col("o_orderkey") % 5).alias("rate_avg"),
        F.sum(F.col("o_totalprice").cast("decimal(14,2)") * F.lit(Decimal("0.035"))).alias("bonus"))
    return casts.conform(g, "user_id string, rate_avg smallint, bonus decimal(14,2)")


# ============================== E, F, G: shredding, joins, aggregates ==============================
@query("explode_payments", O.with_(O.PAY) + """
SELECT order_id, product_id, count, price, total_sum, bonus_payment, bonus_grant FROM pay""")
def q_explode_payments(spark, sf):
    return shred.explode_payments(_stg(spark, sf)["events"])


@query("shred_text_parity", MENU_SQL)
def q_shred_text_parity(spark, sf):
    r = _stg(spark, sf)["restaurants"]
    # menus as the source system writes them: elements separated by "}, {"
    menu_text = F.regexp_replace(F.get_json_object("object_value", "$.menu"), r"\},\{", "}, {")
    elems = shred.shred_text(r.select("object_id", menu_text.alias("menu")), "menu", keep=("object_id",))
    item = F.from_json("elem", "_id string, name string, price decimal(14,2)")
    return elems.select(F.col("object_id").alias("restaurant_id"), item["_id"].alias("product_id"),
                        item["name"].alias("product_name"), item["price"].alias("product_price"))


def _natural_dims(t: Tables) -> dict:
    """Dimension batches keyed by natural keys (no surrogate ids needed)."""
    stg = _stg(t.spark, t.sf_dir)
    return {
        "users": dds.users_batch(stg["users"], floor=FLOOR),
        "restaurants": dds.restaurants_batch(stg["restaurants"], floor=FLOOR),
        "timestamps": dds.timestamps_batch(stg["orders"], floor=FLOOR),
        "deliveries": stg["deliveries"].select(J.json_text("deliveri_info", "order_id").alias("order_id")),
        "stg": stg,
    }


@query("lookup_rejects", """
SELECT CAST(o_orderkey AS VARCHAR) order_key, 'no delivery' reason FROM orders WHERE o_orderstatus = 'O'""")
def q_lookup_rejects(spark, sf):
    n = _natural_dims(Tables(spark, sf))
    return dds.order_rejects(n["stg"]["orders"], n["users"], n["restaurants"], n["timestamps"], n["deliveries"],
                             floor=FLOOR)


@query("join_fanout", """
SELECT CAST(o_orderkey AS VARCHAR) order_key, o_orderdate order_ts FROM orders WHERE o_orderstatus <> 'O'
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), o_orderdate + INTERVAL 1 DAY FROM orders WHERE o_orderstatus = 'F'""")
def q_join_fanout(spark, sf):
    t = Tables(spark, sf)
    items = landing.delivery_items(t)
    # closed orders were delivered twice (a second attempt a day later): the order lookup fans out
    again = items.join(t["orders"].where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("string").alias("order_id")), "order_id", "left_semi").withColumn(
        "order_ts", F.date_format(casts.to_ts("order_ts") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss"))
    deliveries = items.unionByName(again).select("order_id", casts.to_ts("order_ts").alias("order_ts"))
    orders = _stg(t.spark, t.sf_dir)["orders"].select(F.col("object_id").alias("order_key"))
    j = K.lookup(orders, deliveries, {"order_key": "order_id"}, {"order_ts": "order_ts"})
    return j.select("order_key", "order_ts")


def _orders_with_payments(t: Tables) -> DataFrame:
    pays = shred.explode_payments(_stg(t.spark, t.sf_dir)["events"])
    d = F.from_json("object_value", DOC_ORDER)
    o = _stg(t.spark, t.sf_dir)["orders"].select(F.col("object_id").alias("order_id"), d["restaurant"]["id"].alias("restaurant_id"),
                                     casts.to_date(d["date"]).alias("date"))
    return pays.join(o, "order_id")


_AGG_BASE = O.with_(O.PAY) + f"""
, j AS (SELECT p.*, CAST(o_orderkey % {O.NS} AS VARCHAR) restaurant_id, CAST(o_orderdate AS DATE) date
        FROM pay p JOIN orders ON p.l_orderkey = o_orderkey)
"""


@query("agg_count_distinct", _AGG_BASE + """
SELECT restaurant_id, date, count(DISTINCT order_id) orders_count FROM j GROUP BY 1, 2""")
def q_agg_count_distinct(spark, sf):
    j = _orders_with_payments(Tables(spark, sf))
    return j.groupBy("restaurant_id", "date").agg(F.count_distinct("order_id").alias("orders_count"))


@query("agg_count_distinct_monthly", _AGG_BASE + """
SELECT restaurant_id, CAST(year(date) AS INTEGER) y, CAST(month(date) AS INTEGER) m, CAST(count(DISTINCT order_id) AS BIGINT) orders_count
FROM j GROUP BY 1, 2, 3""")
def q_agg_count_distinct_monthly(spark, sf):
    """Monthly distinct orders merged from stored daily bit maps."""
    from ..operators.distinct import count_maps, distinct_maps
    from ..session import COMPACT, materialise
    j = _orders_with_payments(Tables(spark, sf)).withColumn("order_id", F.col("order_id").cast("bigint"))
    daily = materialise(distinct_maps(j, ["restaurant_id", "date"], "order_id"), "daily-orders", COMPACT)
    monthly = daily.withColumns({"y": F.year("date"), "m": F.month("date")})
    return count_maps(monthly, ["restaurant_id", "y", "m"], "orders_count")


@query("agg_sum", _AGG_BASE + """
SELECT restaurant_id, date, CAST(sum(total_sum) AS DECIMAL(29,5)) total_sum,
       CAST(sum(count) AS BIGINT) quantity FROM j GROUP BY 1, 2""")
def q_agg_sum(spark, sf):
    j = _orders_with_payments(Tables(spark, sf))
    return j.groupBy("restaurant_id", "date").agg(F.sum("total_sum").cast("decimal(29,5)").alias("total_sum"),
                                                  F.sum("count").cast("bigint").alias("quantity"))


@query("agg_avg_rounded", """
SELECT CAST(c_nationkey AS VARCHAR) courier_id, CAST(year(o_orderdate) AS SMALLINT) AS year,
       CAST(month(o_orderdate) AS SMALLINT) AS month, CAST(round(avg(1 + o_orderkey % 5)) AS SMALLINT) rate_avg
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'O' GROUP BY 1, 2, 3""")
def q_agg_avg_rounded(spark, sf):
    d = _stg(spark, sf)["deliveries"].select(F.from_json("deliveri_info", DOC_DELIVERY).alias("d"))
    ts = casts.to_ts(F.col("d.order_ts"))
    g = d.groupBy(F.col("d.courier_id").alias("courier_id"), F.year(ts).cast("smallint").alias("year"),
                  F.month(ts).cast("smallint").alias("month")).agg(F.avg("d.rate").alias("rate_avg"))
    return g.withColumn("rate_avg", casts.assign(F.col("rate_avg"), casts.ShortType()))


# ============================== I: data quality ==============================
@query("dq_not_null", """
SELECT 'not_null:order_key' rule, CAST(0 AS BIGINT) violations
UNION ALL SELECT 'not_null:courier_id', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'not_null:rate', count(*) FROM orders WHERE o_orderstatus = 'O'""")
def q_dq_not_null(spark, sf):
    t = Tables(spark, sf)
    orders = _stg(t.spark, t.sf_dir)["orders"].select(F.col("object_id").alias("order_key"))
    d = _stg(t.spark, t.sf_dir)["deliveries"].select(F.from_json("deliveri_info", DOC_DELIVERY).alias("d")).select("d.*")
    j = orders.join(d, orders["order_key"] == d["order_id"], "left")   # undelivered orders carry NULLs
    return Q.violation_counts(j, Q.not_null("order_key", "courier_id", "rate"))


@query("dq_non_negative", """
SELECT 'non_negative:c_acctbal' rule, count(*) FILTER (WHERE c_acctbal < 0) violations FROM customer
UNION ALL SELECT 'non_negative:c_custkey', count(*) FILTER (WHERE c_custkey < 0) FROM customer""")
def q_dq_non_negative(spark, sf):
    return Q.violation_counts(Tables(spark, sf)["customer"], Q.non_negative("c_acctbal", "c_custkey"))


# Fixed check bounds of the source DDL (settlement date 2022..2500, month 1..12, day 1..31).
@query("dq_ranges", """
SELECT 'range:year' rule, count(*) FILTER (WHERE year(o_orderdate) < 2022 OR year(o_orderdate) > 2500) violations
FROM (SELECT DISTINCT o_orderdate FROM orders)
UNION ALL SELECT 'range:month', count(*) FILTER (WHERE month(o_orderdate) < 1 OR month(o_orderdate) > 12)
FROM (SELECT DISTINCT o_orderdate FROM orders)
UNION ALL SELECT 'range:day', count(*) FILTER (WHERE day(o_orderdate) < 1 OR day(o_orderdate) > 31)
FROM (SELECT DISTINCT o_orderdate FROM orders)""")
def q_dq_ranges(spark, sf):
    ts = dds.timestamps_batch(_stg(spark, sf)["orders"], floor=FLOOR).dropDuplicates(["ts"])
    rules = Q.in_range("year", 2022, 2500) + Q.in_range("month", 1, 12) + Q.in_range("day", 1, 31)
    return Q.violation_counts(ts, rules)


@query("dq_foreign_keys", f"""
SELECT CAST(o_orderkey AS VARCHAR) order_key, CAST(o_orderkey % {O.NS} AS VARCHAR) restaurant_id FROM orders
WHERE o_orderkey % {O.NS} IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 0)""")
def q_dq_foreign_keys(spark, sf):
    t = Tables(spark, sf)
    d = F.from_json("object_value", DOC_ORDER)
    o = _stg(t.spark, t.sf_dir)["orders"].select(F.col("object_id").alias("order_key"), d["restaurant"]["id"].alias("restaurant_id"))
    # restaurants of nation 0 were never loaded into the dimension: their orders are orphans
    dim = t["supplier"].where(F.col("s_nationkey") != 0).select(F.col("s_suppkey").cast("string").alias("rid"))
    return Q.foreign_key(o, "restaurant_id", dim, "rid")


@query("dq_unique", """
SELECT CAST(l_orderkey AS VARCHAR) order_id, CAST(l_partkey AS VARCHAR) product_id, count(*) n
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_dq_unique(spark, sf):
    pays = shred.explode_payments(_stg(spark, sf)["events"])
    return Q.unique(pays, ["order_id", "product_id"])


@query("dq_length", """
SELECT CAST(c_custkey AS VARCHAR) user_id, c_name user_name, CAST(length(c_name) AS INTEGER) len
FROM customer WHERE length(c_name) > 17""")
def q_dq_length(spark, sf):
    u = _users(Tables(spark, sf))
    _, bad = Q.validate(u, Q.max_length("user_name", 17))
    return bad.select("user_id", "user_name", F.length("user_name").alias("len"))


@query("dq_observed_write", """
SELECT 'non_negative:c_acctbal' rule, count(*) FILTER (WHERE c_acctbal < 0) violations,
       count(*) FILTER (WHERE c_acctbal >= 0 AND length(c_name) <= 17 AND c_custkey % 10 < 9) good_rows FROM customer
UNION ALL SELECT 'length:c_name>17', count(*) FILTER (WHERE length(c_name) > 17),
       count(*) FILTER (WHERE c_acctbal >= 0 AND length(c_name) <= 17 AND c_custkey % 10 < 9) FROM customer
UNION ALL SELECT 'range:last_digit', count(*) FILTER (WHERE c_custkey % 10 = 9),
       count(*) FILTER (WHERE c_acctbal >= 0 AND length(c_name) <= 17 AND c_custkey % 10 < 9) FROM customer""")
def q_dq_observed_write(spark, sf):
    """Rules counted in the pass that writes the table."""
    from ..session import scratch_path
    c = Tables(spark, sf)["customer"].withColumn("last_digit", F.col("c_custkey") % 10)
    rules = Q.non_negative("c_acctbal") + Q.max_length("c_name", 17) + Q.in_range("last_digit", 0, 8)
    out = Q.write_checked(c, rules, scratch_path(spark, "checked"))
    good = out.good.agg(F.count("*").alias("good_rows"))
    rows = spark.createDataFrame(list(out.violations.items()), "rule string, violations long")
    return rows.withColumn("good_rows", good.scalar())


@query("dq_numeric_fit", O.with_(O.PAY) + """
SELECT order_id, CAST(sum(total_sum) AS DECIMAL(29,5)) total FROM pay GROUP BY 1 HAVING sum(total_sum) >= 1000000""")
def q_dq_numeric_fit(spark, sf):
    pays = shred.explode_payments(_stg(spark, sf)["events"])
    tot = pays.groupBy("order_id").agg(F.sum("total_sum").cast("decimal(29,5)").alias("total"))
    _, bad = Q.validate(tot, Q.fits("total", "decimal(8,2)"))
    return bad.select("order_id", "total")


# ============================== J: warehouse jobs ==============================
_WAREHOUSES: dict = {}


def _warehouse(spark: SparkSession, sf: str, *tables: str) -> dict:
    """First load of the detail layer from the driver tables: the named ``tables`` with all
    they are looked up in, or every table (each is materialised once per session and source
    folder; later queries reuse them the way a warehouse reuses its tables)."""
    key = (spark.sparkContext.applicationId, sf)
    have = _WAREHOUSES.get(key, {})
    if not set(tables or DDS) <= set(have):
        have = _WAREHOUSES[key] = build_warehouse(spark, _stg(spark, sf), floor=FLOOR, tables=tables or None, have=have)
    return have


@query("dm_users", """
SELECT CAST(row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS BIGINT) id, CAST(c_custkey AS VARCHAR) user_id,
       c_name user_name, lower(c_name) user_login FROM customer""")
def q_dm_users(spark, sf):
    return _warehouse(spark, sf, "dm_users")["dm_users"]


@query("dm_restaurants", O.with_(O.R_SK) + """
SELECT CAST(id AS BIGINT) id, restaurant_nk restaurant_id, restaurant_name, active_from,
       TIMESTAMP '2099-12-31' active_to FROM r_sk""")
def q_dm_restaurants(spark, sf):
    return _warehouse(spark, sf, "dm_restaurants")["dm_restaurants"]


@query("dm_timestamps", O.with_(O.T_SK) + """
SELECT CAST(id AS BIGINT) id, ts, CAST(year(ts) AS SMALLINT) AS year, CAST(month(ts) AS SMALLINT) AS month,
       CAST(day(ts) AS SMALLINT) AS day, strftime(ts, '%H:%M:%S') AS time, CAST(ts AS DATE) AS date FROM t_sk""")
def q_dm_timestamps(spark, sf):
    return _warehouse(spark, sf, "dm_timestamps")["dm_timestamps"]


@query("couriers", O.with_(O.C_SK) + """
SELECT CAST(id AS BIGINT) id, courier_nk courier_id, courier_name FROM c_sk""")
def q_couriers(spark, sf):
    return _warehouse(spark, sf, "couriers")["couriers"]


@query("dm_products", O.with_(O.R_SK, O.P_SK) + f"""
SELECT CAST(ps.id AS BIGINT) id, CAST(r.id AS BIGINT) restaurant_id, CAST(p.p_partkey AS VARCHAR) product_id,
       p.p_name product_name, CAST(p.p_retailprice AS DECIMAL(14,2)) product_price, r.active_from,
       TIMESTAMP '2099-12-31' active_to
FROM part p JOIN p_sk ps ON ps.p_partkey = p.p_partkey
JOIN r_sk r ON r.restaurant_nk = CAST(p.p_partkey % {O.NS} AS VARCHAR)""")
def q_dm_products(spark, sf):
    return _warehouse(spark, sf, "dm_products")["dm_products"]


@query("deliveries", O.with_(O.C_SK, O.D) + """
SELECT CAST(row_number() OVER (ORDER BY d.order_key, d.o_orderdate) AS BIGINT) id, d.order_key order_id,
       d.o_orderdate order_ts, CAST(c.id AS BIGINT) courier_id, d.rate, d.tip_sum
FROM d JOIN c_sk c ON c.courier_nk = d.courier_nk""")
def q_deliveries(spark, sf):
    return _warehouse(spark, sf, "deliveries")["deliveries"]


@query("dm_orders", O.with_(O.R_SK, O.C_SK, O.U_SK, O.T_SK, O.D, O.O_SK) + f"""
SELECT CAST(os.id AS BIGINT) id, CAST(u.id AS BIGINT) user_id, CAST(r.id AS BIGINT) restaurant_id,
       CAST(c.id AS BIGINT) courier_id, CAST(t.id AS BIGINT) timestamp_id, d.order_key,
       CASE d.o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'CANCELLED' END order_status
FROM d JOIN o_sk os ON os.o_orderkey = d.o_orderkey JOIN u_sk u ON u.user_nk = d.user_nk
JOIN r_sk r ON r.restaurant_nk = d.restaurant_nk JOIN c_sk c ON c.courier_nk = d.courier_nk
JOIN t_sk t ON t.ts = d.o_orderdate""")
def q_dm_orders(spark, sf):
    return _warehouse(spark, sf, "dm_orders")["dm_orders"]


@query("fct_product_sales", O.with_(O.R_SK, O.P_SK, O.FCT, O.D, O.O_SK) + """
SELECT CAST(row_number() OVER (ORDER BY ps.id, os.id) AS BIGINT) id, CAST(ps.id AS BIGINT) product_id,
       CAST(os.id AS BIGINT) order_id, f.count, f.price, f.total_sum, f.bonus_payment, f.bonus_grant
FROM fct f JOIN p_sk ps ON ps.p_partkey = f.l_partkey JOIN o_sk os ON os.o_orderkey = f.l_orderkey""")
def q_fct_product_sales(spark, sf):
    return _warehouse(spark, sf, "fct_product_sales")["fct_product_sales"]


@query("dm_settlement_report", O.SETTLEMENT)
def q_dm_settlement_report(spark, sf):
    w = _warehouse(spark, sf)
    return marts.settlement_report(w["fct_product_sales"], w["dm_orders"], w["dm_restaurants"], w["dm_timestamps"])


@query("dm_courier_ledger", O.LEDGER_ROW_RATE)
def q_dm_courier_ledger(spark, sf):
    w = _warehouse(spark, sf)
    return marts.courier_ledger(w["fct_product_sales"], w["dm_orders"], w["dm_timestamps"], w["deliveries"],
                                w["couriers"], policy="row_rate")


@query("dm_courier_ledger_avg_rate", O.LEDGER_AVG_RATE)
def q_dm_courier_ledger_avg_rate(spark, sf):
    w = _warehouse(spark, sf)
    return marts.courier_ledger(w["fct_product_sales"], w["dm_orders"], w["dm_timestamps"], w["deliveries"],
                                w["couriers"], policy="avg_rate")


CO_BUCKETS = 8


@query("ledger_co_partitioned", O.LEDGER_ROW_RATE)
def q_ledger_co_partitioned(spark, sf):
    """The ledger from sales, orders and deliveries bucketed by the order: no exchange below their joins."""
    w = marts.co_partitioned(_warehouse(spark, sf), CO_BUCKETS)
    return marts.courier_ledger(w["fct_product_sales"], w["dm_orders"], w["dm_timestamps"], w["deliveries"], w["couriers"])


@query("settlement_co_partitioned", O.SETTLEMENT)
def q_settlement_co_partitioned(spark, sf):
    """The settlement from sales and orders bucketed by the order."""
    w = marts.co_partitioned(_warehouse(spark, sf), CO_BUCKETS)
    return marts.settlement_report(w["fct_product_sales"], w["dm_orders"], w["dm_restaurants"], w["dm_timestamps"])


@query("refresh_end_to_end", "SELECT CAST(row_number() OVER (ORDER BY restaurant_id, settlement_date) AS BIGINT) id, * "
                             "FROM (" + O.SETTLEMENT + ")")
def q_refresh_end_to_end(spark, sf):
    from ..session import scratch_path
    from .refresh import refresh_all
    root = scratch_path(spark, "warehouse")
    out = refresh_all(spark, _stg(spark, sf), root, floor=FLOOR)
    return out["dm_settlement_report"]


_TWICE: dict = {}


def _twice(spark, sf):
    """The partitioned warehouse after two refreshes, once a session and source folder."""
    from ..session import scratch_path
    from .incremental import refresh_partitions
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TWICE:
        root = scratch_path(spark, "partitioned")
        for stg in landing.two_loads(Tables(spark, sf), _stg(spark, sf)):
            out = refresh_partitions(spark, stg, root, floor=FLOOR, late_days=landing.LATE_DAYS)
        _TWICE[key] = out
    return _TWICE[key]


@query("refresh_second_run", O.SETTLEMENT)
def q_refresh_second_run(spark, sf):
    """Settlement after two runs: orders that changed status and restaurant, late deliveries, renamed restaurants."""
    return _twice(spark, sf)["dm_settlement_report"].drop("id")


@query("refresh_second_run_ledger", O.LEDGER_ROW_RATE)
def q_refresh_second_run_ledger(spark, sf):
    """Ledger after two runs: corrected couriers and tips, renamed couriers, orders that came before their delivery."""
    return _twice(spark, sf)["dm_courier_ledger"].drop("id")


@query("refresh_rejected_orders", f"""
SELECT CAST(o_orderkey AS VARCHAR) order_key, 'no delivery' reason,
       CAST(CASE WHEN o_orderdate < TIMESTAMP '{landing.LOAD_CUT}' THEN 2 ELSE 1 END AS INTEGER) tries
FROM orders WHERE o_orderstatus = 'O'""")
def q_refresh_rejected_orders(spark, sf):
    """Orders kept for the next run, with the number of runs that tried them."""
    r = _twice(spark, sf).rejects["orders"]
    return r.select(F.col("object_id").alias("order_key"), "reason", "tries")


# ============================== K: streaming ==============================
def _stream_dirs(spark, name):
    from ..session import scratch_path
    base = scratch_path(spark, f"stream-{name}")
    return base + "/sink", base + "/checkpoint", base + "/tables"


OUTBOX_SQL = "SELECT event_id AS id, ts AS event_ts, event_type, props AS event_value FROM events"


def _outbox_stream(spark, sf):
    from ..streaming.streams import stream_source
    s = stream_source(spark, sf, Tables(spark, sf)["events"].schema, glob="events.parquet")
    return s.select(F.col("event_id").alias("id"), F.col("ts").alias("event_ts"), "event_type",
                    F.col("props").alias("event_value"))


@query("stream_ingest_once", OUTBOX_SQL)
def q_stream_ingest_once(spark, sf):
    from ..streaming.streams import ingest_once
    sink, ckpt, _ = _stream_dirs(spark, "ingest")
    ingest_once(_outbox_stream(spark, sf), sink, ckpt)
    ingest_once(_outbox_stream(spark, sf), sink, ckpt)   # nothing new: adds no rows
    return spark.read.parquet(sink)


@query("stream_upsert", OUTBOX_SQL)
def q_stream_upsert(spark, sf):
    from ..schemas import STG
    from ..streaming.streams import TableSink, stream_upsert
    _, ckpt, tables = _stream_dirs(spark, "upsert")
    sink = TableSink(spark, tables, "bonussystem_events", STG["bonussystem_events"])
    stream_upsert(_outbox_stream(spark, sf), sink, "event_ts", "id", ckpt)
    stream_upsert(_outbox_stream(spark, sf), sink, "event_ts", "id", ckpt + "-replay")  # replay: same table
    return sink.current()


@query("stream_insert_absent", """
SELECT CAST(o_orderkey AS VARCHAR) order_id, o_orderdate order_ts, CAST(c_nationkey AS VARCHAR) courier_id,
       CAST(1 + o_orderkey % 5 AS SMALLINT) rate, CAST(o_orderkey % 200 AS DECIMAL(14,2)) tip_sum
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'O'""")
def q_stream_insert_absent(spark, sf):
    from ..streaming.streams import TableSink, stream_insert_absent, stream_source
    from ..functions.timefmt import DOC_DATETIME
    t = Tables(spark, sf)
    _, ckpt, tables = _stream_dirs(spark, "insert-absent")
    o = stream_source(spark, sf, t["orders"].schema, glob="orders.parquet").where(F.col("o_orderstatus") != "O")
    c = t["customer"].select("c_custkey", "c_nationkey")
    items = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.date_format("o_orderdate", DOC_DATETIME).alias("order_ts"),
        F.col("c_nationkey").cast("string").alias("courier_id"),
        (F.lit(1) + F.col("o_orderkey") % 5).cast("int").alias("rate"),
        (F.col("o_orderkey") % 200).cast("decimal(14,2)").alias("tip_sum"))
    docs = items.select(J.to_document("order_id", "order_ts", "courier_id", "rate", "tip_sum").alias("deliveri_info"))
    sink = TableSink(spark, tables, "deliveries", "deliveri_info string")
    stream_insert_absent(docs, sink, "deliveri_info", ckpt)
    d = F.from_json("deliveri_info", DOC_DELIVERY)
    return sink.current().select(d["order_id"].alias("order_id"), casts.to_ts(d["order_ts"]).alias("order_ts"),
                                 d["courier_id"].alias("courier_id"), d["rate"].alias("rate"),
                                 d["tip_sum"].alias("tip_sum"))


@query("stream_daily_totals", f"""
SELECT CAST(o_orderdate AS DATE) AS day, CAST(o_orderkey % {O.NS} AS VARCHAR) restaurant_id,
       CAST(sum({O.COST}) AS DECIMAL(24,2)) orders_total_sum
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2""")
def q_stream_daily_totals(spark, sf):
    from ..streaming.streams import TableSink, stream_daily_totals, stream_source
    t = Tables(spark, sf)
    _, ckpt, tables = _stream_dirs(spark, "daily")
    li = stream_source(spark, sf, t["lineitem"].schema, glob="lineitem.parquet")
    o = t["orders"].where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", (F.col("o_orderkey") % landing.n_suppliers(t)).cast("string").alias("restaurant_id"),
        F.col("o_orderdate").cast("timestamp").alias("ts"))
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        "ts", "restaurant_id", F.col("l_extendedprice").cast("decimal(14,2)").alias("cost"))
    sink = TableSink(spark, tables, "daily_totals", "day date, restaurant_id string, orders_total_sum decimal(24,2)")
    stream_daily_totals(rows, sink, "ts", ["restaurant_id"], {"orders_total_sum": "cost"}, "7 days", ckpt)
    return sink.current()


@query("stream_merge_versions", f"""
SELECT CAST(o_orderkey AS VARCHAR) order_key, {O.STATUS} order_status, o_orderdate + INTERVAL 1 DAY update_ts FROM orders""")
def q_stream_merge_versions(spark, sf):
    """Versions of orders over three micro-batches, of which some come older after newer."""
    from ..operators.partitioned import Layout
    from ..streaming.streams import PartitionSink, stream_merge, stream_source
    landed, ckpt, tables = _stream_dirs(spark, "versions")
    rows = landing.order_versions(Tables(spark, sf))
    schema = "order_key string, order_status string, update_ts timestamp_ntz"
    sink = PartitionSink(spark, f"{tables}/orders", Layout(("order_key",), "pmod(xxhash64(order_key), 16)", schema))
    for _ in landing.land_batches(rows, landed, "arrival", 3):
        stream_merge(stream_source(spark, landed, schema), sink, "update_ts", ckpt)
    return sink.current()


STREAM_FILES = 7


def _settled(spark, sf):
    """The running settlement after all files, once a session and source folder."""
    from ..streaming.streams import SETTLEMENT_LINES, SettlementStream, stream_source
    key = (spark.sparkContext.applicationId, sf, "settled")
    if key not in _TWICE:
        landed, ckpt, tables = _stream_dirs(spark, "settlement")
        run = SettlementStream(spark, tables, delay_days=7)
        for _ in landing.land_batches(landing.sale_lines(Tables(spark, sf), STREAM_FILES), landed, "arrival", STREAM_FILES):
            run.run(stream_source(spark, landed, SETTLEMENT_LINES), ckpt)
        _TWICE[key] = run
    return _TWICE[key]


_STREAM_LINES = f"""
WITH l AS (SELECT CAST(o_orderkey AS VARCHAR) order_id, CAST(o_orderkey % {O.NS} AS VARCHAR) restaurant_id, o_orderdate ts,
                  {O.COST} total_sum, CAST({O.COST} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,2)) bonus_payment,
                  CAST({O.COST} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(14,2)) bonus_grant,
                  least(year(o_orderdate) - 1995 + (o_orderkey % 10 = 0)::INT, {STREAM_FILES - 1}) AS arrival
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F')"""


@query("stream_settlement", _STREAM_LINES + """
SELECT restaurant_id, CAST(ts AS DATE) settlement_date, CAST(count(DISTINCT order_id) AS INTEGER) orders_count,
       CAST(sum(total_sum) AS DECIMAL(14,2)) orders_total_sum, CAST(sum(bonus_payment) AS DECIMAL(14,2)) orders_bonus_payment_sum,
       CAST(sum(bonus_grant) AS DECIMAL(14,2)) orders_bonus_granted_sum, CAST(sum(total_sum) * 0.25 AS DECIMAL(14,2)) order_processing_fee,
       CAST(sum(total_sum) - sum(total_sum) * 0.25 - sum(bonus_payment) AS DECIMAL(14,2)) restaurant_reward_sum
FROM l GROUP BY 1, 2""")
def q_stream_settlement(spark, sf):
    """All measures of the daily settlement from seven micro-batches, late rows included."""
    return _settled(spark, sf).mart.current()


@query("stream_late_rows", _STREAM_LINES + """,
m AS (SELECT a.arrival, max(b.ts) AS newest FROM (SELECT DISTINCT arrival FROM l) a JOIN l b ON b.arrival < a.arrival GROUP BY 1)
SELECT restaurant_id, CAST(count(*) AS BIGINT) late_rows FROM l JOIN m USING (arrival)
WHERE ts < newest - INTERVAL 7 DAY GROUP BY 1""")
def q_stream_late_rows(spark, sf):
    """Rows that came more than a week behind the newest one of earlier micro-batches, by restaurant."""
    return _settled(spark, sf).late().groupBy("restaurant_id").agg(F.count("*").alias("late_rows"))


# ============================== L: history ==============================
SCD2_SQL = """
WITH x AS (SELECT user_id, ts, event_type,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) prev FROM events {where}),
c AS (SELECT * FROM x WHERE prev IS NULL OR prev <> event_type)
SELECT user_id, event_type, ts active_from,
       coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_type), TIMESTAMP '2099-12-31') active_to
FROM c"""


@query("scd2_build", SCD2_SQL.format(where=""))
def q_scd2_build(spark, sf):
    e = Tables(spark, sf)["events"]
    return scd2.scd2_build(e, "user_id", "ts", ["event_type"])


SCD2_CUT = "2024-01-15 00:00:00"


@query("scd2_apply", SCD2_SQL.format(where=""))
def q_scd2_apply(spark, sf):
    e = Tables(spark, sf)["events"]
    hist = scd2.scd2_build(e.where(F.col("ts") < _ts(SCD2_CUT)), "user_id", "ts", ["event_type"])
    batch = e.where(F.col("ts") >= _ts(SCD2_CUT)).select("user_id", "ts", "event_type")
    return scd2.scd2_apply(hist, batch, "user_id", "ts", ["event_type"])


@query("scd2_asof", "WITH h AS (" + SCD2_SQL.format(where="WHERE event_type IN ('signup', 'purchase')") + """)
SELECT f.event_id, f.user_id, f.ts, f.event_type, h.event_type state, h.active_from state_since
FROM (SELECT * FROM events WHERE event_type NOT IN ('signup', 'purchase')) f
ASOF JOIN h ON f.user_id = h.user_id AND f.ts >= h.active_from
WHERE f.ts < h.active_to""")
def q_scd2_asof(spark, sf):
    e = Tables(spark, sf)["events"]
    states = e.where(F.col("event_type").isin("signup", "purchase"))
    hist = scd2.scd2_build(states, "user_id", "ts", ["event_type"])
    facts = e.where(~F.col("event_type").isin("signup", "purchase")).select("event_id", "user_id", "ts", "event_type")
    return scd2.asof_lookup(facts, hist.withColumnRenamed("event_type", "state"), "user_id", "ts",
                            {"state": "state", "active_from": "state_since"})


def queries() -> dict:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict:
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}
