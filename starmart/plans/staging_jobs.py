"""Staging jobs (J12) against warehouse tables: the three source systems.

* :func:`stage_bonus`         relational outbox by id cursor (+ full snapshots)
* :func:`stage_orders_system` document collections; orders by update_ts cursor
* :func:`stage_api`           API items: couriers snapshot, deliveries by run window

Every job writes the staged table first and its cursor afterwards, so a failed
run is replayed from the old cursor (upserts and insert-if-absent absorb the
replay).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.keys import BROADCAST_MAX_ROWS
from ..operators.upsert import cursor_per_type, insert_absent, upsert
from ..schemas import DEFAULT_FLOOR, STG
from ..sources import api, documents, extract
from .refresh import Warehouse


def _current(wh: Warehouse, qname: str) -> DataFrame:
    df = wh.read(qname)
    if df is None:
        layer, name = qname.split(".", 1)
        df = wh.spark.createDataFrame([], StructType.fromDDL(STG[name]))
    return df


def stage_bonus(wh: Warehouse, outbox: DataFrame, ranks: DataFrame | None = None, users: DataFrame | None = None,
                conflict_key: str = "event_ts") -> dict:
    """Outbox rows above the stored id (``coalesce(max id, 0)``), upserted on
    ``conflict_key`` (``event_ts`` as the source system does, or ``id``); then one
    cursor row per event type (highest id and its payload)."""
    out = {}
    settings = _current(wh, "stg.srv_wf_settings_posgresql")
    batch = extract.extract_incremental(outbox, "id", extract.cursor_value(settings, "id"))
    events = _current(wh, "stg.bonussystem_events")
    out["bonussystem_events"] = wh.write("stg.bonussystem_events",
                                         upsert(events, batch, conflict_key, dedupe="last", order_by="id",
                                                small_batch=BROADCAST_MAX_ROWS))
    if ranks is not None:
        out["bonussystem_ranks"] = wh.write("stg.bonussystem_ranks", upsert(
            _current(wh, "stg.bonussystem_ranks"), ranks, "id", dedupe="last", order_by="id",
            small_batch=BROADCAST_MAX_ROWS))
    if users is not None:
        out["bonussystem_users"] = wh.write("stg.bonussystem_users", upsert(
            _current(wh, "stg.bonussystem_users"), users, "id", dedupe="last", order_by="id",
            small_batch=BROADCAST_MAX_ROWS))
    # cursor last; an empty batch leaves it as it was
    out["srv_wf_settings_posgresql"] = wh.write("stg.srv_wf_settings_posgresql", upsert(
        settings, cursor_per_type(batch, "event_type", "id", "event_value"), "workflow_key", dedupe="none"))
    return out


def stage_orders_system(wh: Warehouse, collections: dict, floor: str = DEFAULT_FLOOR) -> dict:
    """Collections ``{'orders'|'restaurants'|'users': DataFrame}`` (landed exports).
    Orders are read strictly after the stored ``last_update_ts`` (floor when
    none); the others in full. Upsert on ``object_id`` (latest ``update_ts`` wins)."""
    out = {}
    for name, coll in collections.items():
        q = f"stg.ordersystem_{name}"
        cursor = None
        if name == "orders":
            stored = _current(wh, "stg.srv_wf_settings_mongodb")
            cursor = extract.cursor_value(stored, "last_update_ts", floor)
        staged = documents.stage_documents(coll, cursor=cursor)
        cur = _current(wh, q)
        staged = staged.withColumn("id", F.lit(None).cast("bigint"))
        out[q] = wh.write(q, upsert(cur, staged, "object_id", update_cols=["object_value", "update_ts"],
                                    dedupe="last", order_by="update_ts", small_batch=BROADCAST_MAX_ROWS))
        if name == "orders":
            new_cursor = out[q].agg(F.max("update_ts").alias("last_update_ts")).where(
                F.col("last_update_ts").isNotNull()).select(F.lit(1).cast("smallint").alias("id"), "last_update_ts")
            out["stg.srv_wf_settings_mongodb"] = wh.write(
                "stg.srv_wf_settings_mongodb", upsert(_current(wh, "stg.srv_wf_settings_mongodb"), new_cursor, "id",
                                                      dedupe="none"))
    return out


RUNS = "stg.api_runs"
RUNS_SCHEMA = "run_date timestamp_ntz"


def stage_api(wh: Warehouse, couriers: DataFrame | None, deliveries: DataFrame | None, run_date: str,
              days: int = 7) -> dict:
    """Couriers: whole snapshot, insert-if-absent on the canonical document (the
    staged tables are only written here, so their documents are canonical).
    Deliveries: items with ``order_ts`` in ``[previous run date (or run date -
    days), run date)``; the run is logged only after the rows were written."""
    spark: SparkSession = wh.spark
    out = {}
    if couriers is not None:
        docs = api.stage_api(couriers, "courier_info")
        out["couriers"] = wh.write("stg.couriers", insert_absent(_current(wh, "stg.couriers"), docs,
                                                                 canonical_json="courier_info", target_canonical=True,
                                                                 small_batch=BROADCAST_MAX_ROWS))
    if deliveries is not None:
        runs = wh.read(RUNS)
        if runs is None:
            runs = spark.createDataFrame([], RUNS_SCHEMA)
        rd = F.lit(run_date).cast("timestamp_ntz")
        prev = runs.where(F.col("run_date") < rd).select(F.max("run_date")).scalar()
        log = spark.range(1).select(rd.alias("run_date"), prev.alias("prev"))
        w = extract.run_window(log, "run_date", "prev").first()
        docs = api.stage_api(deliveries, "deliveri_info", window=(w.window_from, w.window_to), ts_col="order_ts")
        out["deliveries"] = wh.write("stg.deliveries", insert_absent(_current(wh, "stg.deliveries"), docs,
                                                                     canonical_json="deliveri_info", target_canonical=True,
                                                                     small_batch=BROADCAST_MAX_ROWS))
        out["api_runs"] = wh.write(RUNS, runs.unionByName(spark.createDataFrame([], RUNS_SCHEMA).union(
            log.select("run_date"))).dropDuplicates())
    return out
