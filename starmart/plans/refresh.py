"""Refresh in data order (J12, J13): staging -> dimensions -> facts -> cursor -> marts.

:func:`build_warehouse` composes the jobs over staged DataFrames (first load
when the targets are empty). :func:`refresh_all` does the same against Parquet
tables under a warehouse folder: each table's next snapshot is written to a new
version folder and the table pointer is switched only after the write succeeds,
and the DDS cursor is saved last, so a failed run is simply replayed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dds, marts
from ..schemas import CDM, DDS, DEFAULT_FLOOR
from ..session import COMPACT, materialise as materialise_df


def build_warehouse(spark: SparkSession, stg: dict, floor=DEFAULT_FLOOR, cursor=None, targets: dict | None = None,
                    orders_mode: str = "upsert", sales_mode: str = "upsert", materialise: bool = True,
                    tables: Iterable[str] | None = None, have: dict | None = None) -> dict:
    """All DDS tables from staged frames ``stg`` (keys users, restaurants, orders,
    couriers, deliveries, events). With ``materialise`` every table is written
    once (Parquet in the shared checkpoint folder) and read back, as the
    warehouse's own tables would be, so later jobs read it instead of
    recomputing its lineage. ``tables`` builds these and what they are looked up in only, on top of the tables in
    ``have`` that an earlier call built."""
    tg = {name: (targets or {}).get(name) for name in DDS}   # None: first load of that table
    keep = (lambda d: materialise_df(d, "dds", COMPACT)) if materialise else (lambda d: d)
    out = dict(have or {})
    missing = needed(DDS if tables is None else tables) - set(out)

    def build(jobs: dict) -> None:
        out.update(run_concurrently({name: job for name, job in jobs.items() if name in missing}))

    # independent tables are submitted as concurrent Spark jobs, in the groups of
    # the data order: dimensions; products and deliveries; orders; sales
    build({
        "dm_users": lambda: keep(dds.build_users(stg["users"], tg["dm_users"], cursor, floor)),
        "dm_restaurants": lambda: keep(dds.build_restaurants(stg["restaurants"], tg["dm_restaurants"], cursor,
                                                             floor)),
        "dm_timestamps": lambda: keep(dds.build_timestamps(stg["orders"], tg["dm_timestamps"], cursor, floor)),
        "couriers": lambda: keep(dds.build_couriers(stg["couriers"], tg["couriers"])),
    })
    build({
        "dm_products": lambda: keep(dds.build_products(stg["restaurants"], out["dm_restaurants"], tg["dm_products"],
                                                       cursor, floor)),
        "deliveries": lambda: keep(dds.build_deliveries(stg["deliveries"], out["couriers"], tg["deliveries"],
                                                        cursor, floor)),
    })
    build({"dm_orders": lambda: keep(dds.build_orders(stg["orders"], out["dm_users"], out["dm_restaurants"],
                                                      out["dm_timestamps"], out["deliveries"], tg["dm_orders"], cursor, floor,
                                                      mode=orders_mode))})
    build({"fct_product_sales": lambda: keep(dds.build_product_sales(stg["events"], out["dm_products"], out["dm_orders"],
                                                                     tg["fct_product_sales"], cursor, floor, mode=sales_mode))})
    build({"srv_wf_settings_ts": lambda: dds.advance_cursor(stg["orders"], tg["srv_wf_settings_ts"])})
    return out


# tables that a table's rows are looked up in
NEEDS = {"dm_products": ("dm_restaurants",), "deliveries": ("couriers",),
         "dm_orders": ("dm_users", "dm_restaurants", "dm_timestamps", "deliveries"), "fct_product_sales": ("dm_products", "dm_orders")}


def needed(tables: Iterable[str]) -> set[str]:
    """``tables`` and, at any remove, the tables that these are looked up in."""
    return {x for t in tables for x in (t, *needed(NEEDS.get(t, ())))}


def run_concurrently(jobs: dict, workers: int = 8) -> dict:
    """Run independent job functions as concurrent Spark jobs (threads that only
    submit work; the executors do it). Returns ``{name: result}``."""
    if len(jobs) <= 1:
        return {k: f() for k, f in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(jobs))) as pool:
        futures = {k: pool.submit(f) for k, f in jobs.items()}
        return {k: fut.result() for k, fut in futures.items()}


def build_marts(w: dict, ledger_policy: str = "row_rate") -> dict:
    return {
        "dm_settlement_report": marts.settlement_report(w["fct_product_sales"], w["dm_orders"], w["dm_restaurants"],
                                                        w["dm_timestamps"]),
        "dm_courier_ledger": marts.courier_ledger(w["fct_product_sales"], w["dm_orders"], w["dm_timestamps"],
                                                  w["deliveries"], w["couriers"], policy=ledger_policy),
    }


# ---- tables on storage --------------------------------------------------------------------
class Warehouse:
    """Parquet tables under ``root``: each write creates an immutable version
    folder ``<root>/<layer>/<table>/v-<time>-<uuid>`` and, only after it
    succeeded, appends one line to the version log ``<root>/_versions`` (a JSON
    table written by Spark, so any shared file system works). Readers take the
    newest logged version; a failed write is never visible."""

    LOG_SCHEMA = "table string, version string, written_at long"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _dir(self, qname: str) -> str:
        layer, name = qname.split(".", 1)
        return f"{self.root}/{layer}/{name}"

    def _log(self) -> str:
        return f"{self.root}/_versions"

    def version(self, qname: str) -> str | None:
        try:
            log = self.spark.read.schema(self.LOG_SCHEMA).json(self._log())
            rows = (log.where(F.col("table") == qname).orderBy(F.col("written_at").desc(), F.col("version").desc())
                    .limit(1).collect())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return rows[0]["version"] if rows else None

    def read(self, qname: str) -> DataFrame | None:
        v = self.version(qname)
        return None if v is None else self.spark.read.parquet(f"{self._dir(qname)}/{v}")

    def write(self, qname: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        now = time.time_ns()
        version = f"v-{now}-{uuid.uuid4().hex[:8]}"
        path = f"{self._dir(qname)}/{version}"
        w = df.write.mode("errorifexists").option("compression", COMPACT)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        entry = self.spark.createDataFrame([(qname, version, now)], self.LOG_SCHEMA)
        entry.coalesce(1).write.mode("append").json(self._log())
        return self.spark.read.parquet(path)


def refresh_all(spark: SparkSession, stg: dict, root: str, floor=DEFAULT_FLOOR, ledger_policy: str = "row_rate",
                orders_mode: str = "upsert", sales_mode: str = "upsert") -> dict:
    """One warehouse refresh against tables under ``root`` (created on first use)."""
    wh = Warehouse(spark, root)
    targets = {n: wh.read(f"dds.{n}") for n in DDS}
    targets = {k: v for k, v in targets.items() if v is not None}
    cursor = targets.get("srv_wf_settings_ts")
    # next snapshots, in data order; each one written before the next job reads it
    out = {}
    tg = {n: targets.get(n) for n in DDS}
    out["dm_users"] = wh.write("dds.dm_users", dds.build_users(stg["users"], tg["dm_users"], cursor, floor))
    out["dm_restaurants"] = wh.write("dds.dm_restaurants",
                                     dds.build_restaurants(stg["restaurants"], tg["dm_restaurants"], cursor, floor))
    out["dm_timestamps"] = wh.write("dds.dm_timestamps",
                                    dds.build_timestamps(stg["orders"], tg["dm_timestamps"], cursor, floor))
    out["couriers"] = wh.write("dds.couriers", dds.build_couriers(stg["couriers"], tg["couriers"]))
    out["dm_products"] = wh.write("dds.dm_products", dds.build_products(
        stg["restaurants"], out["dm_restaurants"], tg["dm_products"], cursor, floor))
    out["deliveries"] = wh.write("dds.deliveries", dds.build_deliveries(
        stg["deliveries"], out["couriers"], tg["deliveries"], cursor, floor))
    out["dm_orders"] = wh.write("dds.dm_orders", dds.build_orders(
        stg["orders"], out["dm_users"], out["dm_restaurants"], out["dm_timestamps"], out["deliveries"],
        tg["dm_orders"], cursor, floor, mode=orders_mode))
    out["fct_product_sales"] = wh.write("dds.fct_product_sales", dds.build_product_sales(
        stg["events"], out["dm_products"], out["dm_orders"], tg["fct_product_sales"], cursor, floor,
        mode=sales_mode))
    m = build_marts(out, ledger_policy)
    for name, rows in m.items():
        current = wh.read(f"cdm.{name}")
        if current is None:
            current = spark.createDataFrame([], CDM[name])
        out[name] = wh.write(f"cdm.{name}", marts.refresh_mart(current, rows, name))
    # the cursor moves last: a failure above replays the same batch next time
    out["srv_wf_settings_ts"] = wh.write("dds.srv_wf_settings_ts", dds.advance_cursor(stg["orders"], tg["srv_wf_settings_ts"]))
    return out
