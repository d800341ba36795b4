"""Source data derived from the driver's TPC-H-style tables.

The three source systems are played by the driver tables (one mapping, used by
every query and by the benchmark):

* users       <- customer  (login = lower(name))
* restaurants <- supplier; menu = the parts with ``partkey % n_suppliers`` = suppkey
* couriers    <- nation
* orders      <- orders; restaurant = ``orderkey % n_suppliers``; status F/O/P ->
  CLOSED/OPEN/CANCELLED; ``date`` = ``update_ts`` = order date
* deliveries  <- orders that are not OPEN (open orders are not delivered yet);
  courier = the customer's nation, rate = 1 + orderkey % 5, tip = orderkey % 200
* bonus events<- lineitem grouped per order (one payment per line), event time =
  order date
* outbox      <- events

Collections are built as typed DataFrames (like a landed export) and then go
through the same staging functions a real export would.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import to_document
from ..functions.timefmt import DOC_DATETIME
from ..session import COMPACT, materialise, scratch_path
from ..sources.documents import stage_documents

SPREAD_TABLES = ("orders", "lineitem", "customer", "part", "events")
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed values of the mapping (shared with the oracle SQL).
STATUS = {"F": "CLOSED", "O": "OPEN", "P": "CANCELLED"}
DIM_EPOCH = "1995-01-01 00:00:00"   # users/restaurants update_ts = epoch + (key % 1000) days
DIM_SPREAD_DAYS = 1000
FIRST_LOAD_FLOOR = "1995-01-01 00:00:00"   # cursor floor for a first load of driver data


class Tables(dict):
    """Lazily read driver tables: ``t['orders']``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name):
        df = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        # a small table stored as one row group is one task; spread it over the
        # cores (never triggers on large inputs, which have many splits)
        cores = self.spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores and name in SPREAD_TABLES:
            df = df.repartition(cores)
        self[name] = df
        return df


def _status(col) -> F.Column:
    c = F.col(col)
    out = None
    for k, v in STATUS.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def _spread_ts(key_col: str) -> F.Column:
    return (F.lit(DIM_EPOCH).cast("timestamp_ntz")
            + F.make_dt_interval(days=(F.col(key_col) % DIM_SPREAD_DAYS).cast("int")))


def n_suppliers(t: Tables) -> F.Column:
    """Scalar subquery: number of restaurants."""
    return t["supplier"].select(F.count(F.lit(1))).scalar()


# ---- collections (typed, as landed) --------------------------------------
def users_collection(t: Tables) -> DataFrame:
    c = t["customer"]
    return c.select(F.col("c_custkey").cast("string").alias("_id"), F.col("c_name").alias("name"),
                    F.lower("c_name").alias("login"), _spread_ts("c_custkey").alias("update_ts"))


def menu_items(t: Tables) -> DataFrame:
    p = t["part"]
    return p.select((F.col("p_partkey") % n_suppliers(t)).alias("_rid"),
                    F.col("p_partkey").cast("string").alias("_id"), F.col("p_name").alias("name"),
                    F.col("p_retailprice").cast("decimal(14,2)").alias("price"))


def restaurants_collection(t: Tables) -> DataFrame:
    """Menus are small per restaurant (parts / suppliers items), so collecting
    them per restaurant is bounded."""
    menus = menu_items(t).groupBy("_rid").agg(
        F.array_sort(F.collect_list(F.struct("_id", "name", "price"))).alias("menu"))
    s = t["supplier"]
    j = s.join(menus, s["s_suppkey"] == menus["_rid"], "left")
    return j.select(F.col("s_suppkey").cast("string").alias("_id"), F.col("s_name").alias("name"),
                    F.coalesce("menu", F.array().cast(menus.schema["menu"].dataType)).alias("menu"),
                    _spread_ts("s_suppkey").alias("update_ts"))


def orders_collection(t: Tables) -> DataFrame:
    o = t["orders"]
    return o.select(F.col("o_orderkey").cast("string").alias("_id"), _status("o_orderstatus").alias("final_status"),
                    F.col("o_orderdate").alias("date"),
                    F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"),
                    F.struct((F.col("o_orderkey") % n_suppliers(t)).cast("string").alias("id")).alias("restaurant"),
                    F.col("o_orderdate").alias("update_ts"))


def courier_items(t: Tables) -> DataFrame:
    n = t["nation"]
    return n.select(F.col("n_nationkey").cast("string").alias("_id"), F.col("n_name").alias("name"))


def delivery_items(t: Tables) -> DataFrame:
    o = t["orders"].where(F.col("o_orderstatus") != "O")
    c = t["customer"].select("c_custkey", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.select(F.col("o_orderkey").cast("string").alias("order_id"),
                    F.date_format("o_orderdate", DOC_DATETIME).alias("order_ts"),
                    F.col("c_nationkey").cast("string").alias("courier_id"),
                    (F.lit(1) + F.col("o_orderkey") % 5).cast("int").alias("rate"),
                    (F.col("o_orderkey") % 200).cast("decimal(14,2)").alias("tip_sum"))


def payment_lines(t: Tables, li: DataFrame | None = None) -> DataFrame:
    li = t["lineitem"] if li is None else li
    cost = F.col("l_extendedprice").cast("decimal(14,2)")
    return li.select(
        "l_orderkey",
        F.struct(F.col("l_partkey").cast("string").alias("product_id"),
                 F.col("l_quantity").cast("int").alias("quantity"),
                 cost.alias("price"),
                 cost.alias("product_cost"),
                 (cost * F.col("l_discount").cast("decimal(4,2)")).alias("bonus_payment"),
                 (cost * F.col("l_tax").cast("decimal(4,2)")).alias("bonus_grant")).alias("p"))


# ---- staged tables ----------------------------------------------------------
def stg_users(t: Tables) -> DataFrame:
    return stage_documents(users_collection(t))


def stg_restaurants(t: Tables) -> DataFrame:
    return stage_documents(restaurants_collection(t))


def stg_orders(t: Tables, cursor=None) -> DataFrame:
    return stage_documents(orders_collection(t), cursor=cursor)


def stg_couriers(t: Tables) -> DataFrame:
    return courier_items(t).select(to_document(F.col("_id"), F.col("name")).alias("courier_info"))


def stg_deliveries(t: Tables) -> DataFrame:
    return delivery_items(t).select(to_document().alias("deliveri_info"))


def stg_bonus_events(t: Tables) -> DataFrame:
    """One bonus event per order; lines per order are few, so per-order arrays are bounded. The lines meet by their plain
    columns first: a task then gathers arrays for its share of the orders only, and no array is shuffled."""
    li = t["lineitem"].where(F.col("l_orderkey").isNotNull()).select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax").repartition("l_orderkey")
    per_order = payment_lines(t, li).groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list("p")).alias("product_payments"))
    o = t["orders"].select("o_orderkey", "o_orderdate")
    j = per_order.join(o, per_order["l_orderkey"] == o["o_orderkey"])
    return j.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("event_ts"),
                    F.lit("bonus_transaction").alias("event_type"),
                    to_document(F.col("o_orderkey").cast("string").alias("order_id"),
                                F.col("product_payments")).alias("event_value"))


def outbox(t: Tables) -> DataFrame:
    e = t["events"]
    return e.select(F.col("event_id").alias("id"), F.col("ts").alias("event_ts"), "event_type",
                    F.col("props").alias("event_value"))


def staging(t: Tables, materialise: bool = False) -> dict[str, DataFrame]:
    """The staging layer. With ``materialise`` each staged table is written once, as it is first asked for
    (as the staging jobs do), so the detail-layer jobs read it instead of rebuilding the documents and
    a job writes the tables that it reads."""
    stg = {"users": stg_users(t), "restaurants": stg_restaurants(t), "orders": stg_orders(t),
           "couriers": stg_couriers(t), "deliveries": stg_deliveries(t), "events": stg_bonus_events(t)}
    return Staged(stg) if materialise else stg


class Staged(dict):
    """Staged tables of which each is written when it is first read."""

    def __init__(self, rows: dict[str, DataFrame]):
        super().__init__()
        self.rows = rows

    def __missing__(self, name):
        self[name] = materialise(self.rows[name], f"stg-{name}", COMPACT)
        return self[name]


# ---- two loads of one source: what staging held at a first run, and at a second one ---------------
LOAD_CUT = "1997-06-01 00:00:00"      # orders from here on come with the second load
LATE_DAYS = 60


def _second(df: DataFrame, version: int) -> DataFrame:
    return df.withColumn("loaded_at", F.lit(version))


def two_loads(t: Tables, last: dict | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Staging at two runs. The second holds the source as it is; at the first, orders after the cut were missing, and of the
    others some were still open at another restaurant, some deliveries of the last ``LATE_DAYS`` had not arrived or named
    another courier and tip, and some couriers and restaurants had another name. ``last`` is the staging layer of the source
    as it is; what both loads hold is taken from it, and documents that are read again and again are written once."""
    cut = F.lit(LOAD_CUT).cast("timestamp_ntz")
    key = F.col("_id").cast("bigint")
    last = staging(t, materialise=True) if last is None else last
    orders, ns = orders_collection(t), n_suppliers(t)
    moved = (F.col("date") < cut) & (key % 7 == 0)
    before = orders.where(F.col("date") < cut).withColumns({
        "final_status": F.when(moved, "OPEN").otherwise(F.col("final_status")),
        "restaurant": F.struct(F.when(moved, ((key + 1) % ns).cast("string")).otherwise(F.col("restaurant.id")).alias("id"))})
    after = orders.withColumn("update_ts", F.when(moved, cut).otherwise(F.col("update_ts")))
    items = delivery_items(t).withColumn("_ts", F.to_timestamp_ntz("order_ts", F.lit(DOC_DATETIME)))
    recent = F.col("_ts") >= cut - F.make_dt_interval(days=F.lit(LATE_DAYS))
    okey = F.col("order_id").cast("bigint")
    wrong = recent & (okey % 11 == 0)
    early = items.where((F.col("_ts") < cut) & ~(recent & (okey % 5 == 0))).withColumns({
        "courier_id": F.when(wrong, ((F.col("courier_id").cast("int") + 1) % 25).cast("string")).otherwise(F.col("courier_id")),
        "tip_sum": F.when(wrong, F.col("tip_sum") + 1).otherwise(F.col("tip_sum")).cast("decimal(14,2)")}).drop("_ts")
    early = materialise(_second(early.select(to_document().alias("deliveri_info")), 1), "load-deliveries", COMPACT)
    names = courier_items(t).withColumn("name", F.when(F.col("_id").cast("int") % 6 == 0, F.concat("name", F.lit(" old"))).otherwise(F.col("name")))
    names = _second(names.select(to_document(F.col("_id"), F.col("name")).alias("courier_info")), 1)
    places = restaurants_collection(t)
    renamed = F.col("_id").cast("bigint") % 9 == 0

    def kept(collection: DataFrame) -> DataFrame:
        return materialise(stage_documents(collection), "load-restaurants", COMPACT)

    first = {"users": last["users"], "couriers": names, "deliveries": early, "orders": stage_documents(before),
             "restaurants": kept(places.withColumn("name", F.when(renamed, F.lower("name")).otherwise(F.col("name")))),
             "events": last["events"].where(F.col("event_ts") < cut)}
    second = {"users": last["users"], "couriers": names.unionByName(_second(last["couriers"], 2)), "events": last["events"],
              "deliveries": early.unionByName(_second(last["deliveries"], 2)), "orders": stage_documents(after),
              "restaurants": kept(places.withColumn("update_ts", F.when(renamed, cut).otherwise(F.col("update_ts"))))}
    return first, second


# ---- files that arrive one after the other ----------------------------------------------------------
def land_batches(df: DataFrame, path: str, arrival: str, n: int) -> Iterator[int]:
    """Lands ``df`` in ``n`` steps, in the order of column ``arrival`` (0 to n - 1), and gives way after each, so that a stream
    run there takes the step's rows as one micro-batch, in however many files they came. ``df`` is computed once, by all tasks."""
    steps = scratch_path(df.sparkSession, "arrivals")
    df.write.option("compression", COMPACT).partitionBy(arrival).parquet(steps)
    rows = df.sparkSession.read.schema(df.schema).parquet(steps)
    for k in range(n):
        rows.where(F.col(arrival) == k).select(*[c for c in df.columns if c != arrival]).write.mode("append").parquet(
            path, compression=COMPACT)
        yield k


def order_versions(t: Tables) -> DataFrame:
    """Two versions of every order with the file each comes in; of a third of the orders the older one comes last."""
    o = t["orders"]
    old = o.select(F.col("o_orderkey").cast("string").alias("order_key"), F.lit("OPEN").alias("order_status"),
                   F.col("o_orderdate").alias("update_ts"), F.when(F.col("o_orderkey") % 3 == 0, 2).otherwise(0).alias("arrival"))
    new = o.select(F.col("o_orderkey").cast("string").alias("order_key"), _status("o_orderstatus").alias("order_status"),
                   (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(1))).alias("update_ts"), F.lit(1).alias("arrival"))
    return old.unionByName(new)


def sale_lines(t: Tables, files: int) -> DataFrame:
    """Lines of closed orders with the file each comes in: by year of the order, every tenth order one file later."""
    o = t["orders"].where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", (F.col("o_orderkey") % n_suppliers(t)).cast("string").alias("restaurant_id"), F.col("o_orderdate").alias("ts"))
    p = payment_lines(t)
    j = p.join(o, p["l_orderkey"] == o["o_orderkey"])
    late = F.when(F.col("o_orderkey") % 10 == 0, 1).otherwise(0)
    return j.select(F.col("o_orderkey").cast("string").alias("order_id"), "restaurant_id", "ts", F.col("p.product_cost").alias("total_sum"),
                    F.col("p.bonus_payment").cast("decimal(14,2)").alias("bonus_payment"),
                    F.col("p.bonus_grant").cast("decimal(14,2)").alias("bonus_grant"),
                    F.least(F.year("ts") - 1995 + late, F.lit(files - 1)).cast("int").alias("arrival"))


def land_pages(t: Tables, path: str, page_rows: int) -> None:
    """Deliveries as an endpoint answers them: pages of ``page_rows`` in the order of time, then an empty page."""
    from ..operators.keys import number_rows
    from ..sources.pages import LandedPages
    items = number_rows(delivery_items(t), ["order_ts", "order_id"], start=0, id_col="_n")
    pages = items.withColumn("page", F.floor(F.col("_n") / page_rows).cast("int")).drop("_n")
    pages = pages.select("page", to_document("order_id", "order_ts", "courier_id", "rate", "tip_sum").alias("item"))
    t.spark.dataSource.register(LandedPages)
    pages.repartition("page").sortWithinPartitions("page").write.format("landed_pages").mode("append").option("path", path).save()
