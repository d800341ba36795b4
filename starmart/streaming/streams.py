"""Incremental loads as Structured Streaming queries.

Landed files are a file stream; the stream's checkpoint replaces the stored id
and timestamp cursors (each file is processed exactly once, a rerun with the
same checkpoint adds nothing). Keyed sinks are written with ``foreachBatch``
calling the batch operators, and are idempotent on replay (upsert,
insert-if-absent), so a micro-batch re-run after a failure gives the same table.
All runs here use ``trigger(availableNow=True)``: process what has landed, stop.
A micro-batch is usually small next to the table it feeds: when its size is
within a checked bound it is broadcast, and the table is scanned, not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import casts, money
from ..operators import partitioned as P
from ..operators.keys import BROADCAST_MAX_ROWS
from ..operators.upsert import dedupe_last, insert_absent, upsert
from ..plans.refresh import Warehouse
from ..session import materialise


def stream_source(spark: SparkSession, path: str, schema: StructType | str, glob: str | None = None,
                  fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """File stream over landed files with an explicit schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def _run(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def ingest_once(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append new rows to a Parquet sink (exactly once via the sink's log)."""
    _run(stream.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)


class TableSink:
    """A versioned Parquet table fed by micro-batches."""

    def __init__(self, spark: SparkSession, root: str, name: str, schema: StructType | str):
        self.wh, self.name = Warehouse(spark, root), f"stream.{name}"
        self.spark, self.schema = spark, schema

    def current(self) -> DataFrame:
        df = self.wh.read(self.name)
        return df if df is not None else self.spark.createDataFrame([], self.schema)

    def replace(self, df: DataFrame) -> DataFrame:
        return self.wh.write(self.name, df)


def stream_upsert(stream: DataFrame, sink: TableSink, keys, order_by, checkpoint: str) -> None:
    """Micro-batch upsert (last row per key wins inside a batch)."""
    def each(batch: DataFrame, epoch: int) -> None:
        cur = sink.current()
        sink.replace(upsert(cur, batch.select(*cur.columns), keys, dedupe="last", order_by=order_by,
                            small_batch=BROADCAST_MAX_ROWS))
    _run(stream.writeStream.foreachBatch(each).outputMode("append"), checkpoint)


def stream_insert_absent(stream: DataFrame, sink: TableSink, doc_col: str, checkpoint: str) -> None:
    """Insert-if-absent of JSON documents, however late they come: copies inside a
    micro-batch meet in its deduplication, older ones in the table. No state is kept."""
    def each(batch: DataFrame, epoch: int) -> None:
        cur = sink.current()
        # the sink is only written here, so its documents are canonical already
        sink.replace(insert_absent(cur, batch.select(*cur.columns), canonical_json=doc_col, target_canonical=True,
                                   small_batch=BROADCAST_MAX_ROWS))
    _run(stream.writeStream.foreachBatch(each).outputMode("append"), checkpoint)


def stream_daily_totals(stream: DataFrame, sink: TableSink, ts_col: str, group: list[str], sums: dict,
                        delay: str, checkpoint: str) -> None:
    """Running per-day totals: watermark + 1-day tumbling window, update mode; each
    micro-batch upserts the changed (day, group) rows into the table."""
    agg = (stream.withWatermark(ts_col, delay)
           .groupBy(F.window(ts_col, "1 day").alias("w"), *group)
           .agg(*[F.sum(c).alias(n) for n, c in sums.items()])
           .select(F.to_date(F.col("w.start")).alias("day"), *group, *sums.keys()))

    def each(batch: DataFrame, epoch: int) -> None:
        # the batch comes out of the state store: kept while it is counted and applied
        batch.persist()
        try:
            cur = sink.current()
            sink.replace(upsert(cur, batch.select(*cur.columns), ["day", *group], dedupe="none",
                                small_batch=BROADCAST_MAX_ROWS))
        finally:
            batch.unpersist()
    _run(agg.writeStream.foreachBatch(each).outputMode("update"), checkpoint)


# ---- sinks that touch what a micro-batch touches ------------------------------------------------
class PartitionSink:
    """A table of key buckets fed by micro-batches: each reads and writes the partitions it falls into."""

    def __init__(self, spark: SparkSession, path: str, layout: P.Layout):
        self.spark, self.path, self.layout = spark, path, layout

    def current(self) -> DataFrame:
        return P.read(self.spark, self.path, self.layout).drop(P.BUCKET)

    def merge(self, batch: DataFrame, **more) -> P.Merged:
        return P.merge(self.spark, self.path, self.layout, batch, **more)


def stream_merge(stream: DataFrame, sink: PartitionSink, newer, checkpoint: str) -> None:
    """Keyed rows of which the newest version stays, in whatever order and micro-batch versions come: ``newer`` (columns of the
    table) is compared inside a batch and with the stored row. A replayed batch changes nothing."""
    newer = [newer] if isinstance(newer, str) else list(newer)

    def each(batch: DataFrame, epoch: int) -> None:
        rows = batch.select(*sink.layout.columns)
        sink.merge(dedupe_last(rows, list(sink.layout.keys), newer), newer=newer)
    _run(stream.writeStream.foreachBatch(each).outputMode("append"), checkpoint)


SETTLEMENT_LINES = ("order_id string, restaurant_id string, ts timestamp_ntz, total_sum decimal(14,2), "
                    "bonus_payment decimal(14,2), bonus_grant decimal(14,2)")
SETTLEMENT = P.Layout(("restaurant_id", "settlement_date"), "year(settlement_date) * 12 + month(settlement_date)",
                      "restaurant_id string, settlement_date date, orders_count int, orders_total_sum decimal(14,2), "
                      "orders_bonus_payment_sum decimal(14,2), orders_bonus_granted_sum decimal(14,2), "
                      "order_processing_fee decimal(14,2), restaurant_reward_sum decimal(14,2)")


class SettlementStream:
    """Running settlement (all measures of the daily mart) from a stream of sale lines (:data:`SETTLEMENT_LINES`).

    The lines of a micro-batch are written as a partition of their own (epoch, month), the (restaurant, day) groups they
    fall into are computed again from the written lines of those months, and merged into the mart. So no state is kept, no row
    is too late to count, and a replayed batch overwrites its own partition. Rows further behind the
    newest one of earlier batches than ``delay_days`` are reported as late, with their epoch, in :meth:`late`.
    """

    def __init__(self, spark: SparkSession, root: str, delay_days: int):
        self.spark, self.root, self.delay = spark, root, delay_days
        self.mart = PartitionSink(spark, f"{root}/mart", SETTLEMENT)

    def lines(self) -> DataFrame:
        schema = StructType.fromDDL(SETTLEMENT_LINES + ", late boolean, epoch bigint, month bigint")
        if not P.exists(self.spark, f"{self.root}/lines"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/lines")

    def late(self) -> DataFrame:
        return self.lines().where("late").drop("late", "month")

    def each(self, batch: DataFrame, epoch: int) -> None:
        rows = batch.select(*StructType.fromDDL(SETTLEMENT_LINES).fieldNames())
        newest = self.lines().where(F.col("epoch") < epoch).agg(F.max("ts")).first()[0]
        late = F.lit(False) if newest is None else F.coalesce(
            F.col("ts") < F.lit(newest) - F.make_dt_interval(days=F.lit(self.delay)), F.lit(False))
        month = (F.year("ts") * 12 + F.month("ts")).cast("bigint")
        rows = rows.where(F.col("ts").isNotNull()).withColumns({"late": late, "epoch": F.lit(epoch).cast("bigint"), "month": month})
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch", "month")
         .parquet(f"{self.root}/lines"))
        mine = self.lines().where(F.col("epoch") == epoch)
        groups = materialise(mine.select("restaurant_id", F.to_date("ts").alias("settlement_date")).distinct(), "stream-groups")
        months = [r[0] for r in mine.select("month").distinct().collect()]
        again = self.lines().where(F.col("month").isin(months)).withColumn("settlement_date", F.to_date("ts"))
        again = again.join(groups, ["restaurant_id", "settlement_date"], "left_semi")
        g = again.groupBy("restaurant_id", "settlement_date").agg(
            F.count_distinct("order_id").alias("orders_count"), F.sum("total_sum").alias("orders_total_sum"),
            F.sum("bonus_payment").alias("orders_bonus_payment_sum"), F.sum("bonus_grant").alias("orders_bonus_granted_sum"))
        g = g.select("*", money.fee("orders_total_sum").alias("order_processing_fee"),
                     money.restaurant_reward("orders_total_sum", "orders_bonus_payment_sum").alias("restaurant_reward_sum"))
        self.mart.merge(casts.conform(g, StructType.fromDDL(SETTLEMENT.schema)))

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        _run(stream.writeStream.foreachBatch(self.each).outputMode("append"), checkpoint)
