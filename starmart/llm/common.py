"""Shared pieces of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS_PER_GROUP = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words (runs of non-blank characters); null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_digest(seed: int, *cols: str) -> Column:
    """Seeded md5 (hex) of the named columns, nulls told from empty values."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def unit_interval(digest: Column) -> Column:
    """A hex digest as a double strictly between 0 and 1 (its first 13 digits), in digest order."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Null-safe equality of the named columns."""
    on = F.lit(True)
    for n in names:
        on = on & left[n].eqNullSafe(right[n])
    return on


def with_prefix(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: Column, out: str,
                ) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows that come before, in ``group``.

    ``bucket`` cuts the order of a group into runs (a smaller bucket comes first), so
    no task sorts a whole group: rows are summed within (group, bucket), and what
    stands before a bucket comes from a summary of one row per bucket, itself added
    up in two levels. ``df`` is read twice, so pass a written table.
    """
    up = f"_{out}_up"
    per = (df.groupBy(*group, bucket).agg(F.sum(value).alias("_s"))
           .withColumn(up, F.floor(F.col(bucket) / BUCKETS_PER_GROUP)))
    above = (per.groupBy(*group, up).agg(F.sum("_s").alias("_t"))
             .withColumn("_above", F.coalesce(F.sum("_t").over(
                 Window.partitionBy(*(group or [F.lit(0)])).orderBy(up)
                 .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t"))
    per = per.withColumn("_in", F.coalesce(F.sum("_s").over(
        Window.partitionBy(*group, up).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    per = (per.join(above, same(per, above, [*group, up]))
           .select(*[per[g] for g in group], per[bucket], (F.col("_in") + F.col("_above")).alias("_off")))
    run = df.withColumn("_run", F.coalesce(F.sum(value).over(
        Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (run.join(per, same(run, per, [*group, bucket]))
            .select(*[run[c] for c in df.columns], (F.col("_run") + F.col("_off")).alias(out)))


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Rows with ``idx``, their place from 0 in the ``order`` of their ``group``, and ``n``, the group's rows.

    Rows are written once and cut into ranges of (group, order, place written), so no group is sorted by one task and
    copies of a row are cut apart too; a range's first place comes from one row per (group, range).
    """
    once = materialise(df.withColumn("_at", F.monotonically_increasing_id()), f"{name}-rows")
    by = [*group, *order, "_at"]
    ranged = materialise(once.repartitionByRange(*by).sortWithinPartitions(*by)
                         .withColumn("_pid", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()), f"{name}-order")
    per = ranged.groupBy(*group, "_pid").agg(F.count("*").alias("_n"), F.min("_pos").alias("_p0"))
    own = Window.partitionBy(*group)
    per = per.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)], F.col("_pid").alias("_q"), "_p0", F.sum("_n").over(own).alias("n"),
                     (F.sum("_n").over(own.orderBy("_pid")) - F.col("_n")).alias("_before"))
    on = F.col("_pid") == F.col("_q")
    for k, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    return (ranged.join(per, on).withColumn("idx", F.col("_pos") - F.col("_p0") + F.col("_before"))
            .select(*df.columns, "idx", "n"))


def replace_columns(docs: DataFrame, new: list[str]) -> list[str]:
    """Input columns that stay: those whose name no output column takes (any case)."""
    taken = {n.lower() for n in new}
    return [c for c in docs.columns if c.lower() not in taken]
