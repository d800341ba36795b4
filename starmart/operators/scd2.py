"""Slowly-changing history (type 2): build, apply a batch, as-of lookup.

Ordered neighbour logic (previous version, next change) is computed with
windows partitioned by (key, bucket), not by key alone. The neighbour across a
bucket edge comes from a small per-(key, bucket) summary (one row per key and
bucket), ordered per key.

Buckets: ``bucket="range"`` (default) range-partitions the rows on (key, time,
attributes), writes that copy once and uses the partition number as bucket, so
a key holding a third of all rows is cut into many slices of about equal size
whatever its time spread. A time unit (``"day"``, ``"month"``, ...) buckets by
``date_trunc`` instead: no extra write, but all rows of one key and one period
share a task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import OPEN_END
from ..session import materialise
from .upsert import dedupe_last


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` in which NULL equals NULL, so rows without a key have a history too."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(right, on, how).drop(*[f"_r_{k}" for k in keys])


def _with_bucket(df: DataFrame, bucket: str, order: list, ts_col: str, name: str) -> DataFrame:
    """Add ``_b``: a time bucket, or the partition of a range partitioning on
    ``order`` (written once, so the buckets stay fixed if a task is re-run).
    Partitions hold consecutive ranges, so per key the bucket number grows with
    time like a time bucket does."""
    if bucket != "range":
        return df.withColumn("_b", F.date_trunc(bucket, ts_col))
    # a hash of the whole row and then the row's position end the range key:
    # rows that tie on ``order`` are cut apart by content (the same way if a task
    # is re-run), and only exact copies of one row (a hot group of copies) by
    # position, where it does not matter which copy lands where. The windows
    # order by ``order`` alone, so where ties are cut does not change the result.
    ranged = (df.withColumns({"_h": F.xxhash64(*[F.col(c) for c in df.columns]),
                              "_pos": F.monotonically_increasing_id()})
              .repartitionByRange(*order, "_h", "_pos").drop("_h", "_pos")
              .withColumn("_b", F.spark_partition_id()))
    return materialise(ranged, name)


def scd2_build(changes: DataFrame, key, ts: str, attrs, bucket: str = "range",
               open_end: str = OPEN_END, active_from: str = "active_from",
               active_to: str = "active_to", materialise_starts: bool = True) -> DataFrame:
    """History intervals from a change log.

    Rows equal (in ``attrs``) to the previous row of their key are collapsed;
    ``active_from`` is the first timestamp of a run, ``active_to`` the start of the
    next run or ``open_end``. Ties in ``ts`` are ordered by the attributes (all but the
    last get a zero-length interval); rows with a NULL key share one history.
    """
    keys, attrs = _cols(key), _cols(attrs)
    end = F.lit(open_end).cast("timestamp_ntz")
    rows = changes.select(*keys, F.col(ts).cast("timestamp_ntz").alias("_ts"),
                          F.struct(*[F.col(a) for a in attrs]).alias("_a"))
    order = ["_ts", "_a"]
    rows = _with_bucket(rows, bucket, [*keys, *order], "_ts", "scd2-ranged")
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    rows = rows.withColumns({"_prev": F.lag("_a").over(w), "_rn": F.row_number().over(w)})

    # last attributes of the previous bucket of the same key
    summ = rows.groupBy(*keys, "_b").agg(F.max_by("_a", F.struct(*order)).alias("_last"))
    summ = summ.withColumn("_pb_last", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_b")))
    rows = _join(rows, summ.select(*keys, "_b", "_pb_last"), [*keys, "_b"])
    prev = F.when(F.col("_rn") == 1, F.col("_pb_last")).otherwise(F.col("_prev"))
    starts = rows.where(prev.isNull() | ~prev.eqNullSafe(F.col("_a"))).select(*keys, "_ts", "_a", "_b")
    if materialise_starts:
        # the interval starts feed two branches (next start inside the bucket,
        # first start per bucket): written once instead of shuffling twice
        starts = materialise(starts, "scd2-starts")

    # next start of the same key: inside the bucket, else first start of the next bucket that has one
    w2 = Window.partitionBy(*keys, "_b").orderBy(*order)
    starts = starts.withColumn("_next", F.lead("_ts").over(w2))
    firsts = starts.groupBy(*keys, "_b").agg(F.min("_ts").alias("_first"))
    firsts = firsts.withColumn("_nb_first", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_b")))
    out = _join(starts, firsts.select(*keys, "_b", "_nb_first"), [*keys, "_b"])
    return out.select(*keys, *[F.col("_a")[a].alias(a) for a in attrs],
                      F.col("_ts").alias(active_from),
                      F.coalesce("_next", "_nb_first", end).alias(active_to))


def scd2_apply(history: DataFrame, batch: DataFrame, key, ts: str, attrs, bucket: str = "range",
               open_end: str = OPEN_END, active_from: str = "active_from",
               active_to: str = "active_to") -> DataFrame:
    """Apply a batch of versions (possibly late, several per key) to a history.

    Keys not in the batch keep their rows untouched; touched keys are rebuilt from
    their existing interval starts plus the batch (a batch row at an existing
    start replaces it), which closes changed rows and opens new ones.
    """
    keys, attrs = _cols(key), _cols(attrs)
    touched = batch.select(*keys).dropDuplicates()
    untouched = _join(history, touched, keys, "left_anti")
    old = (_join(history, touched, keys, "left_semi")
           .select(*keys, F.col(active_from).alias(ts), *attrs, F.lit(0).alias("_p")))
    new = batch.select(*keys, F.col(ts).cast("timestamp_ntz").alias(ts), *attrs, F.lit(1).alias("_p"))
    points = dedupe_last(old.unionByName(new), [*keys, ts], "_p").drop("_p")
    rebuilt = scd2_build(points, keys, ts, attrs, bucket, open_end, active_from, active_to)
    return untouched.select(*rebuilt.columns).unionByName(rebuilt)


def asof_lookup(fact: DataFrame, dim: DataFrame, key, ts: str, take, how: str = "inner",
                active_from: str = "active_from", active_to: str = "active_to",
                bucket: str = "range") -> DataFrame:
    """Join each fact row to the dimension version valid at its time
    (``active_from <= ts < active_to``, same key; a NULL key is a key like any other).

    Zero-length versions are valid at no time and never looked up. Where versions
    overlap, the one that starts last, then the one that ends last, is taken.

    Implemented as a sort-based as-of merge: facts and versions are unioned and
    ordered per (key, bucket), the latest version at or before the fact is
    carried forward; versions from earlier buckets come from a per-(key, bucket)
    summary. No key-only equi-join, so a key with many versions and many facts
    never expands into all pairs.
    """
    keys = _cols(key)
    take = {c: c for c in _cols(take)} if not isinstance(take, dict) else take
    fcols = fact.columns
    dim = dim.where(F.col(active_from) < F.col(active_to))
    dstruct = F.struct(*[F.col(c).alias(n) for c, n in take.items()], F.col(active_from).alias("_from"),
                       F.col(active_to).alias("_to"))
    f = fact.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(ts).cast("timestamp_ntz").alias("_t"),
                    F.lit(0).alias("_is_dim"), F.struct(*fcols).alias("_f"), F.lit(None).alias("_d"))
    d = dim.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(active_from).cast("timestamp_ntz").alias("_t"),
                   F.lit(1).alias("_is_dim"), F.lit(None).alias("_f"), dstruct.alias("_d"))
    f = f.withColumn("_d", F.col("_d").cast(d.schema["_d"].dataType))
    d = d.withColumn("_f", F.col("_f").cast(f.schema["_f"].dataType))
    kk = [f"_k_{k}" for k in keys]
    order = ["_t", F.col("_is_dim").desc(), F.col("_d")["_to"], "_d"]
    u = _with_bucket(f.unionByName(d), bucket, [*kk, *order], "_t", "asof-ranged")
    w = (Window.partitionBy(*kk, "_b").orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.withColumn("_cand", F.last("_d", ignorenulls=True).over(w))

    # latest version of every earlier bucket, for facts with no version in their own bucket yet
    newest = F.when(F.col("_is_dim") == 1, F.struct("_t", F.col("_d")["_to"], "_d"))
    summ = u.groupBy(*kk, "_b").agg(F.max_by("_d", newest).alias("_bd"))
    ws = Window.partitionBy(*kk).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_pd", F.last("_bd", ignorenulls=True).over(ws)).select(*kk, "_b", "_pd")

    facts = _join(u.where(F.col("_is_dim") == 0), summ, [*kk, "_b"])
    ver = F.coalesce("_cand", "_pd")
    valid = ver.isNotNull() & (F.col("_t") < ver["_to"])
    facts = facts.withColumn("_v", F.when(valid, ver))
    if how == "inner":
        facts = facts.where(F.col("_v").isNotNull())
    elif how != "left":
        raise ValueError("how must be 'inner' or 'left'")
    return facts.select(*[F.col("_f")[c].alias(c) for c in fcols], *[F.col("_v")[n].alias(n) for n in take.values()])
