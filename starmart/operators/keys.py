"""Surrogate keys, dimension lookups and the rejected-rows report.

* :func:`assign_surrogate` (B10): stable integer ids for natural keys; known keys
  keep their id, new keys are numbered in natural-key order above the current
  maximum. Numbering is distributed: range-partition by the key, count rows per
  partition (one number per partition reaches the driver), turn the counts into
  offsets and add the row's position inside its partition. No global window.
* :func:`lookup` (F1-F8): natural key -> surrogate id inner join. A side is
  broadcast only after a bounded row count proves it small; otherwise the join
  is left to the planner (sort-merge, re-planned by AQE at run time).
* :func:`lookup_rejects` (E6): staged rows lost by inner lookups, with reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from ..session import COMPACT, materialise


# Sides up to this many rows and bytes may be broadcast (checked, not assumed).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes that a row of ``df`` takes in memory."""
    plain, texts, nested = 16, [], []
    for f in df.schema.fields:
        kind, c = f.dataType, F.col(f"`{f.name}`")
        if isinstance(kind, StringType | BinaryType):
            texts.append(F.octet_length(c))
        elif isinstance(kind, ArrayType | MapType | StructType):
            nested.append(F.octet_length(F.to_json(F.struct(c))))
        plain += 16
    size = F.lit(plain).cast("long")
    for t in [*texts, *nested]:
        size = size + F.coalesce(t, F.lit(0))
    return size


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and about ``max_bytes`` bytes; reads at most max_rows + 1 rows."""
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.sum(row_bytes(df))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def number_rows(df: DataFrame, order_by, start=1, id_col: str = "id", written: bool = False) -> DataFrame:
    """Add ``id_col`` = ``start`` + position of the row in ``order_by`` order.

    ``start`` may be a Column (e.g. a scalar subquery ``max(id) + 1`` of the
    target), so no driver round trip is needed. Rows are range-partitioned on
    ``order_by`` and sorted inside each partition, written once, and the
    per-partition counts become offsets. The offsets table has one row per partition; its running
    sum is the only global step and its size is bounded by the partition count,
    not by the data. Equal ``order_by`` values get distinct, arbitrary ids.

    Range partitioning reads its input twice (its bounds come from a pass over it), so ``df`` is written first
    unless it lies written already (``written``): its joins and aggregates run once.
    """
    order_by = _cols(order_by)
    df = df if written else materialise(df, "unnumbered", COMPACT)
    # a hash of the whole row joins the range key: rows with equal order values
    # (a hot key) are spread over several partitions instead of one task
    salt = F.xxhash64(*[F.col(c) for c in df.columns]).alias("_salt")
    ranged = (df.select("*", salt).repartitionByRange(*order_by, "_salt").sortWithinPartitions(*order_by, "_salt")
              .drop("_salt")
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    # written once (shared folder): the counts read two small columns of it and
    # the numbering is a narrow projection over it, so the input is never
    # computed twice and a lost executor cannot change a partition's ids
    ranged = materialise(ranged, "numbered", COMPACT)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_p0"))
    offsets = counts.select("_pid", "_p0", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    out = ranged.join(F.broadcast(offsets), "_pid")
    first = start if isinstance(start, Column) else F.lit(start)
    out = out.withColumn(id_col, (first + F.col("_off") + F.col("_pos") - F.col("_p0")).cast("bigint"))
    return out.drop("_pid", "_pos", "_off", "_p0")


def next_id(known: DataFrame | None, id_col: str = "id") -> Column:
    """``coalesce(max(id), 0) + 1`` of ``known`` as a scalar subquery Column."""
    if known is None:
        return F.lit(1)
    return F.coalesce(known.select(F.max(id_col)).scalar(), F.lit(0)) + F.lit(1)


def assign_surrogate(batch: DataFrame, known: DataFrame | None, natural_keys, id_col: str = "id") -> DataFrame:
    """Mapping ``natural keys -> id`` after adding the keys of ``batch``.

    ``known`` holds the current mapping (may be None or empty). Returns known rows
    unchanged plus new keys numbered from ``max(id) + 1`` in natural-key order.
    """
    keys = _cols(natural_keys)
    new = batch.select(*keys).dropDuplicates(keys)
    if known is None:
        return number_rows(new, keys, start=1, id_col=id_col).select(*keys, id_col)
    known_map = known.select(*keys, id_col)
    new = new.join(known_map.select(*keys), keys, "left_anti")
    numbered = number_rows(new, keys, start=next_id(known_map, id_col), id_col=id_col).select(*keys, id_col)
    return known_map.unionByName(numbered)


def with_surrogate(df: DataFrame, natural_keys, known: DataFrame | None = None, id_col: str = "id") -> DataFrame:
    """Rows of a dimension snapshot ``df`` (one row per natural key) with ids:
    keys already in ``known`` keep their id, the others are numbered after
    the current maximum in natural-key order. Whole rows are numbered, so the
    snapshot is materialised once."""
    keys = _cols(natural_keys)
    cols = [c for c in df.columns if c != id_col]
    if known is None:
        return number_rows(df.select(*cols), keys, start=1, id_col=id_col).select(id_col, *cols)
    known_map = known.select(*keys, id_col)
    old = df.select(*cols).join(known_map, keys).select(id_col, *cols)
    new = df.select(*cols).join(known_map.select(*keys), keys, "left_anti")
    numbered = number_rows(new, keys, start=next_id(known_map, id_col), id_col=id_col).select(id_col, *cols)
    return old.unionByName(numbered)


def lookup(df: DataFrame, dim: DataFrame, on: dict, take: dict, how: str = "inner",
           broadcast_max_rows: int | None = None) -> DataFrame:
    """Join ``df`` to ``dim`` on ``{df_col_or_expr_name: dim_col}`` and bring the
    ``{dim_col: new_name}`` columns of ``take`` (typically ``{'id': 'user_id'}``).
    """
    d = dim.select(*[F.col(v).alias(f"_k{i}") for i, v in enumerate(on.values())],
                   *[F.col(k).alias(v) for k, v in take.items()])
    if broadcast_max_rows is not None and fits_broadcast(d, broadcast_max_rows):
        d = F.broadcast(d)
    cond = None
    for i, left in enumerate(on.keys()):
        e = df[left] == d[f"_k{i}"]
        cond = e if cond is None else cond & e
    out = df.join(d, cond, how)
    return out.drop(*[f"_k{i}" for i in range(len(on))])


def lookup_rejects(df: DataFrame, lookups: list, id_cols) -> DataFrame:
    """Rows of ``df`` that an inner lookup would drop, one row per (row, reason).

    ``lookups``: list of ``(reason, dim, {df_col: dim_col})``. NULL keys are
    rejects too (an inner join drops them). ``(reason, None, column)`` stands for a :func:`lookup` that ``df`` went
    through already (``how="left"``), whose ``column`` is NULL where it missed: all of these take one pass."""
    id_cols = _cols(id_cols)
    parts = []
    made = [F.when(F.col(column).isNull(), F.lit(reason)) for reason, dim, column in lookups if dim is None]
    if made:
        parts.append(df.select(*id_cols, F.explode(F.array_compact(F.array(*made))).alias("reason")))
    for reason, dim, on in lookups:
        if dim is None:
            continue
        d = dim.select(*[F.col(v).alias(f"_k{i}") for i, v in enumerate(on.values())]).dropDuplicates()
        cond = None
        for i, left in enumerate(on.keys()):
            e = df[left] == d[f"_k{i}"]
            cond = e if cond is None else cond & e
        lost = df.join(d, cond, "left_anti").select(*id_cols, F.lit(reason).alias("reason"))
        parts.append(lost)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
