"""Keyed writes re-expressed as DataFrame algebra.

Parquet tables have no row-level MERGE, so every write computes the *next
snapshot* of a table from the current one and a batch:

* :func:`upsert`        ``INSERT .. ON CONFLICT (keys) DO UPDATE`` (B1, B2, B5)
* :func:`insert_absent` ``INSERT .. ON CONFLICT DO NOTHING``          (B3)
* :func:`append`        plain ``INSERT``                              (B4)
* :func:`dedupe_last` / :func:`duplicate_keys` in-batch duplicates    (B6, B7)
* :func:`save_cursor` / :func:`cursor_per_type` incremental cursors   (B8, B9)
* :func:`apply_defaults` column defaults                              (B11)

All of them are one shuffle on the key columns; duplicates are collapsed with
partially aggregated ``max_by`` so a hot key is reduced map-side before the
shuffle, never gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, IntegralType, StringType, TimestampNTZType,
                               TimestampType)

from ..functions.json import canonical
from ..session import materialise


_EXACT_KEYS = (StringType, IntegralType, DateType, TimestampType, TimestampNTZType, BooleanType, BinaryType)


class DuplicateKeyError(ValueError):
    """A batch holds one key more than once and the policy is ``error``."""


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def dedupe_last(df: DataFrame, keys, order_by) -> DataFrame:
    """Keep, per key, the row that comes last in ``order_by`` (row-by-row
    ``executemany`` semantics: the last row written wins).

    The order is compared as a struct, so a NULL order value sorts first instead
    of being skipped. Ties are broken by the whole row for a deterministic result.
    What is compared is the row itself, each column once: the order first, then the rest; text and whole-number
    keys come from the group. The sorts and the shuffle hold no second copy of a row.
    """
    keys, order_by = _cols(keys), _cols(order_by)
    cols = df.columns
    # equal fractions may differ in their bits (-0.0), so such keys stay in the row
    known = [k for k in keys if k in cols and isinstance(df.schema[k].dataType, _EXACT_KEYS)]
    first = {f"_o{i}": c for i, c in enumerate(order_by)}
    rest = [c for c in cols if c not in known and c not in order_by]
    best = F.max(F.struct(*[F.col(c).alias(o) for o, c in first.items()], *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)]))
    of = {c: o for o, c in first.items()} | {c: f"_r{i}" for i, c in enumerate(rest)}
    return df.groupBy(*keys).agg(best.alias("_row")).select(
        *[F.col(c) if c in known else F.col("_row")[of[c]].alias(c) for c in cols])


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys present more than once, with their count (``n``)."""
    keys = _cols(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_unique(df: DataFrame, keys) -> DataFrame:
    """Raise :class:`DuplicateKeyError` when ``keys`` repeat (one small action)."""
    dups = duplicate_keys(df, keys).limit(20).collect()
    if dups:
        raise DuplicateKeyError(f"duplicate keys {_cols(keys)}: {[tuple(r) for r in dups]}")
    return df


def _prepare_batch(batch: DataFrame, keys, dedupe: str, order_by) -> DataFrame:
    if dedupe == "last":
        if order_by is None:
            raise ValueError("dedupe='last' needs order_by (the column that says which row is newer)")
        return dedupe_last(batch, keys, order_by)
    if dedupe == "error":
        return check_unique(batch, keys)
    if dedupe == "none":
        return batch
    raise ValueError(f"unknown dedupe policy {dedupe!r}")


def _small(df: DataFrame, small_batch) -> tuple[DataFrame, bool]:
    """The batch and whether it is small. ``small_batch``: False (no), True (caller knows it is small) or a row bound:
    then the batch is written once, as it is read several times, and its rows and bytes are checked."""
    if small_batch is True or small_batch is False:
        return df, small_batch
    from .keys import fits_broadcast
    df = materialise(df, "small-batch")
    return df, fits_broadcast(df, int(small_batch))


def upsert(target: DataFrame, batch: DataFrame, keys, update_cols: Sequence[str] | None = None,
           dedupe: str = "last", order_by=None, small_batch=False) -> DataFrame:
    """Next snapshot of ``target`` after ``INSERT batch ON CONFLICT (keys) DO UPDATE SET update_cols``.

    * rows of ``target`` whose key is not in ``batch`` are kept;
    * new keys are inserted with all batch columns (target columns missing from
      the batch become NULL);
    * matched keys take ``update_cols`` from the batch (default: all non-key
      columns) and keep the rest from the target.

    Plan: one full outer join on the keys (both sides shuffled once). With
    ``small_batch`` (True, or a row bound that is checked) the batch is broadcast
    instead and the target is only scanned, never shuffled: untouched rows by a
    broadcast anti join, matched rows by a broadcast join, new keys by an anti
    join against the (batch-sized) set of matched keys.
    """
    keys = _cols(keys)
    cols = target.columns
    non_key = [c for c in cols if c not in keys]
    update_cols = non_key if update_cols is None else list(update_cols)
    missing = [c for c in update_cols if c not in batch.columns]
    if missing:
        raise ValueError(f"update columns not in batch: {missing}")
    b = _prepare_batch(batch, keys, dedupe, order_by)
    b = b.select(*[F.col(c) if c in batch.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
                   for c in cols])
    b, small = _small(b, small_batch)
    if small:
        return _upsert_broadcast(target, b, keys, cols, update_cols)
    t = target.select(*cols, F.lit(True).alias("_in_t"))
    b = b.select(*[F.col(c).alias(c if c in keys else f"_b_{c}") for c in cols], F.lit(True).alias("_in_b"))
    j = t.join(b, keys, "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(F.col("_in_b"), F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("_in_t"), F.col(c)).otherwise(F.col(f"_b_{c}")).alias(c))
    return j.select(*out)


def _upsert_broadcast(target: DataFrame, b: DataFrame, keys, cols, update_cols) -> DataFrame:
    bk = F.broadcast(b.select(*keys))
    untouched = target.join(bk, keys, "left_anti")
    bb = F.broadcast(b.select(*[F.col(c).alias(c if c in keys else f"_b_{c}") for c in cols]))
    matched = target.join(bb, keys, "inner").select(
        *[F.col(c) if c in keys else (F.col(f"_b_{c}") if c in update_cols else F.col(c)).alias(c) for c in cols])
    hit = target.join(bk, keys, "left_semi").select(*keys).distinct()      # at most the keys of the batch
    new = b.join(F.broadcast(hit), keys, "left_anti").select(*cols)
    return untouched.select(*cols).unionByName(matched).unionByName(new)


def insert_absent(target: DataFrame, batch: DataFrame, keys=None, canonical_json: str | None = None,
                  small_batch=False, target_canonical: bool = False, bad: str = "error") -> DataFrame:
    """Next snapshot after ``INSERT batch ON CONFLICT DO NOTHING``.

    ``keys``: the unique columns (default: all columns). ``canonical_json``: name
    of a JSON text column that *is* the key (JSONB semantics: key order, blanks
    and ``2.0`` vs ``2`` do not matter); it is stored in canonical form.
    With ``small_batch`` the target is probed with the broadcast batch keys
    instead of being shuffled. ``target_canonical``: the target was written by
    this function (its documents are canonical already), so only the batch is
    parsed; otherwise every target document is canonicalised too (one that is no
    JSON stays as it is).

    ``bad`` says what becomes of batch documents that are no JSON: ``"error"`` fails the
    load, as the source's cast does; ``"keep_out"`` leaves them out of the table, and
    :func:`bad_documents` returns them for a quarantine. Of batch rows with equal
    keys the smallest stays.
    """
    if bad not in ("error", "keep_out"):
        raise ValueError("bad must be 'error' or 'keep_out'")
    cols = target.columns
    b = batch.select(*cols)
    t = target
    if canonical_json:
        if bad == "keep_out":
            b = b.where(~_no_json(canonical_json))
        broken = F.when(F.col(canonical_json).isNotNull(), F.raise_error(F.concat(
            F.lit("document is no JSON: "), F.left(F.col(canonical_json), F.lit(200)))).cast("string"))
        b = b.withColumn(canonical_json, F.coalesce(canonical(canonical_json), broken))
        if not target_canonical:
            t = t.withColumn(canonical_json, F.coalesce(canonical(canonical_json), F.col(canonical_json)))
        keys = [canonical_json]
    keys = cols if keys is None else _cols(keys)
    rest = [c for c in cols if c not in keys]
    if rest:
        b = b.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r"))
        b = b.select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in cols])
    else:
        b = b.dropDuplicates(keys)
    b, small = _small(b, small_batch)
    if small:
        present = t.join(F.broadcast(b.select(*keys)), keys, "left_semi").select(*keys).distinct()      # at most those of the batch
        new = b.join(F.broadcast(present), keys, "left_anti")
    else:
        new = b.join(t.select(*keys), keys, "left_anti")
    return t.unionByName(new)


def _no_json(col: str) -> Column:
    return F.col(col).isNotNull() & canonical(col).isNull()


def bad_documents(batch: DataFrame, col: str) -> DataFrame:
    """The rows of ``batch`` whose document ``col`` is no JSON, with a ``reason``."""
    return batch.where(_no_json(col)).withColumn("reason", F.lit("malformed json"))


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Plain ``INSERT``: duplicates of earlier loads are kept (T7 parity mode)."""
    return target.unionByName(batch.select(*target.columns))


def max_cursor(df: DataFrame, col: str, previous=None) -> Column:
    """Aggregate expression for a new cursor value: ``max(col)``, or the
    previous value when the batch is empty (never NULL into a NOT NULL cursor)."""
    m = F.max(col)
    return m if previous is None else F.coalesce(m, F.lit(previous))


def save_cursor(cursors: DataFrame, name, value_df: DataFrame) -> DataFrame:
    """Upsert one cursor row per ``name`` (``cursors``: id, value columns).

    ``value_df`` is a one-row frame with the same columns; a NULL value (empty
    batch) leaves the stored cursor as it was."""
    keys = _cols(name)
    value_cols = [c for c in cursors.columns if c not in keys]
    v = value_df.dropna(how="any", subset=value_cols)
    return upsert(cursors, v, keys, dedupe="none")


def cursor_per_type(batch: DataFrame, type_col: str, id_col: str, payload_col: str) -> DataFrame:
    """Keyed cursor with payload: per type the highest id and the payload of that
    row (``workflow_key``, ``id``, ``workflow_settings``)."""
    return (batch.groupBy(type_col)
            .agg(F.max(id_col).alias(id_col), F.max_by(payload_col, id_col).alias(payload_col))
            .select(F.col(id_col).alias("id"), F.col(type_col).alias("workflow_key"),
                    F.col(payload_col).alias("workflow_settings")))


def apply_defaults(df: DataFrame, defaults: dict, schema=None) -> DataFrame:
    """Column defaults: a column *absent* from the insert gets its default; an
    explicit NULL stays NULL (and is caught by the not-null rule)."""
    out = df
    for c, v in defaults.items():
        if c not in out.columns:
            lit = F.lit(v)
            if schema is not None and c in schema.fieldNames():
                lit = lit.cast(schema[c].dataType)
            out = out.withColumn(c, lit)
    if schema is not None:
        out = out.select(*[c for c in schema.fieldNames() if c in out.columns])
    return out
