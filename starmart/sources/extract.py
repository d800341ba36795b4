"""Incremental and full extraction (A1, A2, A8, A10, C1, C2).

Cursor filters are plain predicates, so Catalyst pushes them to the scan
(Parquet row-group skipping, or a ``WHERE`` sent over JDBC). A cursor stored in a
table is read as an uncorrelated scalar subquery, evaluated once per query.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import expect_columns


def _value(v) -> Column:
    """Literal cursor value; text with a time part is read as ``timestamp_ntz``."""
    if isinstance(v, Column):
        return v
    if isinstance(v, str) and ":" in v:
        return F.lit(v).cast("timestamp_ntz")
    if isinstance(v, _dt.datetime):
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.lit(v)


def cursor_value(cursor: DataFrame, col: str, floor=None) -> Column:
    """Scalar-subquery Column: ``COALESCE((SELECT max(col) FROM cursor), floor)``."""
    sub = cursor.select(F.max(col)).scalar()
    return sub if floor is None else F.coalesce(sub, _value(floor))


def since(df: DataFrame, col: str, cursor, inclusive: bool = True, floor=None) -> DataFrame:
    """Rows with ``col`` at/after (``inclusive``) or after the cursor.

    ``cursor``: a value, a Column, or a cursor DataFrame (its max of the single
    value column is used, falling back to ``floor`` when it is empty)."""
    if isinstance(cursor, DataFrame):
        vcol = [c for c in cursor.columns if c != "id"][0]
        c = cursor_value(cursor, vcol, floor)
    else:
        c = _value(cursor)
        if floor is not None:
            c = F.coalesce(c, _value(floor))
    return df.where(F.col(col) >= c) if inclusive else df.where(F.col(col) > c)


def extract_incremental(df: DataFrame, id_col: str, cursor, inclusive: bool = False) -> DataFrame:
    """Relational outbox extract: rows with ``id_col`` above the last loaded id.

    A missing cursor (first run) means "everything": ``coalesce(cursor, 0)``."""
    return since(df, id_col, cursor, inclusive=inclusive, floor=0)


def extract_full(df: DataFrame, schema: StructType | str | None = None, mapping: dict | None = None) -> DataFrame:
    """Full snapshot extract with explicit column mapping and a schema check: a missing
    or unexpected column and a changed type are errors."""
    if mapping:
        df = df.select(*[F.col(src).alias(dst) for dst, src in mapping.items()])
    if schema is not None:
        st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        diff = expect_columns(df, st)       # of the source itself, before any cast
        if diff:
            raise ValueError(f"source columns differ: {diff}")
        df = df.select(*st.fieldNames())
    return df


def read_relational(spark: SparkSession, url: str, table: str, id_col: str | None = None, cursor=None,
                    num_partitions: int = 1, lower: int | None = None, upper: int | None = None,
                    properties: dict | None = None) -> DataFrame:
    """JDBC source: the cursor predicate is pushed into the remote ``WHERE``;
    with bounds the read is split into ``num_partitions`` id ranges."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if id_col and lower is not None and upper is not None and num_partitions > 1:
        r = (r.option("partitionColumn", id_col).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    df = r.load()
    if id_col and cursor is not None:
        df = extract_incremental(df, id_col, cursor)
    return df


def run_window(df: DataFrame, run_date: str, prev_run: str, days: int = 7,
               start: str = "window_from", end: str = "window_to") -> DataFrame:
    """Extract window per run: from the previous run's date, or ``days`` before
    the run date when that is missing; up to the run date."""
    rd = F.col(run_date).cast("timestamp_ntz")
    fallback = rd - F.expr(f"INTERVAL '{int(days)}' DAY")
    return df.withColumns({start: F.coalesce(F.col(prev_run).cast("timestamp_ntz"), fallback), end: rd})
