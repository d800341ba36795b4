"""HTTP API staging (A6, A7), re-aimed at landed response files.

The page loop of the source system is replaced by landed pages read as one
dataset; the extract window is a predicate on the delivery time, half-open
``[from, to)`` so consecutive daily windows never overlap (our decision; the
server's own bound is unspecified). Each element becomes one JSON document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.json import to_document


def read_pages(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Landed API responses: each file is a JSON array (or one object) of items."""
    r = spark.read.option("multiLine", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def stage_api(items: DataFrame, doc_col: str, window=None, ts_col: str | None = None,
              sort: bool = False) -> DataFrame:
    """Items -> one JSON text column ``doc_col``.

    ``window=(from, to)`` keeps items with ``from <= ts_col < to``; ``sort`` orders
    by ``ts_col`` (only when a consumer needs the order)."""
    df = items
    if window is not None:
        lo, hi = window
        ts = F.col(ts_col).cast("timestamp_ntz")
        df = df.where((ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz")))
    if sort:
        df = df.orderBy(ts_col)
    return df.select(to_document(*[F.col(f"`{c}`") for c in items.columns]).alias(doc_col))
