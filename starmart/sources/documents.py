"""Document-store staging (A3, A4, A5, A9).

Exports of a document collection land as JSON (Extended JSON: ``{"$oid": ..}``,
``{"$date": ..}``). :func:`normalise_document` walks the *schema* once on the
driver and emits one projection that unwraps object ids and formats datetimes
at any depth (``transform`` for arrays) -- it runs on executors inside
generated code, never as per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, TimestampNTZType, TimestampType

from ..functions.json import to_document
from ..functions.timefmt import DOC_DATETIME


def _is_oid(t: DataType) -> bool:
    return isinstance(t, StructType) and [f.name for f in t.fields] == ["$oid"]


def _is_date(t: DataType) -> bool:
    return isinstance(t, StructType) and [f.name for f in t.fields] == ["$date"]


def _clean(c: Column, t: DataType) -> Column:
    if _is_oid(t):
        return c["$oid"].cast("string")
    if _is_date(t):
        inner = t.fields[0].dataType
        v = c["$date"]
        ts = v.cast("timestamp_ntz") if not isinstance(inner, (TimestampType, TimestampNTZType)) else v
        return F.date_format(ts, DOC_DATETIME)
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return F.date_format(c, DOC_DATETIME)
    if isinstance(t, StructType):
        return F.when(c.isNotNull(), F.struct(*[_clean(c[f.name], f.dataType).alias(f.name) for f in t.fields]))
    if isinstance(t, ArrayType):
        et = t.elementType
        return F.transform(c, lambda x: _clean(x, et))
    return c


def normalise_document(df: DataFrame) -> DataFrame:
    """Object ids -> text, datetimes -> ``yyyy-MM-dd HH:mm:ss`` text, at any depth."""
    return df.select(*[_clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def read_export(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Landed collection export (JSON lines); pass ``schema`` in production."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def stage_documents(df: DataFrame, id_col: str = "_id", ts_col: str = "update_ts", cursor=None,
                    normalise: bool = True) -> DataFrame:
    """Collection -> ``(object_id, object_value, update_ts)``.

    ``object_value`` is the whole cleaned document as JSON text (NULL fields
    kept, UTF-8 unescaped); ``update_ts`` keeps its fractions. With ``cursor``
    only documents with ``update_ts`` strictly after it are staged (pushed down
    to the scan rather than filtered after reading everything)."""
    raw_ts = df[ts_col]
    ts_type = df.schema[ts_col].dataType
    if _is_date(ts_type):
        raw_ts = raw_ts["$date"]
    raw_id = df[id_col]["$oid"] if _is_oid(df.schema[id_col].dataType) else df[id_col]
    base = df.withColumns({"_object_id": raw_id.cast("string"), "_update_ts": raw_ts.cast("timestamp_ntz")})
    if cursor is not None:
        from .extract import since
        base = since(base, "_update_ts", cursor, inclusive=False)
    fields = {f.name: f.dataType for f in base.schema.fields}
    # cleaning and serialising happen in the same projection (one pass)
    doc = to_document(*[(_clean(F.col(f"`{c}`"), fields[c]) if normalise else F.col(f"`{c}`")).alias(c)
                        for c in df.columns])
    return base.select(F.col("_object_id").alias("object_id"), doc.alias("object_value"),
                       F.col("_update_ts").alias("update_ts"))
