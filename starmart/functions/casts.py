"""Casts with the source database's assignment rules.

* text -> timestamp / date / 'HH:mm:ss' time / integers / decimals;
* numeric -> smallint/int *rounds* half away from zero (Spark's cast truncates);
* decimal -> decimal of smaller scale rounds HALF_UP (Spark's cast already does).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DecimalType, IntegerType, LongType, ShortType, StructType)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ts(text) -> Column:
    """text -> ``timestamp_ntz`` (``'2023-11-01 10:00:00'``, ISO ``T``, fractions)."""
    return _c(text).cast("timestamp_ntz")


def to_date(text) -> Column:
    return _c(text).cast("timestamp_ntz").cast("date")


def to_time(ts) -> Column:
    """``::TIME`` rendered as ``HH:mm:ss`` text (Spark's TIME type is opt-in)."""
    return F.date_format(_c(ts).cast("timestamp_ntz"), "HH:mm:ss")


def to_int(x, type_: str = "int", safe: bool = False) -> Column:
    """text/number -> integer type, rounding fractions half away from zero."""
    c = _c(x)
    num = F.round(c.cast("decimal(38,6)"), 0)
    return (num.try_cast(type_) if safe else num.cast(type_))


def to_decimal(x, precision: int, scale: int, safe: bool = False) -> Column:
    """text/number -> decimal(p,s), HALF_UP."""
    t = f"decimal({precision},{scale})"
    return _c(x).try_cast(t) if safe else _c(x).cast(t)


_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def assign(col, target: DataType, source: DataType | None = None) -> Column:
    """Assignment cast of ``col`` into a column of type ``target`` (D21).
    Fractions are rounded (half away from zero) before an integer cast."""
    c = _c(col)
    if isinstance(target, _INTEGRAL):
        if isinstance(source, _INTEGRAL):
            return c.cast(target)
        return F.round(c, 0).cast(target)
    if isinstance(target, DecimalType):
        return c.cast(target)
    return c.cast(target)


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Project ``df`` onto ``schema``: same column order, assignment casts,
    missing columns as typed NULLs (defaults are applied separately)."""
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    cols = []
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in st.fields:
        if f.name in have:
            cols.append(assign(F.col(f.name), f.dataType, have[f.name]).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
