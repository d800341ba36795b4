"""Date/time helpers: calendar parts, formatting and parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed format of datetimes inside staged documents (strftime '%Y-%m-%d %H:%M:%S').
DOC_DATETIME = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_datetime(ts, pattern: str = DOC_DATETIME) -> Column:
    return F.date_format(_c(ts), pattern)


def parse_datetime(text, pattern: str = DOC_DATETIME) -> Column:
    return F.to_timestamp_ntz(_c(text), F.lit(pattern))


def timestamp_parts(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Add year, month, day (smallint), time ('HH:mm:ss') and date of ``ts``."""
    c = F.col(ts)
    return df.withColumns({
        f"{prefix}year": F.year(c).cast("smallint"),
        f"{prefix}month": F.month(c).cast("smallint"),
        f"{prefix}day": F.dayofmonth(c).cast("smallint"),
        f"{prefix}time": F.date_format(c, "HH:mm:ss"),
        f"{prefix}date": F.to_date(c),
    })
