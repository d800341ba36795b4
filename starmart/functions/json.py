"""JSON and text functions used to read schema-on-read documents.

Everything returns a :class:`Column` built from Spark's JSON expressions, so a
document is parsed once per row inside whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse(doc, schema: str | StructType, strict: bool = False) -> Column:
    """text -> struct (``::JSON``). Invalid text gives NULL (``strict`` raises)."""
    opts = {"mode": "FAILFAST"} if strict else {}
    return F.from_json(_c(doc), schema, opts)


def json_text(doc, name: str) -> Column:
    """``doc ->> 'name'``: one top-level field as text (JSON null -> NULL)."""
    return F.get_json_object(_c(doc), f"$.{name}")


def json_path(doc, *names: str) -> Column:
    """``doc -> 'a' ->> 'b'``: nested field as text."""
    return F.get_json_object(_c(doc), "$." + ".".join(names))


def to_document(*cols, keep_nulls: bool = True) -> Column:
    """Row -> JSON text (``json.dumps(row, ensure_ascii=False)``); NULL fields kept."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    st = F.struct(*cols) if cols else F.struct("*")
    return F.to_json(st, opts)


def canonical(doc) -> Column:
    """JSONB-style canonical text: keys sorted, insignificant blanks dropped,
    numerically equal numbers written alike (``2.0`` == ``2``).

    Invalid JSON gives NULL (``try_parse_json``)."""
    return F.to_json(F.try_parse_json(_c(doc)))


def trim_chars(text, chars: str) -> Column:
    """``TRIM(text, chars)``: strip any of ``chars`` from both ends."""
    return F.btrim(_c(text), F.lit(chars))


def replace(text, old: str, new: str) -> Column:
    """``REPLACE(text, old, new)`` (literal, not a pattern)."""
    return F.replace(_c(text), F.lit(old), F.lit(new))


def split_text(text, delimiter: str) -> Column:
    """``STRING_TO_ARRAY(text, delimiter)``: literal delimiter; '' gives an empty
    array and NULL gives NULL, like the source database."""
    t = _c(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, re.escape(delimiter), -1))
