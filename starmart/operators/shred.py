"""Array shredding of staged documents (E1-E3).

The typed path parses each document once with ``from_json`` and explodes the
array of structs. :func:`shred_text` reproduces the source system's textual
route (trim ``[]``, replace ``}, {`` by ``}@{``, split on ``@``); it gives the
same rows on well-formed input and is kept for parity checks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import json as J
from ..schemas import DOC_EVENT, DOC_RESTAURANT


def explode_menu(restaurants: DataFrame, doc_col: str = "object_value", keep=("object_id",)) -> DataFrame:
    """One row per (restaurant document, menu item): ``product_id``,
    ``product_name``, ``product_price`` (decimal(14,2)). Empty or missing menus
    give no rows."""
    d = restaurants.select(*keep, F.from_json(doc_col, DOC_RESTAURANT)["menu"].alias("_m"))
    return d.select(*keep, F.explode("_m").alias("_i")).select(
        *keep, F.col("_i._id").alias("product_id"), F.col("_i.name").alias("product_name"),
        F.col("_i.price").alias("product_price"))


def explode_payments(events: DataFrame, doc_col: str = "event_value", keep=()) -> DataFrame:
    """One row per product payment of a bonus event (non-payment events vanish). ``doc_col`` is JSON text or was parsed already."""
    parsed = isinstance(events.schema[doc_col].dataType, StructType)
    d = events.select(*keep, (F.col(doc_col) if parsed else F.from_json(doc_col, DOC_EVENT)).alias("_e"))
    return d.select(*keep, F.col("_e.order_id").alias("order_id"),
                    F.explode("_e.product_payments").alias("_p")).select(
        *keep, "order_id",
        F.col("_p.product_id").alias("product_id"),
        F.col("_p.quantity").alias("count"),
        F.col("_p.price").alias("price"),
        F.col("_p.product_cost").alias("total_sum"),
        F.col("_p.bonus_payment").alias("bonus_payment"),
        F.col("_p.bonus_grant").alias("bonus_grant"))


# Fixed values of the textual shredding route (source system's separators).
TEXT_ARRAY_BRACKETS = "[]"
TEXT_ELEMENT_GAP = "}, {"
TEXT_ELEMENT_MARK = "}@{"
TEXT_SPLIT_ON = "@"


def shred_text(df: DataFrame, array_text_col: str, keep=()) -> DataFrame:
    """Textual array shredding as the source SQL does it: one row per element
    text (``elem``). Breaks on values containing the separators, by design."""
    t = J.trim_chars(F.col(array_text_col), TEXT_ARRAY_BRACKETS)
    t = J.replace(t, TEXT_ELEMENT_GAP, TEXT_ELEMENT_MARK)
    return df.select(*keep, F.explode(J.split_text(t, TEXT_SPLIT_ON)).alias("elem"))
