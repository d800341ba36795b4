"""Exact distinct counts that can be merged (G1).

The distinct ids of a group are kept as bit maps of 64 neighbouring ids each. A stored day merges into months, quarters or
any coarser group by OR, without the facts it came from. A map is one number: where the ids of a group are dense it holds 64 of
them, where they are sparse (a restaurant's day) there are never more maps than ids, and aggregates keep it in place in a hash
table. Ids are numbers from 1; NULL ids count nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_maps(df: DataFrame, groups: list[str], id_col: str) -> DataFrame:
    """(groups, id_range, ids): the bit maps of each group. Copies are dropped by the partial aggregates."""
    ident = F.col(id_col).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), ident.bitwiseAND(F.lit(63)).cast("int"))
    return (df.where(F.col(id_col).isNotNull()).groupBy(*groups, F.shiftright(ident, 6).alias("id_range"))
            .agg(F.bit_or(bit).alias("ids")))


def merge_maps(maps: DataFrame, groups: list[str]) -> DataFrame:
    """Maps of coarser (or the same) groups from stored ones."""
    return maps.groupBy(*groups, "id_range").agg(F.bit_or("ids").alias("ids"))


def count_maps(maps: DataFrame, groups: list[str], out: str) -> DataFrame:
    """Distinct ids of each group."""
    merged = merge_maps(maps, groups)
    return merged.groupBy(*groups).agg(F.sum(F.bit_count("ids")).alias(out))
