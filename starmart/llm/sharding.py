"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows of a source are ranked in a seeded shuffle; rank r of n gets the fraction
(r + 1/2) / n. In the order of these fractions every stretch holds each source in
proportion, so cutting it into equal runs gives shards that all match the mixture.
The law is ``rows``: row counts of any two shards differ by one at most.

No task sees a whole source or the whole order: ranks are counted within buckets of
the hash and positions within buckets of the fraction, and added to offsets from one summary row per
bucket. Hashes of distinct rows fall into the buckets evenly; rows that share a hash (copies) are numbered first, by
ranges of the written table, and hashed again with their number, so a group of copies is spread too.

Defined cases: null text has no bytes and a null crc32 input is the empty text; a null
source is a stratum of its own; repeated rows take places of their own; equal texts
are not held together, as the law ``rows`` cannot do so for large groups; an empty
table gives an empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import materialise

from . import common

OUT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
ROWS_PER_BUCKET = 2048
ROW_OVERHEAD = 8


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and what the shard table tells of a text, without the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", "source", (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))


def _apart(base: DataFrame, seed: int) -> DataFrame:
    """``base`` (_row, _src, _h) with rows of one hash told apart: all but the first of them are hashed with their number."""
    same = base.groupBy(F.col("_h").alias("_same")).agg(F.count("*").alias("_c")).where("_c > 1").drop("_c")
    one, more = (base.join(same, base["_h"] == same["_same"], how) for how in ("left_anti", "left_semi"))
    more = common.numbered(more, ["_h"], ["_row", "_src"], "shard-copies").drop("n")
    more = more.withColumn("_h", F.when(F.col("idx") > 0, common.row_digest(seed, "_h", "idx")).otherwise(F.col("_h"))).drop("idx")
    return materialise(one.unionByName(more), "shard-apart")


def interleave(rows: DataFrame, shards: int, seed: int = 17, stratum: str = "source",
               identity: list[str] | None = None) -> DataFrame:
    """All columns of ``rows`` with ``law``, ``shard``, ``slot`` and ``grown_shard``.

    ``identity`` names the columns that seed the shuffle and break ties (all but the
    stratum by default).
    """
    keep = common.replace_columns(rows, OUT[2:])
    identity = identity or [c for c in keep if c != stratum]
    base = _apart(materialise(rows.select(
        F.struct(*[rows[c] for c in keep]).alias("_row"), F.col(stratum).alias("_src"),
        common.row_digest(seed, *identity).alias("_h")), "shard-rows"), seed)
    ties = [F.col(f"_row.`{c}`") for c in identity]
    counts = materialise(base.groupBy(F.col("_src").alias("_csrc")).agg(F.count("*").alias("_n")), "shard-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    per = counts.withColumn("_nb", F.ceil(F.col("_n") / ROWS_PER_BUCKET))
    base = (base.join(per, base["_src"].eqNullSafe(per["_csrc"])).drop("_csrc")
            .withColumn("_b", F.floor(common.unit_interval(F.col("_h")) * F.col("_nb"))))
    order = [F.col("_h"), *ties]
    ranked = common.with_prefix(base, ["_src"], "_b", order, F.lit(1), "_rank")
    ranked = (ranked.withColumn("_frac", (F.col("_rank") + 0.5) / F.col("_n"))
              .withColumn("_fb", F.floor(F.col("_frac") * (total // ROWS_PER_BUCKET + 1))))
    ranked = materialise(ranked.select("_row", "_src", "_h", "_frac", "_fb"), "shard-ranked")
    placed = common.with_prefix(ranked, [], "_fb", [F.col("_frac"), F.col("_src"), F.col("_h"), *ties], F.lit(1), "_pos")
    shard = F.expr(f"(_pos * {shards}L) div {max(total, 1)}L")
    start = F.expr(f"(_shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return (placed.withColumn("_shard", shard)
            .select("_row.*", F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"),
                    (F.col("_pos") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = 17) -> None:
    """Writes whole documents as ``shard=N`` folders, rows in slot order.

    A shard is dealt over range slices of its slots, so a large shard is written by
    many tasks.
    """
    placed = interleave(docs.withColumn("_t", F.md5("text")), shards, seed, identity=["doc_id", "_t"])
    (placed.drop("_t").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").mode("errorifexists").parquet(path))
