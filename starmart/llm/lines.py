"""Line dedup over overlapping three-line windows (DataFrame functions only).

A window is three consecutive lines of a document. Of all occurrences of a window in
the corpus the first one, by document id and then line number, stays; the
lines that any later occurrence covers are removed, overlapping occurrences merged.

Windows are compared by a 128-bit hash. First occurrences come from a partial
aggregate (one row per window and task is shuffled), so a window that a third of
all documents share costs no more than any other; the join back splits hot
windows (skew join). Text is shuffled once, to meet its document's covered lines; rows equal in
every column are counted map-side and written out again from their count.

Defined cases: null text has no lines and stays null; an empty text is one empty line;
documents of fewer than three lines have no window and stay whole; if all lines go
the text is empty; of rows equal in id and text one (the smallest digest of its other columns)
is the first copy, all windows of the others are later occurrences; a null id sorts first; input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

OUT = ["text", "n_lines", "n_removed"]


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """(_w hash, _id, _h, _pos) of every window."""
    lines = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"),
                        F.split("text", "\n", -1).alias("_l")).where(F.size("_l") >= width)
    digests = lines.select("_id", "_h", F.transform("_l", F.md5).alias("_d"))
    return digests.select("_id", "_h", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("_d") - (width - 1)),
        lambda i: F.unhex(F.md5(F.array_join(F.slice("_d", i, width), ""))))).alias("_pos", "_w"))


def repeated_lines(docs: DataFrame, width: int = 3) -> DataFrame:
    """Per document with later occurrences: ``_id``, ``_h`` and ``_starts`` (0-based first lines of them)."""
    windows = _windows(docs, width)
    first = (windows.groupBy("_w").agg(F.count("*").alias("_n"), F.min(F.struct("_id", "_h", "_pos")).alias("_first"))
             .where(F.col("_n") > 1).drop("_n"))
    # shuffle joins at every size: repeated windows grow with the documents, hot ones are split (skew join)
    later = windows.join(first.hint("merge"), "_w").where(~F.struct("_id", "_h", "_pos").eqNullSafe(F.col("_first")))
    return later.groupBy("_id", "_h").agg(F.collect_set("_pos").alias("_starts"))


def dedup_lines(docs: DataFrame, width: int = 3) -> DataFrame:
    """``docs`` with the kept lines as ``text``, ``n_lines`` of the input and ``n_removed``."""
    keep = common.replace_columns(docs, OUT)
    hits = repeated_lines(docs, width).withColumnsRenamed({"_id": "_rid", "_h": "_rh"})
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("_row"), F.col("doc_id").alias("_id"),
                       F.xxhash64("text").alias("_h"), F.col("text").alias("_text"))
    same = F.concat_ws("|", F.coalesce(F.col("_id").cast("string"), F.lit("~")), "_h", F.xxhash64(F.lit(1), "_text"))
    rows = rows.withColumns({"_g": same, "_k": F.concat_ws("|", same, F.md5(F.to_json("_row")))})
    # narrow: a row per key with its verdict; _k is _g and the digest of the other columns
    keys = rows.groupBy("_id", "_h", "_g", "_k").agg(F.count("*").alias("_n"))
    copied = (keys.groupBy("_g").agg(F.sum("_n").alias("_n"), F.min("_k").alias("_first"))
              .where(F.col("_n") > 1).select("_g", "_first"))
    verdict = (keys.join(hits.hint("merge"), keys["_id"].eqNullSafe(hits["_rid"]) & (keys["_h"] == hits["_rh"]), "left")
               .join(copied.hint("merge"), "_g", "left").where(F.col("_starts").isNotNull() | F.col("_first").isNotNull())
               .select("_k", "_starts", F.coalesce(F.col("_first") != F.col("_k"), F.lit(False)).alias("_later")))
    rows = rows.groupBy("_k").agg(F.count("*").alias("_n"), F.first("_row").alias("_row"), F.first("_text").alias("_text"))
    rows = rows.join(verdict.hint("merge"), "_k", "left").withColumn("_l", F.split("_text", "\n", -1))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    covered = F.array_distinct(F.flatten(F.transform("_starts", lambda s: F.sequence(s, s + (width - 1)))))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_l") - 1), covered)
    later = (F.col("_later") | (F.col("_copy") > 1)) & (F.size("_l") >= width)
    rows = rows.withColumn("_kept", F.when(later, F.array().cast("array<int>")).when(F.col("_starts").isNotNull(), kept))
    n_lines = F.when(F.col("_text").isNull(), 0).otherwise(F.size("_l")).cast("long")
    return rows.select(
        "_row.*",
        F.when(F.col("_kept").isNull(), F.col("_text")).otherwise(
            F.array_join(F.transform("_kept", lambda i: F.element_at("_l", i + 1)), "\n")).alias("text"),
        n_lines.alias("n_lines"),
        F.when(F.col("_kept").isNull(), F.lit(0)).otherwise(F.size("_l") - F.size("_kept")).cast("long")
        .alias("n_removed"))
