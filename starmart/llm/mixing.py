"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every document draws an exponential key ``-ln(u) / weight``, with ``u`` hashed from
the seed, its id and its text, so that reruns agree. Within a source, documents
in key order are a weighted sample without replacement. A source with target
``t`` and size ``s`` is taken whole ``floor(t / s)`` times (complete epochs); the rest of
``t`` is a fractional selection: documents in key order whose prefix sum of
sizes comes nearest to it.

Since the selection is a run of the key order, it is described by one cut per
source. The plan is made on narrow rows (id, source, size, digest), to which quality weights
are joined as well; texts are shuffled once, only when ``mix`` repeats the documents.

Defined cases: null text has size 0; a null source is a source of its own, last in
order; documents without a quality weigh 1, a non-positive quality weighs ``MIN_WEIGHT``; rows
equal in source, id and text are one unit of the order and are taken together; an empty table gives
an empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import materialise

from . import common

OUT = ["size", "source_size", "target", "epochs", "copies", "taken"]
MIN_WEIGHT = 1e-3
ROWS_PER_BUCKET = 2048


def _narrow(docs: DataFrame, seed: int, *extra: Column) -> DataFrame:
    return docs.select(*extra, F.col("doc_id").alias("_id"), F.col("source").alias("_src"),
                       common.row_digest(seed, "doc_id", "text").alias("_h"), common.word_count(F.col("text")).alias("_size"))


def _keyed(rows: DataFrame, quality: DataFrame | None) -> DataFrame:
    """Narrow rows with their exponential key."""
    w = F.lit(1.0)
    if quality is not None:
        rows = rows.join(quality, rows["_id"] == quality["_lid"], "left")
        w = F.greatest(F.coalesce("_q", F.lit(1.0)), F.lit(MIN_WEIGHT))
    return rows.select("_id", "_src", "_size", "_h", (-F.log(common.unit_interval(F.col("_h"))) / w).alias("_key"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), share: float = 1.0,
                   max_epochs: int = 3) -> DataFrame:
    """``sizes`` (_src, n, source_size), one row per source, with ``target``.

    Sources in code point order, null last, take the weights in turn and share
    ``share`` of all sizes. A target stops at ``max_epochs`` times its source; resharing
    the excess by weight until none is above equals ``min(cap, level * weight)`` with
    one level for all: sources are capped in order of cap / weight for as long as the
    level of those left is above that ratio.
    """
    every = Window.partitionBy(F.lit(0))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(every.orderBy(F.col("_src").asc_nulls_last())) - 1, len(weights)) + 1)
                     .cast("int"))
    s = sizes.withColumn("_w", w).withColumn("_cap", F.col("source_size") * float(max_epochs))
    by_ratio = every.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("_src").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / F.sum("_w").over(left))
    s = s.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_cap"))
    # the first source that is not capped sets the level; none: every source is at its cap
    first = F.min(F.when(F.col("_open"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(every)
    return (s.withColumn("_first", first)
            .withColumn("target", F.when(F.col("_first").isNull(), F.col("_cap")).otherwise(
                F.least(F.col("_cap"), F.col("_first")["_level"] * F.col("_w"))))
            .drop("_w", "_cap", "_level", "_open", "_first"))


def plan(docs: DataFrame, quality: DataFrame | None = None, weights: Sequence[float] = (1, 2, 3), share: float = 1.0,
         max_epochs: int = 3, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(keys per document, one row per source with target, epochs and cut), both written tables.

    ``quality`` has one weight per id, as ``quality_weights`` gives it.
    """
    keys = materialise(_keyed(_narrow(docs, seed), quality), "mix-keys")
    sizes = keys.groupBy("_src").agg(F.count("*").alias("n"), F.sum("_size").alias("source_size"))
    targets = (source_targets(sizes, weights, share, max_epochs)
               .withColumn("epochs", F.when(F.col("source_size") > 0, F.least(
                   F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(0).cast("int"))
               .withColumn("_rest", F.when(F.col("epochs") < max_epochs,
                                           F.col("target") - F.col("epochs") * F.col("source_size")).otherwise(0.0)))
    targets = materialise(targets, "mix-targets")
    t = targets.select(F.col("_src").alias("_tsrc"), "_rest", F.ceil(F.col("n") / ROWS_PER_BUCKET).alias("_nb"))
    units = (keys.groupBy("_src", "_key", "_id", "_h").agg(F.sum("_size").alias("_unit")))
    units = (units.join(t, units["_src"].eqNullSafe(t["_tsrc"])).drop("_tsrc")
             .withColumn("_b", F.floor((1 - F.exp(-F.col("_key"))) * F.col("_nb"))))
    units = materialise(units, "mix-units")
    run = common.with_prefix(units, ["_src"], "_b", [F.col("_key"), F.col("_id"), F.col("_h")], F.col("_unit"), "_before")
    cuts = (run.where((F.col("_rest") > 0) & (F.col("_before") + F.col("_unit") / 2 <= F.col("_rest")))
            .groupBy("_src").agg(F.max(F.struct("_key", "_id", "_h")).alias("_cut"))
            .withColumnRenamed("_src", "_csrc"))
    per = (targets.join(cuts, targets["_src"].eqNullSafe(cuts["_csrc"]), "left")
           .select(F.col("_src").alias("_tsrc"), "source_size", "target", "epochs", "_cut"))
    return keys, materialise(per, "mix-plan")


def _decide(rows: DataFrame, per: DataFrame) -> DataFrame:
    chosen = F.coalesce(F.struct("_key", "_id", "_h") <= F.col("_cut"), F.lit(False)).cast("int")
    return (rows.join(per, rows["_src"].eqNullSafe(per["_tsrc"]))
            .withColumn("copies", (F.col("epochs") + chosen).cast("int"))
            .withColumn("taken", F.col("_size") * F.col("copies"))
            .withColumn("size", F.col("_size")))


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """Per document of ``docs``: doc_id, source, size, source_size, target, epochs, copies, taken."""
    keys, per = plan(docs, **options)
    return _decide(keys, per).select(F.col("_id").alias("doc_id"), F.col("_src").alias("source"), *OUT)


def mix(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The mix: every row of ``docs`` as many times as it is taken, with the input's columns."""
    keys, per = plan(docs, seed=seed, **options)
    took = (_decide(keys, per).where(F.col("copies") > 0)
            .select(F.col("_src").alias("_msrc"), F.col("_id").alias("_mid"), F.col("_h").alias("_mh"), "copies").distinct())
    rows = _narrow(docs, seed, F.struct(*[docs[c] for c in docs.columns]).alias("_row")).drop("_size")
    # a shuffle join at every size: what the mix takes grows with the documents
    out = rows.join(took.hint("merge"), rows["_h"].eqNullSafe(took["_mh"]) & rows["_id"].eqNullSafe(took["_mid"])
                    & rows["_src"].eqNullSafe(took["_msrc"]))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")


def quality_weights(labels: DataFrame, good: float = 2.0, bad: float = 0.5) -> DataFrame:
    """(_lid, _q): one weight per labelled id, ``good`` if any of its labels is, else ``bad``."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col("doc_id").alias("_lid"))
            .agg(F.when(F.max("quality") > 0, good).otherwise(bad).alias("_q")))
