"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its byte n-grams (ASCII lower case), hashed to ``2 ** BITS`` features.
Feature f has the log-count ratio ``r[f] = ln((p1 + a) / (p0 + a))`` of its
document shares in the two classes, counted over all labelled rows; logistic regression is fitted on
``x * r``. The model is one vector of ``2 ** BITS`` weights, so what is broadcast has a fixed size.

The regression is fitted on at most ``MAX_FIT_ROWS`` labelled rows (the smallest seeded digests of
their ids), whole texts each, by one task, so the driver holds vectors of ``2 ** BITS`` only; every
document is scored whole.

Defined cases: null and empty texts score the model's bias; rows without or with a null label are not
learnt from; several labels of one id count as toxic if any is; all documents that share a labelled id are
counted, the one with the smallest text digest is fitted on; without
both classes in the sample every score is the share of toxic rows (0 if none); a null
id is never held out nor learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import materialise

from . import common

BITS = 18
SIZES = (3, 4, 5)
MAX_FIT_ROWS = 6000
SMOOTH = 1.0
MIN_ROWS = 3         # labelled rows that hold a feature
STEPS = 150
BROADCAST_LABELS = 1_000_000         # ids and classes, 16 bytes each
FILTER_BITS = 27                     # bit map of the labelled ids: 16 MB
CHUNK = 1 << 20      # entries of the fitting rows that a step handles at once


def features(text: str | None) -> np.ndarray:
    """Sorted hashed n-grams of the whole text."""
    b = np.frombuffer(f" {text or ''} ".encode().lower(), np.uint8).astype(np.uint64)
    seen = np.zeros(1 << BITS, bool)
    for n in SIZES:
        if len(b) >= n:
            h = np.full(len(b) - n + 1, n, np.uint64)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + b[k:len(b) - n + 1 + k]
            seen[(h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)] = True
    return np.flatnonzero(seen).astype(np.int32)


def fit(at: np.ndarray, lengths: np.ndarray, toxic: np.ndarray, counts: np.ndarray, totals: np.ndarray,
        ) -> tuple[np.ndarray, float]:
    """(weights, bias) of the classifier; weights include the ratios.

    ``at`` holds the features of all rows one after the other, ``lengths`` of them per row; ``counts`` are the
    labelled rows of each class (not toxic, toxic) that hold a feature, ``totals`` all of a class.
    """
    size = 1 << BITS
    y = np.asarray(toxic, float)
    if not len(y) or y.min() == y.max():
        share = y.mean() if len(y) else 0.0
        return np.zeros(size, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    shares = (counts + SMOOTH) / (totals[:, None] + 2 * SMOOTH)
    r = np.log(shares[1] / shares[0])
    r[counts.sum(axis=0) < MIN_ROWS] = 0
    owner = np.repeat(np.arange(len(y), dtype=np.int32), lengths)
    w, bias = np.zeros(size), 0.0
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    chunks = [slice(a, a + CHUNK) for a in range(0, len(at), CHUNK)]
    m = v = np.zeros(size + 1)
    for step in range(1, STEPS + 1):       # Adam on the weighted logistic loss with a small ridge
        scaled = w * r
        z = sum((np.bincount(owner[c], scaled[at[c]], len(y)) for c in chunks), np.zeros(len(y))) + bias
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / len(y)
        grad = 1e-4 * w + r * sum((np.bincount(at[c], g[owner[c]], size) for c in chunks), np.zeros(size))
        grad = np.append(grad, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        move = 0.03 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return (w * r).astype(np.float32), float(bias)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(f, c0, c1): the rows of each class that hold a feature; feature -1 stands for all rows."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    totals = np.zeros(2, np.int64)
    for b in batches:
        for t, c in zip(b["text"], b["_toxic"], strict=True):
            counts[int(c > 0), features(t)] += 1
            totals[int(c > 0)] += 1
    if totals.any():
        at = np.flatnonzero(counts.any(axis=0))
        yield pd.DataFrame({"f": np.append(at, -1), "c0": np.append(counts[0, at], totals[0]), "c1": np.append(counts[1, at], totals[1])})


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts per class and feature, and per class, over all labelled ``rows`` (text, _toxic)."""
    sums = (rows.select("text", "_toxic").mapInPandas(_tally, "f int, c0 long, c1 long")
            .groupBy("f").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).toPandas())
    counts = np.zeros((2, (1 << BITS) + 1))
    counts[:, sums["f"].to_numpy(np.int64)] = sums[["c0", "c1"]].to_numpy().T      # -1 is the last
    return counts[:, :-1], counts[:, -1]


def _bits(ids: DataFrame) -> np.ndarray:
    """A bit map of the hashed ids: ``2 ** FILTER_BITS`` bits whatever their number."""
    at = F.pmod(F.xxhash64("_lid"), F.lit(1 << FILTER_BITS)) + 1       # Spark's bit maps count from one
    parts = ids.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("m"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in parts.toLocalIterator():           # 4 KB a row, a fixed number of rows at most
        m, first = np.frombuffer(bytes(r["m"]), np.uint8), (r["b"] - 1) * 4096
        out[first:first + len(m)] = m
    return out


def labelled(docs: DataFrame, known: DataFrame, most: int = None) -> DataFrame:
    """``docs`` (doc_id, text) with the columns of ``known`` (_lid, ...) of their id; others go.

    Texts are not shuffled to find the labelled ones: up to ``most`` (``BROADCAST_LABELS``) labels go to the documents as a
    broadcast; beyond it a bit map of fixed size drops nearly all other documents in the scan before the
    two sides meet in a shuffle join. Both give the same rows.
    """
    on = F.col("doc_id") == F.col("_lid")
    if known.limit((most or BROADCAST_LABELS) + 1).count() <= (most or BROADCAST_LABELS):
        return docs.join(F.broadcast(known), on)
    shared = docs.sparkSession.sparkContext.broadcast(_bits(known))

    @F.pandas_udf("boolean")
    def may_be(at: pd.Series) -> pd.Series:
        bits, at = shared.value, at.to_numpy(np.int64)
        return pd.Series((bits[at >> 3] >> (at & 7)) & 1 == 1)

    hit = may_be(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << FILTER_BITS)))
    return docs.where(F.col("doc_id").isNotNull()).where(hit).join(known.hint("merge"), on)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> tuple[np.ndarray, float]:
    """Ratios from all labelled rows that are not held out, fitted on a bounded sample of them."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("_lid")).agg(F.max("toxic").cast("int").alias("_toxic")))
    known = materialise(known, "toxicity-labels")
    some = known.orderBy(F.md5(F.concat(F.lit("fit"), F.col("_lid").cast("string"))), "_lid").limit(max_rows)
    texts = docs.select("doc_id", "text")
    counts, totals = class_counts(labelled(texts, known))
    shared = docs.sparkSession.sparkContext.broadcast((counts, totals))

    def fit_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = sorted(((i, c > 0, features(t)) for b in batches for i, c, t in zip(b["_lid"], b["_toxic"], b["text"], strict=True)),
                       key=lambda x: x[0])
        toxic = np.array([c for _, c, _ in found], bool)
        lengths = np.array([len(f) for _, _, f in found], np.int64)
        at = np.concatenate([np.zeros(0, np.int32), *[f for _, _, f in found]])
        found.clear()
        weights, bias = fit(at, lengths, toxic, *shared.value)
        yield pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})

    # of documents that share an id the one whose text has the smallest digest is fitted on
    rows = (labelled(texts, some, max_rows).groupBy("_lid", "_toxic")
            .agg(F.min_by("text", F.struct(F.md5("text"), "text")).alias("text")).repartition(1))
    model = materialise(rows.mapInPandas(fit_all, "weights binary, bias double"), "toxicity-model").first()
    if model is None:                   # no partition at all
        return fit(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool), counts, totals)
    return np.frombuffer(bytes(model["weights"]), np.float32), model["bias"]


def score(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    weights, bias = train(docs, labels, max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shared.value
        for s in texts:
            z = np.array([float(w[features(t)].sum(dtype=np.float64)) + bias for t in s])
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    keep = common.replace_columns(docs, ["held_out", "score", "predicted"])
    out = docs.select(*keep, held_out(F.col("doc_id")).alias("held_out"),
                      F.pandas_udf(apply, "double")("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
