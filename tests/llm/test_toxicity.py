"""Toxicity: features, ratios and scores against plain dictionaries; both ways of finding the labelled documents."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import toxicity

ROWS = [(i, f"text {i % 7} of {'vile' if i % 3 == 0 else 'kind'} words", i % 3 == 0) for i in range(150)]
ROWS += [(7, "a second text of one id", False), (None, None, None), (2000, "", None), (2001, None, True), (8, "x" * 200_000, False)]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in ROWS], "doc_id long, text string, _TOXIC string").drop("_TOXIC")
    labels = spark.createDataFrame([(i, int(x) if x is not None else None) for i, _, x in ROWS] + [(9, 0), (9, 1), (None, 1), (5555, 1)],
                                   "doc_id long, toxic int")
    return docs, labels


def plain_features(text):
    """Hashed byte n-grams, one by one."""
    b = f" {text or ''} ".encode().lower()
    out = set()
    for n in (3, 4, 5):
        for k in range(len(b) - n + 1):
            h = n
            for c in b[k:k + n]:
                h = (h * 0x100000001B3 + c) % 2**64
            out.add((h * 0x9E3779B97F4A7C15) % 2**64 >> (64 - toxicity.BITS))
    return out


def test_features_equal_a_plain_loop():
    for t in ("", None, "a", "Mixed CASE \u00c4 text", "aaaaaa"):
        assert set(toxicity.features(t).tolist()) == plain_features(t)


def _known(labels):
    return (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~toxicity.held_out(F.col("doc_id")))
            .groupBy(F.col("doc_id").alias("_lid")).agg(F.max("toxic").alias("_toxic")))


def test_counts_ratios_and_scores_equal_plain_dictionaries(spark, tables):
    docs, labels = tables
    cls = {}
    for i, x in [(i, x) for i, _, x in ROWS] + [(9, False), (9, True)]:
        if i is not None and x is not None and zlib.crc32(str(i).encode()) % 5:
            cls[i] = max(cls.get(i, 0), int(x))
    counts, totals = {}, [0, 0]
    for i, t, _ in ROWS:
        if i in cls:
            totals[cls[i]] += 1
            for f in plain_features(t):
                counts.setdefault(f, [0, 0])[cls[i]] += 1
    got, all_rows = toxicity.class_counts(toxicity.labelled(docs, _known(labels)))
    assert all_rows.tolist() == totals
    assert {f: got[:, f].tolist() for f in np.flatnonzero(got.any(axis=0)).tolist()} == counts
    weights, bias = toxicity.train(docs, labels)
    for f, (c0, c1) in list(counts.items())[::50]:
        r = math.log((c1 + 1) / (totals[1] + 2)) - math.log((c0 + 1) / (totals[0] + 2))
        assert weights[f] == 0 if c0 + c1 < toxicity.MIN_ROWS else weights[f] * r >= -0.2     # a ratio's sign holds, bar small corrections
    for r in toxicity.score(docs, labels).collect()[::10]:
        z = sum(float(weights[f]) for f in plain_features(r["text"])) + bias
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, z)))), abs=1e-9)


def test_filtered_shuffle_equals_broadcast(spark, tables):
    docs, labels = tables
    known = _known(labels)
    a, b = (sorted(map(str, toxicity.labelled(docs, known, most).collect())) for most in (1000, 3))
    assert a == b and len(a) > 90


def test_shared_ids_and_reruns(spark, tables):
    docs, labels = tables
    one, two = (toxicity.score(d, labels).collect() for d in (docs, docs.repartition(7)))
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_empty_tables(spark, tables):
    docs, labels = tables
    assert toxicity.score(docs.limit(0), labels).collect() == []
    assert {r["predicted"] for r in toxicity.score(docs, labels.limit(0)).collect()} == {0}
