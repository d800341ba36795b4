"""Broadcasts are bounded in rows and bytes; both sides of the bound give the same table."""

import pytest
from pyspark.sql import functions as F

from starmart.operators import keys as K
from starmart.operators.upsert import insert_absent, upsert


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_few_but_large_rows_do_not_fit(spark):
    large = spark.range(10).select("id", F.repeat(F.lit("x"), 100_000).alias("doc"), F.array(F.lit("y" * 1000)).alias("a"))
    assert K.fits_broadcast(large, 10) and not K.fits_broadcast(large, 9)
    assert not K.fits_broadcast(large, 10, max_bytes=1_000_000) and K.fits_broadcast(large.select("id"), 10, max_bytes=1_000_000)
    assert K.fits_broadcast(large.limit(0))


@pytest.mark.parametrize("rows", [5, 100])
def test_upsert_plans_on_both_sides_of_the_bound(spark, rows, monkeypatch):
    monkeypatch.setattr("starmart.operators.keys.BROADCAST_MAX_ROWS", 5)
    target = spark.range(200).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    batch = spark.range(150, 150 + rows).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    small = upsert(target, batch, "k", dedupe="none", small_batch=5)
    assert ("BroadcastExchange" in _plan(small)) == (rows <= 5)
    assert sorted(small.collect()) == sorted(upsert(target, batch, "k", dedupe="none").collect())


def test_large_documents_are_merged_without_the_batch_path(spark, monkeypatch):
    monkeypatch.setattr(K.fits_broadcast, "__defaults__", (K.BROADCAST_MAX_ROWS, 1000))
    docs = spark.range(50).select(F.to_json(F.struct(F.col("id"), F.repeat(F.lit("z"), 500).alias("t"))).alias("d"))
    assert not K.fits_broadcast(docs)
    assert insert_absent(docs.limit(20), docs, canonical_json="d", small_batch=1000).count() == 50
