"""What a job holds, writes and reads at size: one copy of a row, the tables it needs, files of all tasks, maps as small as their ids."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from starmart.operators import partitioned as P
from starmart.operators.distinct import count_maps, distinct_maps
from starmart.operators.upsert import dedupe_last
from starmart.plans import catalog, incremental as I, landing, marts
from starmart.sources.pages import LandedPages
from starmart.streaming.streams import stream_source

from .conftest import SF


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _fresh(name):
    return SF + "/" * (2 + len(name))       # the same tables by a path that nothing is kept for


def test_dedupe_holds_each_column_once(spark):
    rows = [("a", None, "x", 1.0), ("a", 2, "y", None), ("a", 2, "y", 0.5), (None, 1, "n", 1.0), (None, 1, "m", 2.0), ("b", None, None, None)]
    df = spark.createDataFrame(rows, "k string, t int, v string, w double")
    out = dedupe_last(df, "k", "t")
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("a", 2, "y", 0.5), (None, 1, "n", 1.0), ("b", None, None, None)], key=str)
    assert out.columns == df.columns and "max_by" not in _plan(out)
    assert dedupe_last(df, ["w"], ["t", "v"]).where("w = 1.0").first()["v"] == "n"


def test_a_query_stages_what_it_reads(spark):
    sf = _fresh("cursor")
    assert catalog.queries()["cursor_max_ts"](spark, sf).count() == 1
    assert set(catalog._STAGING[(spark.sparkContext.applicationId, sf)]) == {"orders"}


def test_a_query_builds_the_tables_it_names(spark):
    sf = _fresh("deliveries")
    assert catalog.queries()["deliveries"](spark, sf).count() > 0
    key = (spark.sparkContext.applicationId, sf)
    assert set(catalog._WAREHOUSES[key]) == {"couriers", "deliveries"}
    built = catalog._WAREHOUSES[key]["deliveries"]
    w = catalog._warehouse(spark, sf, "dm_orders")
    assert set(w) == {"couriers", "deliveries", "dm_users", "dm_restaurants", "dm_timestamps", "dm_orders"} and w["deliveries"] is built


def test_cast_decimals_parses_a_document_once(spark):
    plan = _plan(catalog.queries()["cast_decimals"](spark, SF))
    assert "get_json_object" not in plan


def test_sparse_groups_have_small_maps(spark):
    rows = spark.range(2000).select((F.col("id") % 500).alias("g"), (F.col("id") * 40_000 + 1).alias("id"))
    maps = distinct_maps(rows.unionByName(rows), ["g"], "id")
    assert maps.schema["ids"].dataType == LongType() and maps.count() == 2000
    assert {r["n"] for r in count_maps(maps, ["g"], "n").collect()} == {4}


def test_buckets_grow_with_the_sales(spark):
    w = catalog._warehouse(spark, SF)
    n = w["fct_product_sales"].count()
    out = marts.co_partitioned(w, 2, rows_per_bucket=n // 6 + 1)
    assert len(out["fct_product_sales"].inputFiles()) == 8 and out["fct_product_sales"].count() == n


def test_arrivals_of_many_files_are_one_batch_each(spark, tmp_path):
    df = spark.range(0, 900, 1, 3).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("arrival"))
    path, seen = str(tmp_path / "landed"), []
    for k in landing.land_batches(df, path, "arrival", 3):
        q = (stream_source(spark, path, "id long").writeStream.foreachBatch(lambda b, epoch: seen.append((epoch, b.count())))
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
        if not k:
            assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) > 1
    assert seen == [(0, 600), (1, 300), (2, 0)]


def test_pages_are_landed_by_the_writer(spark, tmp_path):
    spark.dataSource.register(LandedPages)
    path = str(tmp_path / "pages")
    df = spark.range(95).select(F.floor(F.col("id") / 10).cast("int").alias("page"), F.concat(F.lit("{é"), "id", F.lit("}")).alias("item"))
    df.repartition("page").sortWithinPartitions("page").write.format("landed_pages").mode("append").option("path", path).save()
    assert sorted(os.listdir(path)) == sorted(f"page={n}" for n in range(11))
    assert os.path.getsize(f"{path}/page=10/part-empty") == 0
    assert sorted(map(tuple, spark.read.format("landed_pages").option("path", path).load().collect())) == sorted(map(tuple, df.collect()))
    df.limit(0).write.format("landed_pages").mode("append").option("path", path + "-none").save()
    assert os.listdir(path + "-none") == ["page=0"]


@pytest.mark.parametrize("again", [False, True])
def test_a_merge_writes_no_copy_of_its_changes(spark, tmp_path, monkeypatch, again):
    layout = P.Layout(("k",), "pmod(xxhash64(k), 4)", "id bigint, k string, v int")
    batch = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    path, names, write = str(tmp_path / "t"), [], P.materialise
    if again:
        P.merge(spark, path, layout, batch.where("k = 'a'"), id_col="id")
    monkeypatch.setattr(P, "materialise", lambda df, name="table", *more: names.append(name) or write(df, name, *more))
    out = P.merge(spark, path, layout, batch.withColumn("v", F.col("v") + 1), id_col="id", next_id=2 if again else 1)
    assert names == (["merge-batch", "merge-rows"] if again else ["merge-batch"])
    want = {("a", 1, 2), (None, 2, 4), ("b", 3, 3)} if again else {(None, 1, 4), ("a", 2, 2), ("b", 3, 3)}
    assert {(r["k"], r["id"], r["v"]) for r in out.table.collect()} == want
    assert {(r["old"] and r["old"]["v"], r["new"]["v"]) for r in out.changes.collect()} == {(1 if again else None, 2), (None, 4), (None, 3)}


def test_two_loads_share_the_staging_layer(spark):
    last = landing.staging(landing.Tables(spark, SF), materialise=True)
    first, second = landing.two_loads(landing.Tables(spark, SF), last)
    assert first["users"] is last["users"] and second["events"] is last["events"]


def test_event_rejects_of_unknown_products_and_orders(spark):
    pays = [('{"order_id":"o1","product_payments":[{"product_id":"p1"},{"product_id":"px"},{"product_id":null}]}'),
            ('{"order_id":"ox","product_payments":[{"product_id":"p1"}]}'), ('{"order_id":"o1","product_payments":[]}'),
            ('{"order_id":"ox"}'), ('{"order_id":"o1","product_payments":[{"product_id":"p1"}]}'),
            ('{"order_id":null,"product_payments":[{"product_id":null}]}'), ('{"order_id":"o1","product_payments":[null]}')]
    e = spark.createDataFrame([(i, "t", p, 0) for i, p in enumerate(pays)], "id bigint, event_type string, event_value string, tries int")
    e = e.withColumn("event_ts", F.lit(None).cast("timestamp_ntz"))
    out = I._event_rejects(e, spark.createDataFrame([("p1",)], "product_id string"), spark.createDataFrame([("o1",)], "order_key string"))
    assert sorted((r["id"], r["reason"], r["tries"]) for r in out.collect()) == [
        (0, "no product", 1), (1, "no order", 1), (5, "no order", 1), (6, "no product", 1)]
    assert "unknown-products" in str(out.inputFiles())
