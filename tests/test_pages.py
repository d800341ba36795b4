"""Paged endpoint as a data source: all pages once, an empty page ends, offsets, gaps."""

import os

import pytest
from pyspark.errors import PySparkException

from starmart.sources.pages import LandedPages, window
from starmart.streaming.streams import ingest_once


def land(path, n, items):
    os.makedirs(f"{path}/page={n}", exist_ok=True)
    for f in os.listdir(f"{path}/page={n}"):
        os.rename(f"{path}/page={n}/{f}", f"{path}/page={n}/.old-{f}")
    with open(f"{path}/page={n}/part-0.txt", "w") as f:
        f.write("".join(f"{x}\n" for x in items))


@pytest.fixture()
def path(spark, tmp_path):
    spark.dataSource.register(LandedPages)
    p = str(tmp_path / "pages")
    for n in range(5):
        land(p, n, [f'{{"n":{n},"i":{i}}}' for i in range(3)])
    land(p, 5, [])
    return p


def items(df):
    return sorted((r["page"], r["item"]) for r in df.collect())


def test_batch_reads_all_pages_to_the_empty_one(spark, path):
    land(path, 6, ["beyond the end"])
    df = spark.read.format("landed_pages").option("path", path).option("pages_per_partition", 2).load()
    assert items(df) == [(n, f'{{"n":{n},"i":{i}}}') for n in range(5) for i in range(3)]
    assert df.rdd.getNumPartitions() == 3


def test_stream_goes_on_where_it_stopped(spark, path, tmp_path):
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run():
        ingest_once(spark.readStream.format("landed_pages").option("path", path).load(), out, ckpt)
        return items(spark.read.parquet(out))
    first = run()
    assert len(first) == 15 and run() == first
    land(path, 5, ["x", "y"])        # the page that was empty has rows now
    land(path, 6, [])
    assert run() == first + [(5, "x"), (5, "y")]


def test_a_missing_page_is_an_error(spark, path):
    land(path, 5, ["x"])
    land(path, 7, ["z"])
    with pytest.raises(ValueError, match="page 6"):
        window(path)
    with pytest.raises(PySparkException, match="page 6"):
        spark.read.format("landed_pages").option("path", path).load().count()


def test_no_pages(spark, tmp_path):
    spark.dataSource.register(LandedPages)
    assert spark.read.format("landed_pages").option("path", str(tmp_path / "none")).load().count() == 0
