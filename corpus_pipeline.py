"""The corpus pipeline: five stages over ``documents``, each written and read again.

toxicity (rejected documents go) -> SimHash near-dedup (one of each group stays) ->
benchmark decontamination (documents that hold an item go) -> mixing sources to target weights
(documents repeat as the mix takes them) -> token segments (ids with Elias-Fano boundaries,
read back). A row of the result is one document of the mix in the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import decontaminate, mixing, registry, simhash, token_output, toxicity
from starmart.llm.common import table
from starmart.session import materialise, scratch_path

REJECT = 0.5   # toxicity score from which a document goes


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("score") < REJECT).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return out.where(~F.col("contaminated")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, quality=mixing.quality_weights(table(spark, sf_dir, "labels")))


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "pipeline-tokens")
    manifest = token_output.write_tokens(docs, folder, registry.tokenizer_path(), registry.END_ID)
    return token_output.read_tokens(spark, manifest, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", near_dedup), ("decontamination", drop_leaks),
          ("mixing", mix_sources), ("token_output", write_ids)]

ORACLE_SQL = None   # a fitted model, 64-bit hashes and a tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
