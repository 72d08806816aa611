"""A corpus pipeline of four stages; each reads what its predecessor wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm import bpe, mixing, simjoin, toxicity
from corpusmill.llm.common import table, written


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text isn't predicted to be toxic; the model is fitted on the labelled rows."""
    return toxicity.rejected_away(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the group's smallest id. Documents without an id stay; of rows
    that share an id, the first by text (null last) and then by the hash of the whole row stays."""
    kept = simjoin.components(docs).where("doc_id = component_id").select("doc_id").distinct()
    one = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    repeated = one.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id")
    row = F.struct(*docs.columns)
    again = one.join(repeated, "doc_id", "left_semi").select("doc_id", "text", row.alias("_row"), F.xxhash64(*docs.columns).alias("_h"))
    again = again.withColumn("_r", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("text"), "_h"))).where("_r = 1").select("_row.*")
    return one.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(again).unionByName(docs.where("doc_id is null"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them (up to twice, under the same id), by shard in each shard's seeded order."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix, its number of ids and the digests of ids and decoded text."""
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxic_out), ("ngram_jaccard_join", one_of_each_group), ("mixing", mixed), ("bpe", encoded)]

#: Fitted trees and BPE have no SQL equivalent; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
