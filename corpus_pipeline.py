"""Corpus pipeline over ``documents``: toxicity filter, exact deduplication,
SimHash near-deduplication, removal of repeated substrings, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's ``docs``; all but the last return the
columns of ``documents``. The toxicity model learns from ``labels`` (rows that
are not held out) and the documents before the filter.

* toxicity: documents called toxic go, all others stay.
* exact_dedup: of equal texts (white-space runs being one space) one row stays,
  that of the smallest doc_id.
* simhash_near_dedup: of each component of fingerprints (3-word shingles, at most
  3 differing bits) the row of the smallest doc_id stays.
* suffix_dedup: 200-byte strings that also start elsewhere are cut from the texts;
  no row goes, ``n_chars`` follows the text.
* packing: the texts' ids in sequences of at most 1024 (one row per piece).

Null and empty texts are one group of equal texts; nulls elsewhere are carried.
An empty table passes through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapsewise.llm import exact_dedup, packing, simhash, suffix_dedup, toxicity
from lapsewise.llm.common import Scratch, documents
from lapsewise.llm.queries import tokenizer


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs, shingle_words=3, max_distance=3)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, span=200)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("suffix_dedup", suffix_stage),
    ("packing", packing_stage),
]

# Learned weights, fingerprints and tokens are beyond SQL; the tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
