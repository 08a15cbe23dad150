"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

HELD_OUT_REMAINDER = 2


class Scratch:
    """A run's own folder below the shared checkpoint folder.

    ``write`` stores a frame as Parquet there and reads it back: the lineage is
    cut, a lost executor re-reads files, and joins see real sizes.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lapsewise-llm/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows that no model may learn from: crc32 of the id as text is 2
    modulo 4. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == HELD_OUT_REMAINDER, F.lit(False))


def bounded_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, the ones with the smallest hash of ``key``: the
    same rows on every run and for every partitioning."""
    return df.orderBy(F.xxhash64(key), key).limit(limit)
