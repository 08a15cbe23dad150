"""Materialising marts: write once to the shared checkpoint folder, read back.

A mart used by many later steps (member 360, audience, assignments,
outcomes) is written as Parquet under ``spark.checkpoint.dir`` -- the folder
the cluster shares -- and read back. This cuts the lineage (a lost executor
re-reads files instead of recomputing the pipeline), restores Parquet
pushdown/pruning, and gives the optimizer real size statistics. The folder
is taken from the session; a scratch folder is set only when none is
configured (tests, local runs).

Member-keyed marts are written *bucketed* by ``member_id`` (an external
table over the same folder, registered under a run-unique name): every mart
hashes members into the same buckets, so joins between them need no
shuffle, and a join with an unbucketed input shuffles only that input. Rows
are hash-partitioned by the bucket key before the write, so each bucket is
one file. The first of them sets the number of buckets by its rows (it is written
once more for that): ``ROWS_A_BUCKET`` each, at least one a core, at most the
session's shuffle partitions, so that a join with a shuffled input needs no second
exchange of the mart, and never more than ``MAX_BUCKETS``, which Spark's own limit
exceeds. A store may be told the number instead.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


ROWS_A_BUCKET = 250_000
MAX_BUCKETS = 50_000


def bucket_count(rows: int, cores: int, shuffle_partitions: int) -> int:
    return max(1, min(MAX_BUCKETS, shuffle_partitions, max(cores, -(-rows // ROWS_A_BUCKET))))


class MartStore:
    def __init__(self, spark: SparkSession, run_id: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.run_id = run_id or uuid.uuid4().hex[:12]
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lapsewise-marts/{self.run_id}"
        # one count per run: co-location needs the same for every member-keyed mart
        self.buckets = buckets

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table_name(self, name: str) -> str:
        return re.sub(r"[^a-z0-9_]", "_", f"lapsewise_{self.run_id}_{name}".lower())

    def write(self, df: DataFrame, name: str, bucket_by: str | None = None) -> DataFrame:
        if bucket_by is None:
            df.write.mode("overwrite").parquet(self.path(name))
            return self.spark.read.parquet(self.path(name))
        if self.buckets is None:
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(self.path(f"{name}_rows"))
            df = self.spark.read.parquet(self.path(f"{name}_rows"))
            partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self.buckets = bucket_count(seen.get["rows"], self.spark.sparkContext.defaultParallelism, partitions)
        table = self.table_name(name)
        (df.repartition(self.buckets, bucket_by).write.mode("overwrite")
         .bucketBy(self.buckets, bucket_by).sortBy(bucket_by)
         .option("path", self.path(name)).saveAsTable(table))
        return self.spark.table(table)
