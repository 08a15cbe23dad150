"""Tables of versioned parts: merge on read, atomic commits.

A batch adds one *part*, partitioned by a column of the table. What readers see is
named by the newest *commit*, a small JSON file that lists the parts in force, the
log of the batch and the last batch of every writer. A commit appears by a rename that
fails if its version exists, so a batch is visible whole or not at all: a job
that dies earlier leaves files that no commit names, and a batch that comes
again finds itself in ``applied`` and changes nothing.

How rows of several parts make one is the table's own matter (``merge``). When
``fan_in`` neighbouring parts of one level have come together they are merged into
one of the next level, so a row is rewritten once a level: bytes written follow the
batches, not the table.

``MembershipStore`` is the activation destination: parts hold the rows a batch
created or updated, in full, by campaign and clustered by a hash bucket of the key;
the newest part's row counts.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DESTINATION

BUCKETS = 256
FAN_IN = 4
ROW_FIELDS = [f for f in DESTINATION.fields if f.name != "campaign_id"]
STORED = T.StructType([
    *ROW_FIELDS, T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType()),
    T.StructField("campaign_id", T.StringType()),
])
LOG_SCHEMA = ("run_id string, seq bigint, idempotency_key string, member_id string, action string, reason string, "
              "stream string, batch_id bigint")


class CommitConflict(RuntimeError):
    """Another writer published this version first."""


@dataclass(frozen=True)
class Part:
    path: str
    level: int
    rows: int


@dataclass(frozen=True)
class Commit:
    version: int = 0
    parts: tuple[Part, ...] = ()
    log: str | None = None
    applied: dict[str, int] = field(default_factory=dict)


def key_bucket() -> Column:
    return F.pmod(F.xxhash64("idempotency_key"), F.lit(BUCKETS)).cast("int")


class VersionedStore:
    """Rows of ``schema`` below ``root``, in parts by ``partition`` (its last column)."""

    schema: T.StructType
    partition: str
    cluster: tuple[str, ...] = ()  # order within a part's files, for their statistics

    def __init__(self, spark: SparkSession, root: str, fan_in: int = FAN_IN):
        self.spark, self.root, self.fan_in = spark, root.rstrip("/"), fan_in
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def merge(self, rows: DataFrame) -> DataFrame:
        """The table's rows from those of several parts."""
        raise NotImplementedError

    # commits ------------------------------------------------------------------
    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _commit_at(self, name: str) -> Commit:
        stream = self._fs.open(self._path(f"{self.root}/commits/{name}"))
        try:
            found = json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()
        return Commit(found["version"], tuple(Part(**p) for p in found["parts"]), found["log"], found["applied"])

    def commits(self) -> list[Commit]:
        return [self._commit_at(n) for n in self._names("commits") if n.endswith(".json")]

    def latest(self) -> Commit:
        names = [n for n in self._names("commits") if n.endswith(".json")]
        return self._commit_at(names[-1]) if names else Commit()

    def _publish(self, commit: Commit) -> Commit:
        """Make ``commit`` the newest one, unless its version exists."""
        jvm = self.spark.sparkContext._jvm
        target = self._path(f"{self.root}/commits/{commit.version:010d}.json")
        draft = self._path(f"{self.root}/drafts/{commit.version:010d}-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(asdict(commit)).encode()))
        out.close()
        self._fs.mkdirs(target.getParent())
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(draft, target, options)
        except Exception as error:
            if "FileAlreadyExistsException" in str(error):
                raise CommitConflict(f"version {commit.version} of {self.root}") from error
            raise
        return commit

    # writing ------------------------------------------------------------------
    def _write_part(self, rows: DataFrame, version: int, level: int) -> Part:
        """One folder a value of the partition column; a hot one is split over files."""
        path = f"{self.root}/parts/part={version:010d}-{uuid.uuid4().hex}"
        seen = Observation()
        placed = rows.select(*self.schema.fieldNames()).hint("rebalance", self.partition)
        placed = placed.sortWithinPartitions(self.partition, *self.cluster).observe(seen, F.count(F.lit(1)).alias("rows"))
        placed.write.partitionBy(self.partition).parquet(path)
        return Part(path, level, seen.get["rows"])

    def commit(self, rows: DataFrame, writer: str, batch_id: int, log: DataFrame | None = None) -> Commit:
        """Add a batch's rows (without ``version``). They and the batch's log become
        visible together. A batch that is in is not added again."""
        last = self.latest()
        if last.applied.get(writer, -1) >= batch_id:
            return last
        version, log_path = last.version + 1, None
        if log is not None:
            log_path = f"{self.root}/logs/{version:010d}-{uuid.uuid4().hex}"
            log.withColumns({"stream": F.lit(writer), "batch_id": F.lit(batch_id).cast("bigint")}).write.parquet(log_path)
        part = self._write_part(rows.withColumn("version", F.lit(version).cast("bigint")), version, 0)
        parts = (*last.parts, part) if part.rows else last.parts
        return self._publish(Commit(version, parts, log_path, {**last.applied, writer: batch_id}))

    def compact(self) -> Commit:
        """Merge neighbouring parts of one level while there are ``fan_in`` at the end."""
        last = self.latest()
        while True:
            level = last.parts[-1].level if last.parts else 0
            tail = [p for p in last.parts[-self.fan_in:] if p.level == level]
            if len(tail) < self.fan_in:
                return last
            version = last.version + 1
            merged = self._write_part(self.merge(self._read(tail)), version, level + 1)
            last = self._publish(replace(last, version=version, log=None, parts=(*last.parts[:-self.fan_in], merged)))

    def vacuum(self, keep: int = 10) -> list[str]:
        """Remove the parts that none of the ``keep`` newest commits names and that no
        running batch can be about to name."""
        recent = [self._commit_at(n) for n in self._names("commits")[-keep:] if n.endswith(".json")]
        if not recent:
            return []
        named = {p.path.rsplit("/", 1)[1] for c in recent for p in c.parts}
        old = [n for n in self._names("parts") if n not in named and int(n.split("=")[1].split("-")[0]) <= recent[-1].version]
        for name in old:
            self._fs.delete(self._path(f"{self.root}/parts/{name}"), True)
        return old

    # reading ------------------------------------------------------------------
    def _read(self, parts: list[Part]) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", f"{self.root}/parts").parquet(*[p.path for p in parts])

    def read(self, where: Column | None = None, at: Commit | None = None) -> DataFrame:
        """The table at a commit (the newest one), or its rows with ``where``, which may
        read key columns only: the scan of every part applies it."""
        parts = list((at or self.latest()).parts)
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = self._read(parts)
        if where is not None:
            rows = rows.filter(where)
        return self.merge(rows) if len(parts) > 1 else rows  # a part is merged in itself


class MembershipStore(VersionedStore):
    """One destination row per membership."""

    schema, partition, cluster = STORED, "campaign_id", ("bucket",)

    def merge(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in STORED.fieldNames() if c != "idempotency_key"]
        newest = rows.groupBy("idempotency_key").agg(F.max_by(F.struct(*rest), "version").alias("row"))
        return newest.select("idempotency_key", "row.*")

    def snapshot(self, campaigns: list[str] | None = None, buckets: list[int] | None = None, at: Commit | None = None) -> DataFrame:
        """The destination at a commit, or the given campaigns' and buckets' share of
        it: other campaigns' folders are not read."""
        where = F.lit(True)
        if campaigns is not None:
            where = where & F.col("campaign_id").isin(campaigns)
        if buckets is not None:
            where = where & F.col("bucket").isin(buckets)
        return self.read(where, at).select(*DESTINATION.fieldNames())

    def log(self, writer: str | None = None, batch_id: int | None = None) -> DataFrame:
        """The committed logs, or one batch's."""
        paths = [c.log for c in self.commits() if c.log is not None]
        rows = self.spark.read.schema(LOG_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], LOG_SCHEMA)
        if writer is not None:
            rows = rows.filter((F.col("stream") == writer) & (F.col("batch_id") == batch_id))
        return rows


def sync_into(store: MembershipStore, classified: DataFrame, current: DataFrame, spec, writer: str, batch_id: int, run_id: str) -> Commit:
    """Commit a classified batch (T-8, T-9): its log and the rows it changed of
    ``current``, the destination's share of it."""
    from ..operators.activation import snapshot_changes

    log = classified.select(F.lit(run_id).alias("run_id"), F.col("seq").cast("bigint").alias("seq"),
                            "idempotency_key", "member_id", "action", "reason")
    changes = snapshot_changes(classified, current, spec.campaign_at).withColumn("bucket", key_bucket())
    return store.commit(changes, writer, batch_id, log)


def touched(rows: DataFrame) -> tuple[list[str], list[int]]:
    """Campaigns and buckets of the keyed rows of a batch: its share of the destination.
    The campaigns' names and at most ``BUCKETS`` numbers reach the driver."""
    keyed = rows.filter("idempotency_key IS NOT NULL AND campaign_id IS NOT NULL")
    found = keyed.agg(F.collect_set("campaign_id").alias("campaigns"), F.collect_set(key_bucket()).alias("buckets")).first()
    return sorted(found.campaigns), sorted(found.buckets)
