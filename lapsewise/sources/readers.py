"""Raw-table readers and typed staging (S-1..S-10, P-1..P-7).

CSV is read as text, each file by its own header: columns are picked by name, so
files of one source may order them differently and carry extra ones. Files that
share a header are one scan. A record with more or fewer fields than its file's
header, or with broken quotes, cannot be told apart into columns: it becomes a
reject that keeps its text. Empty strings become NULL, then each column is cast to
the entity type. Tolerant timestamp columns parse bad text as NULL; a required
column that is NULL or fails its cast sends the row to a reject DataFrame with the
reason, instead of being silently kept (S-9). Parquet sources and tables are
selected, emptied and cast the same way. Reading a missing path raises Spark's
PATH_NOT_FOUND analysis error (S-10).
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_TABLES, required_columns

RAW_RECORD = "raw_record"  # the text of a record that no column could be cut from
MALFORMED = "record:malformed"
HEADER_BYTES = 1 << 16  # a header is looked for in so many first bytes of a file


@dataclass
class Staged:
    valid: DataFrame  # typed rows with every required column present
    rejects: DataFrame  # raw text rows + reject_reason + the whole record if it is malformed


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Header -> the files that begin with it. The driver reads the first bytes of
    every file; an empty file has no header and no rows."""
    jvm = spark.sparkContext._jvm
    found: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for name in spark.read.text(path).inputFiles():
        hadoop = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(hadoop)
        try:
            start = bytes(stream.readNBytes(HEADER_BYTES))
        finally:
            stream.close()
        header = next(csv.reader(io.StringIO(start.decode("utf-8-sig", "replace"), newline="")), None)
        if header:
            found[tuple(header)].append(name)
    return found


def read_csv_text(spark: SparkSession, path: str, table: str) -> DataFrame:
    """S-8: header CSV as strings, selected by name, '' -> NULL, with the text of
    malformed records in ``raw_record``."""
    wanted = RAW_TABLES[table].fieldNames()
    parts = []
    for header, files in csv_headers(spark, path).items():
        missing = [c for c in wanted if c not in header]
        repeated = [c for c in wanted if header.count(c) > 1]
        if missing or repeated:
            raise ValueError(f"{table}: missing columns {missing}, repeated columns {repeated} in {files[0]}")
        # By place: names of other columns may repeat or differ by case only.
        schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(header))] + [T.StructField(RAW_RECORD, T.StringType())])
        read = (spark.read.schema(schema).option("header", "true").option("encoding", "UTF-8").option("escape", '"')
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_RECORD)
                # fields are counted only if no column is pruned
                .option("columnPruning", "false").csv(files))
        parts.append(read.select(*[F.nullif(F.col(f"c{header.index(c)}"), F.lit("")).alias(c) for c in wanted], RAW_RECORD))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in [*wanted, RAW_RECORD]]))
    return reduce(DataFrame.unionByName, parts)


def _typed(c: str, dt: T.DataType) -> Column:
    return F.col(c).try_cast(dt)


def stage(df: DataFrame, table: str) -> Staged:
    """P-1..P-7: cast to the entity schema; split off rows failing required columns."""
    schema = RAW_TABLES[table]
    required = set(required_columns(schema))
    # '' is a missing value in every source format, whatever the column's type will be
    text = {c for c, kind in df.dtypes if kind == "string"}
    record = F.col(RAW_RECORD) if RAW_RECORD in df.columns else F.lit(None).cast("string").alias(RAW_RECORD)
    raw = df.select(*[(F.nullif(F.col(c), F.lit("")) if c in text else F.col(c)).alias(c) for c in schema.fieldNames()], record)
    typed = raw.select(
        *[F.col(f.name).alias(f"_raw_{f.name}") for f in schema.fields],
        *[_typed(f.name, f.dataType).alias(f.name) for f in schema.fields],
        RAW_RECORD,
    )
    reasons = [
        F.when(F.col(f"_raw_{c}").isNull(), F.lit(f"{c}:missing"))
        .when(F.col(c).isNull(), F.lit(f"{c}:unparseable"))
        for c in schema.fieldNames() if c in required
    ]
    reason = F.concat_ws(",", *reasons) if reasons else F.lit("")
    with_reason = typed.withColumn("reject_reason", F.when(F.col(RAW_RECORD).isNotNull(), MALFORMED).otherwise(reason))
    valid = with_reason.filter(F.col("reject_reason") == "").select(*schema.fieldNames())
    # a malformed record's columns are guesses: only its text is kept
    rejects = with_reason.filter(F.col("reject_reason") != "").select(
        *[F.when(F.col(RAW_RECORD).isNull(), F.col(f"_raw_{c}").cast("string")).alias(c) for c in schema.fieldNames()],
        "reject_reason", RAW_RECORD,
    )
    # optional columns were try_cast too: bad text becomes NULL there, never a reject
    return Staged(valid=valid, rejects=rejects)


def read_raw_csv(spark: SparkSession, path: str, table: str) -> Staged:
    """S-1..S-7: read one raw entity from CSV and stage it."""
    return stage(read_csv_text(spark, path, table), table)


def read_raw_parquet(spark: SparkSession, path: str, table: str) -> Staged:
    schema = RAW_TABLES[table]
    df = spark.read.parquet(path).select(*schema.fieldNames())
    return stage(df, table)


def required_null_counts(df: DataFrame, table: str) -> DataFrame:
    """S-9 as a rule: NULL count of every required column, one scan."""
    cols = required_columns(RAW_TABLES[table])
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in cols])
    return agg.select(F.lit(table).alias("table_name"), F.inline(stack))


def read_raw_table(spark: SparkSession, name: str, table: str) -> Staged:
    """A table of the session's catalog (a warehouse source), staged."""
    return stage(spark.read.table(name).select(*RAW_TABLES[table].fieldNames()), table)


def read_sources(spark: SparkSession, paths: dict[str, str], fmt: str = "csv") -> dict[str, Staged]:
    """S-19: the named raw sources (entity -> path, or table name) read and staged;
    ``fmt`` is csv, parquet or table."""
    reader = {"csv": read_raw_csv, "parquet": read_raw_parquet, "table": read_raw_table}[fmt]
    return {table: reader(spark, path, table) for table, path in paths.items()}
