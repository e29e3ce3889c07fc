"""Writing warehouse tables on plain Parquet.

Parquet has no UPDATE/MERGE and a path cannot be overwritten while it is
read, so every change of a dimension or state table is written as a new
version directory ``<root>/<table>/v=<n>``.  A batch becomes visible when
its manifest row ``<root>/_manifest/v=<n>`` (table -> version, watermarks)
is written, last.  Readers resolve tables through the newest manifest, so
data and watermarks of a batch commit together (K5) and a replayed batch
(same ``n``) rewrites the same directories (idempotent).

All I/O goes through Spark, so ``root`` may live on any shared file system.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ebbflow.functions.expr import OPEN_END

MANIFEST_SCHEMA = "version BIGINT, tables MAP<STRING, BIGINT>, watermarks MAP<STRING, STRING>"


def version_path(root: str, table: str, version: int) -> str:
    return f"{root}/{table}/v={version:012d}"


def write_version(df: DataFrame, root: str, table: str, version: int) -> str:
    """K1/K2: write one immutable table version (overwrite = replay-safe)."""
    path = version_path(root, table, version)
    df.write.mode("overwrite").parquet(path)
    return path


def commit(spark: SparkSession, root: str, version: int, tables: dict[str, int],
           watermarks: dict[str, str] | None = None) -> None:
    """K5: publish a batch: one manifest row, written after all its data.

    Tables and watermarks that the batch does not touch are carried forward
    from the newest earlier manifest, so a manifest always names everything."""
    before = latest_manifest(spark, root, before=version)
    kept = {n: dict(before[n] or {}) if before else {} for n in ("tables", "watermarks")}
    row = [(version, {**kept["tables"], **tables}, {**kept["watermarks"], **(watermarks or {})})]
    spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(
        f"{root}/_manifest/v={version:012d}")


def commit_each(spark: SparkSession, root: str, batches: Iterable[tuple[int, dict[str, int], dict[str, str]]]) -> None:
    """K5 for many batches (version, tables, watermarks), published one after the other as :func:`commit` does.

    The manifest before them is read once, and each one is a small file written without a Spark job; its success mark
    comes last, so a batch is published as a whole or not at all."""
    kept = None
    for version, tables, watermarks in batches:
        if kept is None:
            before = latest_manifest(spark, root, before=version)
            kept = {n: dict(before[n] or {}) if before else {} for n in ("tables", "watermarks")}
        kept = {"tables": {**kept["tables"], **tables}, "watermarks": {**kept["watermarks"], **watermarks}}
        path = f"{root}/_manifest/v={version:012d}"
        delete(spark, path)
        for file, text in (("part-00000.json", json.dumps({"version": version, **kept}) + "\n"), ("_SUCCESS", "")):
            place, fs = _place(spark, f"{path}/{file}")
            out = fs.create(place, True)
            try:
                out.write(bytearray(text.encode()))
            finally:
                out.close()


def _place(spark: SparkSession, path: str):
    """A path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, if it is there."""
    place, fs = _place(spark, path)
    fs.delete(place, True)


def latest_manifest(spark: SparkSession, root: str, before: int | None = None):
    """The newest committed manifest row (of a version under ``before``), or None.

    Versions are found by listing the manifest folder; only the newest one is read."""
    for v in sorted(committed_versions(spark, root), reverse=True):
        if before is None or v < before:
            return spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/_manifest/v={v:012d}").first()
    return None


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions whose manifest was written completely (Spark's success mark is there)."""
    marks, fs = _place(spark, f"{root}/_manifest/v=*/_SUCCESS")
    found = fs.globStatus(marks) or []
    return [int(s.getPath().getParent().getName()[2:]) for s in found]


def has_manifest(spark: SparkSession, root: str, version: int) -> bool:
    """Whether batch ``version`` was committed (a listing, nothing is read)."""
    return version in committed_versions(spark, root)


def read_table(spark: SparkSession, root: str, table: str, schema: str | None = None) -> DataFrame | None:
    """Current version of ``table`` per the newest manifest."""
    m = latest_manifest(spark, root)
    if m is None or table not in (m["tables"] or {}):
        return spark.createDataFrame([], schema) if schema else None
    return spark.read.parquet(version_path(root, table, m["tables"][table]))


def write_dimension(from_open: DataFrame, root: str, table: str, version: int, end: str = OPEN_END) -> None:
    """SCD2 storage: closed versions never change, so a batch writes only the
    versions it closed (``part=history``) and the open set (``part=current``)
    under ``v=<n>``, in one job.  Per-batch writes scale with the open set and
    the batch, not with the whole history."""
    from ebbflow.operators.scd2 import is_open

    part = F.when(is_open(end=end), F.lit("current")).otherwise(F.lit("history")).alias("part")
    (from_open.select("*", part).write.mode("overwrite").partitionBy("part")
     .parquet(f"{root}/{table}/v={version:012d}"))
    from_open.limit(0).write.mode("overwrite").parquet(f"{root}/_columns/{table}")  # a version without rows has no file


def read_dimension(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """History committed up to the newest manifest plus its current set
    (partition pruning on ``v`` and ``part``)."""
    m = latest_manifest(spark, root)
    if m is None or table not in (m["tables"] or {}):
        return None
    v = m["tables"][table]
    schema = T.StructType(list(spark.read.parquet(f"{root}/_columns/{table}").schema.fields) + [T.StructField("v", T.LongType()),
                                                     T.StructField("part", T.StringType())])
    d = spark.read.schema(schema).parquet(f"{root}/{table}")
    keep = ((F.col("part") == "history") & (F.col("v") <= v)) | ((F.col("part") == "current") & (F.col("v") == v))
    return d.filter(keep).drop("v", "part")


def write_mart(df: DataFrame, path: str, partition_col: str = "report_dt") -> None:
    """K7: accumulating report table; a re-run replaces only the report
    dates it produces (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def write_report(df: DataFrame, root: str, name: str, version: int, dates: list[str]) -> dict[str, int]:
    """K7 under the manifest: the rows of some report dates (``report_dt``); what to commit, so that these dates are
    read from this run, also those without rows."""
    df.filter(F.col("report_dt").isin([F.lit(d).cast("date") for d in dates])).write.mode("overwrite") \
        .partitionBy("report_dt").parquet(f"{root}/{name}/version={version:012d}")
    return {f"{name}.{d}": version for d in dates}


def read_report(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The rows of all committed report dates, each from the run that wrote it last.  ``schema`` ends with ``report_dt DATE``."""
    m = latest_manifest(spark, root)
    valid = [(n[len(name) + 1:], v) for n, v in (dict(m["tables"] or {}) if m is not None else {}).items() if n.startswith(f"{name}.")]
    if not valid:
        return spark.createDataFrame([], schema)
    pairs = spark.createDataFrame(valid, "report_dt STRING, version BIGINT").select(F.col("report_dt").cast("date"), "version")
    stored = spark.read.schema(f"{schema}, version BIGINT").parquet(f"{root}/{name}")
    return stored.join(F.broadcast(pairs), ["report_dt", "version"], "left_semi").drop("version")  # one row per report date


def append_batch(df: DataFrame, path: str, batch_id: int, partition_by: str | None = None) -> None:
    """Append-only fact written per micro-batch: ``<path>/batch=<id>``; a
    replayed batch overwrites its own directory only.  With ``partition_by``
    (e.g. a date column) each batch is split further, so probes by that
    column prune directories."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(f"{path}/batch={batch_id:012d}")


def append_batches(df: DataFrame, path: str) -> None:
    """:func:`append_batch` for many batches in one job; the column ``batch`` (a number) names each row's batch.  Batches
    that ``df`` has no rows of stay as they are."""
    (df.withColumn("batch", F.lpad(F.col("batch").cast("string"), 12, "0")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def read_appended(spark: SparkSession, path: str, schema: str, before_batch: int | None = None,
                  extra_partitions: str | None = None, with_batch: bool = False) -> DataFrame:
    """Rows of an append-only fact; with ``before_batch`` only the batches
    committed before it (a replayed batch must not see its own rows)."""
    full = f"{schema}, batch BIGINT"
    if extra_partitions:
        full += ", " + extra_partitions
    try:
        df = spark.read.schema(full).parquet(path)
    except AnalysisException:
        df = spark.createDataFrame([], full)
    if before_batch is not None:
        df = df.filter(F.col("batch") < before_batch)
    return df if with_batch else df.drop("batch")
