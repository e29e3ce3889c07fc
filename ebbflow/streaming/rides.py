"""T4: ride assembly from movement events in any order.

Each micro-batch appends one partial row per ride it touches (the times its own events give), hash-partitioned by
ride.  A ride's state is the maximum of every time over its partial rows, so it does not matter in which
order or in which batches READY, BEGIN and END/CANCEL arrive: a BEGIN that comes after the END corrects
the finished ride the next time it is read (D8).  A batch costs its own size: it reads neither the fact nor the pending rides.

:func:`compact_rides` folds the partial rows into a base version, so that reads stay bounded.  Replays are
safe: a batch overwrites its own directory, a compaction is published by the manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.operators import facts
from ebbflow.plans.taxi import RIDE_EVENTS
from ebbflow.sinks import tables
from ebbflow.streaming.jobs import MOVE_SCHEMA, RIDE_SCHEMA, _run

PARTS, BASE = "ride_parts", "rides_base"
BUCKETS = 32
TIMES = [*RIDE_EVENTS, "car_plate_num"]


def ride_assembly(spark: SparkSession, source_glob: str, root: str, checkpoint: str, max_files: int = 1,
                  buckets: int = BUCKETS) -> DataFrame:
    """Movement events -> finished rides (those whose END or CANCEL has arrived).  Events without a ride id are ignored."""
    src = spark.readStream.schema(MOVE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(source_glob)

    def batch(df: DataFrame, batch_id: int) -> None:
        parts = facts.pivot_events(df.filter(F.col("ride").isNotNull()), "ride", "event", "dt", RIDE_EVENTS, carry=["car_plate_num"])
        parts = parts.withColumn("bucket", F.pmod(F.xxhash64("ride"), F.lit(buckets)).cast("int"))
        tables.append_batch(parts, f"{root}/{PARTS}", batch_id, partition_by="bucket")

    _run(src, batch, checkpoint)
    return finished_rides(spark, root)


def _base_version(spark: SparkSession, root: str) -> int | None:
    m = tables.latest_manifest(spark, root)
    return (m["tables"] or {}).get(BASE) if m is not None else None


def rides(spark: SparkSession, root: str, buckets: list[int] | None = None) -> DataFrame:
    """Every ride seen, with the times known so far; with ``buckets`` only the rides of these (directories are pruned)."""
    base_v = _base_version(spark, root)
    parts = tables.read_appended(spark, f"{root}/{PARTS}", RIDE_SCHEMA, with_batch=True, extra_partitions="bucket INT")
    if base_v is not None:
        base = spark.read.schema(f"{RIDE_SCHEMA}, bucket INT").parquet(tables.version_path(root, BASE, base_v))
        parts = parts.filter(F.col("batch") > base_v).drop("batch").unionByName(base)
    if buckets is not None:
        parts = parts.filter(F.col("bucket").isin(buckets))
    return parts.groupBy("ride").agg(*[F.max(c).alias(c) for c in TIMES])


def finished_rides(spark: SparkSession, root: str) -> DataFrame:
    return facts.completed(rides(spark, root), "ride_end_dt")


def pending_rides(spark: SparkSession, root: str) -> DataFrame:
    """Open rides only: events have arrived, an END or CANCEL has not."""
    return rides(spark, root).filter(F.col("ride_end_dt").isNull())


def compact_rides(spark: SparkSession, root: str, upto_batch: int, buckets: int = BUCKETS) -> None:
    """Fold the base and the partial rows up to ``upto_batch`` into a new base; later batches stay partial rows."""
    base_v = _base_version(spark, root)
    if base_v is not None and base_v >= upto_batch:
        return
    parts = tables.read_appended(spark, f"{root}/{PARTS}", RIDE_SCHEMA, with_batch=True).filter(F.col("batch") <= upto_batch)
    if base_v is not None:
        parts = parts.filter(F.col("batch") > base_v)
    parts = parts.drop("batch")
    if base_v is not None:
        parts = parts.unionByName(spark.read.schema(RIDE_SCHEMA).parquet(tables.version_path(root, BASE, base_v)))
    folded = parts.groupBy("ride").agg(*[F.max(c).alias(c) for c in TIMES]) \
        .withColumn("bucket", F.pmod(F.xxhash64("ride"), F.lit(buckets)).cast("int"))
    folded.write.mode("overwrite").partitionBy("bucket").parquet(tables.version_path(root, BASE, upto_batch))
    tables.commit(spark, root, upto_batch, {BASE: upto_batch})
