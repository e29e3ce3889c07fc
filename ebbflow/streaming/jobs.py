"""Structured Streaming jobs (T1..T3; T4 is in ``rides``, T5 in ``dimension``).

The reference polls sources on a schedule and keeps high-water marks; here
a file source with a checkpoint tracks which files were consumed (exactly
once), and each micro-batch runs the same batch operators inside
``foreachBatch``.  Every sink write is idempotent on replay:

* append-only facts go to ``<fact>/batch=<id>`` (overwrite of that directory)
  and de-duplicate against the batches committed before ``id``;
* upserted documents are merge-on-read deltas (one latest row per key per
  batch), resolved by one partial aggregate when read;
* state tables (SCD2 history/current, pending rides) are written as a new
  version and published by a manifest row; a batch whose manifest already
  exists is skipped.

Late data is never dropped: no event-time watermark filters rows here; the
de-duplication state is the fact table itself, probed only on the date
range a batch touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.operators import facts, scd1
from ebbflow.sinks import tables
from ebbflow.sources.rejects import TRANSACTION_FIELDS, Parsed, parse_lines

TRANS_HEADER = "trans_id;"
TRANS_FACT_SCHEMA = ("trans_id STRING, trans_date TIMESTAMP_NTZ, card_num STRING, oper_type STRING, "
                     "amt DECIMAL(10,2), oper_result STRING, terminal STRING")
TRANS_TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"   # full microseconds (the JSON default keeps millis)
DOC_SCHEMA = "id BIGINT, object_id BIGINT, object_value STRING, update_ts TIMESTAMP_NTZ"
PAYMENT_SCHEMA = "card_num STRING, transaction_amt DECIMAL(12,2), transaction_dt TIMESTAMP_NTZ"
MOVE_SCHEMA = "ride BIGINT, car_plate_num BIGINT, event STRING, dt TIMESTAMP_NTZ"
RIDE_SCHEMA = ("ride BIGINT, ride_arrival_dt TIMESTAMP_NTZ, ride_start_dt TIMESTAMP_NTZ, "
               "ride_end_dt TIMESTAMP_NTZ, car_plate_num BIGINT")


def _run(stream: DataFrame, fn, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _committed(spark: SparkSession, root: str, version: int) -> bool:
    return tables.has_manifest(spark, root, version)


# ------------------------------------------------------------------ T1
def file_ingest(spark: SparkSession, source_glob: str, fact_path: str, checkpoint: str,
                max_files: int = 1, archive_dir: str | None = None) -> DataFrame:
    """``;``-separated transaction files with decimal commas -> fact.

    Lines that cannot be read go, with the reason, to ``<fact>_rejects``
    (:func:`rejected_lines`) and the feed goes on.  Header lines start with
    the first column's name.  With ``archive_dir`` (K6) the file source moves each consumed file there
    once its batch is committed (``cleanSource=archive``)."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    src = reader.text(source_glob)

    def batch(df: DataFrame, batch_id: int) -> None:
        s = df.sparkSession
        lines = df.filter(~F.coalesce(F.col("value").startswith(TRANS_HEADER), F.lit(False)))
        feed = parse_lines(lines, TRANSACTION_FIELDS, ";")
        feed = Parsed(feed.rows.persist(), feed.fields)
        try:
            t = feed.good.select("trans_id", "trans_date", "card_num", "oper_type", "amt", "oper_result", "terminal")
            loaded = tables.read_appended(s, fact_path, TRANS_FACT_SCHEMA, before_batch=batch_id)
            tables.append_batch(facts.dedup_append(t, loaded, ["trans_id"]), fact_path, batch_id)
            tables.append_batch(feed.rejected, f"{fact_path}_rejects", batch_id)
        finally:
            feed.rows.unpersist()

    _run(src, batch, checkpoint)
    return tables.read_appended(spark, fact_path, TRANS_FACT_SCHEMA)


def rejected_lines(spark: SparkSession, fact_path: str) -> DataFrame:
    """The lines that :func:`file_ingest` could not read, with the reason."""
    return tables.read_appended(spark, f"{fact_path}_rejects", "line STRING, reason STRING")


# ------------------------------------------------------------------ T2
def scd1_upsert_stream(spark: SparkSession, source_glob: str, root: str, checkpoint: str,
                       max_files: int = 1) -> DataFrame:
    """JSON document feed -> upserted table (newest change wins).

    Merge-on-read: each micro-batch appends only its latest row per document
    to ``<root>/documents/batch=<id>`` (O(batch) per batch, replay-safe), and
    :func:`read_upserted` resolves the current row per document with one
    partial aggregate.  Equal to applying ``scd1_upsert`` batch after batch."""
    src = (spark.readStream.schema(DOC_SCHEMA).option("timestampNTZFormat", JSON_TS_FORMAT)
           .option("maxFilesPerTrigger", max_files).json(source_glob))

    def batch(df: DataFrame, batch_id: int) -> None:
        latest = scd1.latest_per_key(df, ["object_id"], ["update_ts", "id"])
        tables.append_batch(latest, f"{root}/documents", batch_id)

    _run(src, batch, checkpoint)
    return read_upserted(spark, root)


def read_upserted(spark: SparkSession, root: str) -> DataFrame:
    """Current documents: newest (update_ts, id) per object over the last
    compacted base (if any) and the delta batches after it."""
    m = tables.latest_manifest(spark, root)
    base_v = m["tables"].get("documents_base") if m is not None and m["tables"] else None
    deltas = tables.read_appended(spark, f"{root}/documents", DOC_SCHEMA, with_batch=True)
    if base_v is not None:
        deltas = deltas.filter(F.col("batch") > base_v).drop("batch").unionByName(
            spark.read.parquet(tables.version_path(root, "documents_base", base_v)))
    else:
        deltas = deltas.drop("batch")
    return scd1.latest_per_key(deltas, ["object_id"], ["update_ts", "id"])


def compact_upserted(spark: SparkSession, root: str, upto_batch: int) -> None:
    """Fold the base and all deltas up to ``upto_batch`` into a new base
    version and publish it; later reads skip those deltas.  Safe to run
    while the stream appends newer batches (they stay deltas)."""
    m = tables.latest_manifest(spark, root)
    base_v = m["tables"].get("documents_base") if m is not None and m["tables"] else None
    deltas = tables.read_appended(spark, f"{root}/documents", DOC_SCHEMA, with_batch=True).filter(
        F.col("batch") <= upto_batch)
    if base_v is not None:
        deltas = deltas.filter(F.col("batch") > base_v)
    parts = deltas.drop("batch")
    if base_v is not None:
        parts = parts.unionByName(spark.read.parquet(tables.version_path(root, "documents_base", base_v)))
    tables.write_version(scd1.latest_per_key(parts, ["object_id"], ["update_ts", "id"]), root, "documents_base",
                         upto_batch)
    tables.commit(spark, root, upto_batch, {"documents_base": upto_batch})


# ------------------------------------------------------------------ T3
def payment_dedup(spark: SparkSession, source_glob: str, fact_path: str, checkpoint: str,
                  max_files: int = 1) -> DataFrame:
    """Payment feed -> fact without duplicate (card, time, amount).

    The fact is probed only on the batch's time range (pushed down to the
    Parquet row-group statistics), so the check does not scan all history."""
    key = ["card_num", "transaction_dt", "transaction_amt"]
    src = spark.readStream.schema(PAYMENT_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(source_glob)

    def batch(df: DataFrame, batch_id: int) -> None:
        s = df.sparkSession
        rng = df.agg(F.min("transaction_dt").alias("lo"), F.max("transaction_dt").alias("hi")).collect()[0]
        if rng["lo"] is None:
            return
        lo = F.lit(rng["lo"].isoformat(sep=" ")).cast("timestamp_ntz")
        hi = F.lit(rng["hi"].isoformat(sep=" ")).cast("timestamp_ntz")
        # probe only the months the batch covers (directory pruning), then
        # row-group statistics on the exact time range
        month = lambda c: F.trunc(F.to_date(c), "month")
        loaded = tables.read_appended(s, fact_path, PAYMENT_SCHEMA, before_batch=batch_id,
                                      extra_partitions="pay_month DATE").filter(
            F.col("pay_month").between(month(lo), month(hi)) & F.col("transaction_dt").between(lo, hi))
        new = facts.dedup_append(df.select(*key), loaded.select(*key), key)
        new = new.withColumn("pay_month", month("transaction_dt")).hint("rebalance", "pay_month")
        tables.append_batch(new, fact_path, batch_id, partition_by="pay_month")

    _run(src, batch, checkpoint)
    return tables.read_appended(spark, fact_path, PAYMENT_SCHEMA, extra_partitions="pay_month DATE").select(*key)
