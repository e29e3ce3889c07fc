"""T5: a type 2 dimension kept by a stream of changes and key snapshots.

Layout: ``<root>/<table>/v=<batch>/part=history|current/bucket=<b>``.  The open versions are split into buckets by key
hash.  A batch reads the open versions of the buckets it touches, merges, and writes the versions it closed
(``part=history``, never rewritten) and the touched buckets' open versions (``part=current``).  The manifest names, for every
bucket, the batch that wrote its open versions last, so untouched buckets stay where they are and a batch becomes visible
as a whole.  Replays overwrite the batch's own directory.

Deletes come from a second input: announcements of complete key snapshots, one row each with the place of the snapshot
and its time.  Live keys that a snapshot lacks are closed and get a tombstone; only their buckets are rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.functions.expr import OPEN_END
from ebbflow.operators import scd2
from ebbflow.sinks import tables
from ebbflow.streaming.jobs import _committed, _run

BUCKETS = 16
SNAPSHOT_SCHEMA = "snapshot_path STRING, snapshot_ts TIMESTAMP_NTZ"


class Dimension:
    """A bucketed type 2 dimension below ``root``.

    ``schema`` is the DDL of the staged changes: keys, tracked columns and the change time.
    """

    def __init__(self, spark: SparkSession, root: str, table: str, schema: str | T.StructType, keys: list[str], tracked: list[str],
                 change_ts: str = "change_ts", buckets: int = BUCKETS, end: str = OPEN_END):
        self.spark, self.root, self.table = spark, root, table
        self.keys, self.tracked, self.change_ts, self.buckets, self.end = list(keys), list(tracked), change_ts, buckets, end
        self.staged: dict[str, int] = {}
        staged = {f.name: f for f in (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields}
        ntz = T.TimestampNTZType()
        self.schema = T.StructType([staged[c] for c in self.keys + self.tracked]
                                   + [T.StructField("effective_from", ntz), T.StructField("effective_to", ntz),
                                      T.StructField("is_deleted", T.BooleanType())])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _manifest(self) -> dict[str, int]:
        """Table versions of the newest manifest, and those staged here and not yet committed."""
        m = tables.latest_manifest(self.spark, self.root)
        return {**(dict(m["tables"] or {}) if m is not None else {}), **self.staged}

    def _stored(self) -> DataFrame:
        parts = [T.StructField("v", T.LongType()), T.StructField("part", T.StringType()), T.StructField("bucket", T.IntegerType())]
        try:
            return self.spark.read.schema(T.StructType(list(self.schema.fields) + parts)).parquet(f"{self.root}/{self.table}")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], T.StructType(list(self.schema.fields) + parts))

    def _current(self, buckets: list[int] | None) -> Column:
        """Which stored rows are open versions (of some buckets): tests on directory names only."""
        by_version: dict[int, list[int]] = {}
        for name, v in self._manifest().items():
            if name.startswith(f"{self.table}.open."):
                b = int(name.rsplit(".", 1)[1])
                if buckets is None or b in buckets:
                    by_version.setdefault(v, []).append(b)
        keep = F.lit(False)
        for v, some in sorted(by_version.items()):
            keep = keep | ((F.col("v") == v) & F.col("bucket").isin(sorted(some)))
        return (F.col("part") == "current") & keep

    def open_versions(self, buckets: list[int] | None = None) -> DataFrame:
        """Open versions; with ``buckets`` only of these."""
        return self._stored().filter(self._current(buckets)).select(*self.schema.names)

    def read(self) -> DataFrame:
        """The whole dimension as of the newest manifest (empty before the first batch)."""
        upto = self._manifest().get(self.table, -1)
        return self._stored().filter(self._current(None) | ((F.col("part") == "history") & (F.col("v") <= upto))) \
            .select(*self.schema.names)

    def _write(self, rows: DataFrame, version: int, touched: list[int]) -> None:
        """Versions that a batch closed and the open versions of its buckets, not yet published."""
        part = F.when(scd2.is_open(end=self.end), F.lit("current")).otherwise(F.lit("history"))
        (rows.select(*self.schema.names, part.alias("part"), self.bucket().alias("bucket"))
         .repartition("part", "bucket").write.mode("overwrite").partitionBy("part", "bucket")
         .parquet(f"{self.root}/{self.table}/v={version:012d}"))
        self.staged = {self.table: version} | {f"{self.table}.open.{b}": version for b in touched}

    def _publish(self, version: int) -> None:
        tables.commit(self.spark, self.root, version, self.staged)
        self.staged = {}

    def load(self, dim: DataFrame, version: int = 0) -> None:
        """A first version from a whole dimension."""
        self._write(dim, version, list(range(self.buckets)))
        self._publish(version)

    def apply(self, changes: DataFrame, version: int, snapshot: DataFrame | None = None, snapshot_ts: str | None = None) -> list[int]:
        """Merge a batch (and the deletes of a key snapshot); returns the buckets it rewrote."""
        if _committed(self.spark, self.root, version):
            return []
        touched = self.stage(changes, version, snapshot, snapshot_ts)
        self._publish(version)
        return touched

    def stage(self, changes: DataFrame, version: int, snapshot: DataFrame | None = None, snapshot_ts: str | None = None) -> list[int]:
        """As :meth:`apply`, but the caller commits ``staged`` together with other tables; reads through this object see it."""
        self.staged = {}
        touched = {r[0] for r in changes.select(self.bucket()).distinct().collect()}
        if snapshot is not None:
            live = scd2.current(self.open_versions(), include_deleted=False, end=self.end)
            gone = live.join(snapshot.select(*self.keys), self.keys, "left_anti")
            touched |= {r[0] for r in gone.select(self.bucket()).distinct().collect()}
        touched = sorted(touched)
        open_ = self.open_versions(touched)
        more = {"live_keys": snapshot.filter(self.bucket().isin(touched)), "batch_ts": snapshot_ts} if snapshot is not None else {}
        _, rows = scd2.scd2_merge(open_, changes, self.keys, self.tracked, change_ts=self.change_ts, end=self.end, split=True, **more)
        self._write(rows, version, touched)
        return touched


def scd2_stream(spark: SparkSession, changes_glob: str, dim: Dimension, checkpoint: str, stg_schema: str,
                snapshots_glob: str | None = None, max_files: int = 1) -> DataFrame:
    """Staged change files (and announcements of key snapshots, as JSON) -> dimension, one merge per micro-batch.

    The dimension may be empty at the start.  Of several snapshots announced in one batch the newest counts.
    """
    src = spark.readStream.schema(stg_schema).option("maxFilesPerTrigger", max_files).parquet(changes_glob)
    if snapshots_glob:
        said = spark.readStream.schema(SNAPSHOT_SCHEMA).option("maxFilesPerTrigger", 1).json(snapshots_glob)
        src = src.unionByName(said, allowMissingColumns=True)

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            changes, snapshot, ts = df, None, None
            if snapshots_glob:
                changes = df.filter(F.col("snapshot_path").isNull()).drop("snapshot_path", "snapshot_ts")
                newest = df.filter(F.col("snapshot_path").isNotNull()).agg(F.max(F.struct("snapshot_ts", "snapshot_path")).alias("s")).first().s
                if newest is not None:
                    snapshot, ts = df.sparkSession.read.parquet(newest.snapshot_path), newest.snapshot_ts.isoformat(sep=" ")
            dim.apply(changes, batch_id + 1, snapshot, ts)
        finally:
            df.unpersist()

    _run(src, batch, checkpoint)
    return dim.read()
