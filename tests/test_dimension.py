"""The bucketed type 2 dimension: touched buckets only, deletes from key snapshots, empty start, open end."""

import datetime as dt

from pyspark.sql import functions as F

from ebbflow.operators import scd2
from ebbflow.sinks import tables
from ebbflow.streaming.dimension import Dimension, scd2_stream

SCHEMA = "k long, a string, change_ts timestamp_ntz"
D = [dt.datetime(2024, 1, i) for i in range(1, 9)]
OPEN = dt.datetime(2262, 1, 1)
GAP = dt.timedelta(seconds=15)


def _dim(spark, root, **more):
    return Dimension(spark, root, "dim", SCHEMA, ["k"], ["a"], **more)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _stage(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_a_batch_rewrites_only_its_buckets(spark, tmp_dir):
    dim = _dim(spark, tmp_dir, buckets=8)
    assert _rows(dim.read()) == []  # empty start
    first = _stage(spark, [(i, "x", D[0]) for i in range(40)])
    assert dim.apply(first, 1) == list(range(8))
    one = dim.apply(_stage(spark, [(7, "y", D[1])]), 2)
    assert len(one) == 1
    m = tables.latest_manifest(spark, tmp_dir)["tables"]
    assert [m[f"dim.open.{b}"] for b in range(8)] == [2 if b in one else 1 for b in range(8)]
    stored = {r.bucket for r in spark.read.parquet(f"{tmp_dir}/dim").filter("v = 2").select("bucket").distinct().collect()}
    assert stored == set(one)
    want = [(i, "x", D[0], OPEN, False) for i in range(40) if i != 7] + [(7, "x", D[0], D[1] - GAP, False), (7, "y", D[1], OPEN, False)]
    assert _rows(dim.read()) == sorted(want)
    assert dim.apply(_stage(spark, [(7, "z", D[2])]), 2) == []  # a committed batch is not applied again
    assert _rows(dim.read()) == sorted(want)


def test_batches_equal_one_merge_with_deletes(spark, tmp_dir):
    dim = _dim(spark, tmp_dir, buckets=4)
    rows = [(i % 13, f"v{(i * 7) % 5}", D[i % 6]) for i in range(60)]
    for n, day in enumerate(D[:6]):
        dim.apply(_stage(spark, [r for r in rows if r[2] == day]), n + 1)
    live = spark.createDataFrame([(k,) for k in range(13) if k % 4], "k long")
    touched = dim.apply(_stage(spark, [(20, "new", D[6])]), 7, live.union(spark.createDataFrame([(20,)], "k long")), "2024-01-08 00:00:00")
    whole = scd2.scd2_merge(spark.createDataFrame([], dim.schema), _stage(spark, [*rows, (20, "new", D[6])]), ["k"], ["a"],
                            live_keys=live.union(spark.createDataFrame([(20,)], "k long")), batch_ts="2024-01-08 00:00:00")
    assert _rows(dim.read()) == _rows(whole) and touched
    assert sum(r.is_deleted for r in dim.read().collect()) == 4
    # nothing to delete, nothing changed: no bucket is written
    assert dim.apply(_stage(spark, []), 8, live.union(spark.createDataFrame([(20,)], "k long")), "2024-01-09 00:00:00") == []
    assert _rows(dim.read()) == _rows(whole)


def test_stream_with_snapshots_from_an_empty_start(spark, tmp_dir):
    dim = _dim(spark, f"{tmp_dir}/t", buckets=4)
    _stage(spark, [(1, "x", D[0]), (2, "x", D[0])]).coalesce(1).write.parquet(f"{tmp_dir}/in/p0")
    feeds = (f"{tmp_dir}/in/*/*.parquet", dim, f"{tmp_dir}/ckpt", SCHEMA, f"{tmp_dir}/said/*/*.json")
    scd2_stream(spark, *feeds)
    spark.createDataFrame([(1,)], "k long").write.parquet(f"{tmp_dir}/keys1")
    spark.createDataFrame([(f"{tmp_dir}/keys1", "2024-01-03 00:00:00")], "snapshot_path string, snapshot_ts string").write.json(f"{tmp_dir}/said/a")
    scd2_stream(spark, *feeds)
    _stage(spark, [(2, "back", D[4])]).coalesce(1).write.parquet(f"{tmp_dir}/in/p1")
    want = [(1, "x", D[0], OPEN, False), (2, "back", D[4], OPEN, False), (2, "x", D[0], D[2] - GAP, False), (2, "x", D[2], D[4] - GAP, True)]
    assert _rows(scd2_stream(spark, *feeds)) == want
    assert _rows(scd2_stream(spark, *feeds)) == want


def test_another_open_end(spark, tmp_dir):
    end = "2999-12-31 00:00:00"
    dim = _dim(spark, tmp_dir, buckets=2, end=end)
    dim.apply(_stage(spark, [(1, "x", D[0])]), 1)
    dim.apply(_stage(spark, [(1, "y", D[1])]), 2)
    got = [(r.a, r.e) for r in dim.read().select("a", F.col("effective_to").cast("string").alias("e")).orderBy("effective_from").collect()]
    assert got == [("x", "2024-01-01 23:59:45"), ("y", end)]


def test_an_empty_first_version_can_be_read(spark, tmp_dir):
    empty = spark.createDataFrame([], "k long, effective_from timestamp_ntz, effective_to timestamp_ntz, is_deleted boolean")
    tables.write_dimension(empty, tmp_dir, "d", 0)
    tables.commit(spark, tmp_dir, 0, {"d": 0})
    assert tables.read_dimension(spark, tmp_dir, "d").collect() == []
