"""The skew-safe window primitives equal the plain windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ebbflow.operators.windows import running_sums, shift_within_key, within_horizon


def _events(spark, n_rows=400, n_keys=4, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n_rows):
        # one hot key with most rows, sparse gaps so buckets are often empty
        k = 0 if rnd.random() < 0.6 else (None if rnd.random() < 0.2 else rnd.randrange(1, n_keys))
        t = base + dt.timedelta(seconds=rnd.choice([rnd.randrange(0, 600), rnd.randrange(0, 40_000)]))
        rows.append((k, i, t, rnd.randrange(0, 5), None if rnd.random() < 0.1 else rnd.random()))
    return spark.createDataFrame(rows, "k long, id long, ts timestamp_ntz, city int, amt double")


@pytest.mark.parametrize("lag", [False, True])
@pytest.mark.parametrize("n", [1, 3])
def test_shift_matches_plain_window(spark, lag, n):
    df = _events(spark)
    got = shift_within_key(df, ["k"], ["ts", "id"], ["city", "amt", "ts"], n, lag=lag, prefix="x",
                           bucket_seconds=60)
    w = Window.partitionBy("k").orderBy("ts", "id")
    fn = F.lag if lag else F.lead
    exp = df
    for i in range(1, n + 1):
        for c in ("city", "amt", "ts"):
            exp = exp.withColumn(f"x_{i}_{c}", fn(c, i).over(w))
    cols = sorted(exp.columns)
    assert set(map(tuple, got.select(cols).collect())) == set(map(tuple, exp.select(cols).collect()))


def test_running_sums_match_plain_window(spark):
    df = _events(spark)
    got = running_sums(df, ["k"], ["ts", "id"], {"n": F.lit(1), "s": F.col("city")}, bucket_seconds=60)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("s", F.sum("city").over(w))
    a = {(r.id, r.n, r.s) for r in got.collect()}
    b = {(r.id, r.n, r.s) for r in exp.collect()}
    assert a == b


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    seed=st.integers(0, 10_000),
    bucket=st.sampled_from([1, 7, 60, 3600, 86_400]),
    n=st.integers(1, 3),
    lag=st.booleans(),
)
def test_shift_property(spark, seed, bucket, n, lag):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.randrange(3), i, base + dt.timedelta(seconds=rnd.randrange(0, 300)), rnd.randrange(4))
            for i in range(rnd.randrange(1, 120))]          # many equal timestamps: the id breaks ties
    df = spark.createDataFrame(rows, "k long, id long, ts timestamp_ntz, v int")
    got = shift_within_key(df, ["k"], ["ts", "id"], ["v", "id"], n, lag=lag, prefix="x", bucket_seconds=bucket)
    w = Window.partitionBy("k").orderBy("ts", "id")
    exp = df
    for i in range(1, n + 1):
        for c in ("v", "id"):
            exp = exp.withColumn(f"x_{i}_{c}", (F.lag if lag else F.lead)(c, i).over(w))
    cols = sorted(exp.columns)
    assert set(map(tuple, got.select(cols).collect())) == set(map(tuple, exp.select(cols).collect()))


@pytest.mark.parametrize("bucket", [60, 600, 86_400])
def test_within_horizon_matches_the_plain_window_as_far_as_the_horizon(spark, bucket):
    df = _events(spark)
    horizon, known = 900, F.when(F.col("amt").isNotNull(), F.struct("amt", "ts"))
    exprs = {"p_ts": lambda w: F.lag("ts", 2).over(w), "p_id": lambda w: F.lag("id", 2).over(w),
             "known": lambda w: F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))}
    got = within_horizon(df, ["k"], ["ts", "id"], horizon, exprs, bucket_seconds=bucket)
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = df.select("*", *[f(w).alias(n) for n, f in exprs.items()])
    assert got.columns == want.columns

    def seen(rows):
        near = lambda r, t: t is not None and r.ts - t <= dt.timedelta(seconds=horizon)
        return {(r.id, r.p_id if near(r, r.p_ts) else None, r.known if r.known and near(r, r.known.ts) else None) for r in rows}

    a, b = got.collect(), want.collect()
    assert len(a) == len(b) == df.count()
    assert seen(a) == seen(b)


def test_shift_evaluates_its_input_once(spark, tmp_dir):
    _events(spark).write.parquet(f"{tmp_dir}/e")
    e = spark.read.parquet(f"{tmp_dir}/e")
    out = shift_within_key(e.join(e.groupBy("city").count(), "city"), ["k"], ["ts", "id"], ["amt"], 2, bucket_seconds=600)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
    assert plan.count("FileScan parquet") == 2  # the rows and the count, not again for the edges of the buckets
