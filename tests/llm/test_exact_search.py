"""Exact top-k search against all pairs in Python integers."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from ebbflow.llm.exact_search import best, search, survivors, _left


def brute(rows, k, every=20):
    ok = [(i, [math.floor(64.0 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(64.0 * x) for x in v)]
    out = []
    for i, v in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        s = sorted((-max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j) for j, w in ok if j != i and len(w) == len(v))
        out += [(i, r + 1, j, -t) for r, (t, j) in enumerate(s[:k])]
    return sorted(out)


def run(spark, rows, k, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3) \
        .withColumn("score", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("stripe", F.lit(2))
    return sorted(map(tuple, search(df, F.col("vec_id") % 20 == 0, k=k, **more).collect()))


def cases():
    r = random.Random(3)
    one = [r.gauss(0, 0.12) for _ in range(40)]
    rows = [(i, [r.gauss(0, 0.12) for _ in range(40)]) for i in range(300)]
    rows += [(300 + i, one) for i in range(150)]  # many copies of one vector: ties
    rows += [(600 + i, [float(r.randint(-2, 2)) for _ in range(3)]) for i in range(60)]  # another length
    rows += [(700, None), (701, []), (702, [None] * 40), (703, [float("nan")] * 40), (704, [float("inf")] + [0.0] * 39),
             (None, one), (720, [0.0] * 40), (20, one), (20, one), (40, rows[40][1])]
    return rows


def test_matches_all_pairs(spark):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in cases()]
    want = brute(rows, 7)
    assert run(spark, rows, 7) == want
    # several stripes and slices, hardly any sample
    assert run(spark, rows, 7, piece=16, stripe=100, query_slice=5, sample=3) == want


def test_huge_components(spark):
    r = random.Random(5)
    rows = [(i, [float(np.float32(r.gauss(0, 10.0 ** r.choice([0, 5, 12, 30])))) for _ in range(5)]) for i in range(80)]
    assert run(spark, rows, 4) == brute(rows, 4)


def test_few_rows_and_empty_table(spark):
    assert run(spark, [], 5) == []
    rows = [(0, [1.0, 2.0]), (1, [0.5, -0.25])]
    assert run(spark, rows, 5) == brute(rows, 5) == [(0, 1, 1, 64 * 32 - 128 * 16)]


def test_bounds_lose_no_pair():
    g = np.random.default_rng(1)
    x, q = np.floor(g.normal(size=(48, 500)) * 20), np.floor(g.normal(size=(48, 30)) * 20)
    full = (q.T @ x).astype(np.int64)
    bound = np.sort(full, axis=1)[:, -10].astype(float)
    a, b, s = survivors(q, x, _left(q), _left(x), bound)
    assert set(zip(a.tolist(), b.tolist(), s.tolist())) == {(i, j, int(full[i, j])) for i, j in zip(*np.nonzero(full >= bound[:, None]))}
    got = list(best(np.arange(500), x, np.full(30, -1), q, np.full(30, -np.inf), 10, query_block=7, chunk=33))
    s = np.concatenate([t[2] for t in got])
    assert (s.reshape(30, 10) == -np.sort(-full, axis=1)[:, :10]).all()
