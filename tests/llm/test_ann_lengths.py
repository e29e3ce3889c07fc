"""A vector of another length does not drop the others, wherever its id hashes."""

import numpy as np
from pyspark.sql import functions as F

from ebbflow.llm.ann import search


def test_a_huge_vector_does_not_hide_the_others(spark):
    x = np.random.default_rng(1).normal(size=(100, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(777, [1e160] * 4 + [-1e160] * 4)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in search(d, F.col("vec_id") % 20 == 0, k=5, probe_share=1.0, list_size=10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    every = np.vstack((x, [1e160] * 4 + [-1e160] * 4))
    ids = [*range(100), 777]
    for q in range(0, 100, 20):
        s = [(-float((x[q] * v).sum()), i) for i, v in zip(ids, every, strict=True) if i != q]
        assert [i for _, i in sorted(got[q])] == [i for _, i in sorted(s)[:5]]


def test_each_length_is_searched(spark):
    x = np.random.default_rng(0).normal(size=(40, 6))
    ids = list(range(40))
    first = min(spark.range(1000, 1100).select("id", F.xxhash64("id").alias("h")).collect(), key=lambda r: r.h).id
    least = spark.range(40).select(F.min(F.xxhash64("id")).alias("h")).first().h
    assert spark.sql(f"SELECT xxhash64({first}L) AS h").first().h < least
    other = [(first, [1.0, 2.0]), (5000, [2.0, 1.0]), (5020, [1.0, 0.5])]
    d = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)] + other, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in search(d, F.col("vec_id") % 20 == 0, k=5, probe_share=1.0).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    for q in (0, 20):
        want = sorted((i for i in ids if i != q), key=lambda i: (-float((x[i] * x[q]).sum()), i))[:5]
        assert [got[q][r] for r in range(1, 6)] == want
    assert set(got[5000].values()) == {first, 5020} and set(got[5020].values()) == {first, 5000}
