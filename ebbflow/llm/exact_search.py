"""Exact top-k search by columnar branch and bound on integer vectors.

Every component ``x`` becomes ``floor(64 * x)``.  Vectors are packed in pieces in vertical layout
(one row of the matrix per dimension).  A task owns a stripe of the candidates and a slice of the
queries.  For a block of queries it takes the dimensions block by block, the most energetic first,
and accumulates partial inner products; what the remaining dimensions can add is bounded by the
product of the two vectors' remaining norms (Cauchy-Schwarz).  Candidates whose bound does not reach
the query's k-th best score are compacted away; the others' scores are complete after the last block,
so the result is exact.

The starting k-th score of a query comes from a bounded sample of candidates (``sample`` rows,
smallest hash of the id); it only prunes, the result does not depend on it.  A task returns at most ``k``
rows for each query and stripe.  Stripes hold at most about 2**20 rows, and slices 2**18 queries.

Nulls and edge cases: vectors that are null, empty or hold a null or non-finite component (or one whose
64-fold is not finite) take no part, nor do rows with a null id.  Vectors of each length are searched
among themselves.  A query finds no row of its own id; rows that share an id are candidates each, and
as queries each distinct vector of an id is answered; ties go to the smaller id, then any of the rows that share
it; with fewer candidates than ``k`` all are returned.  Components may have any size: where products could pass
53 bits, Python integers take over, and a score beyond 64 bits is clamped to plus or minus ``2**63 - 1``.  An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm import core

SCALE = 64.0
SAMPLE = 16_384
PIECE = 1_024
STRIPE = 1 << 20
SLICE = 1 << 18
#: A vector with a larger component is multiplied in Python integers.
SMALL = float(1 << 20)
_PIECES = "dim int, part int, big boolean, ids binary, more binary, bound binary, columns binary"
FOUND = "query_id long, query_key long, vec_id long, score long"


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part."""
    v = F.transform(vectors[vector_col], lambda x: x.cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x * SCALE) == float("inf"))
    return vectors.select(vectors[id_col].cast("long").alias("vec_id"), v.alias("v")) \
        .where("vec_id IS NOT NULL AND size(v) > 0").where(~F.exists("v", bad))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, floored matrix) for each vector length in a batch whose second column holds the vectors."""
    lists = batch.column(1)
    lens = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * SCALE)
    start = np.cumsum(lens) - lens
    for dim in np.unique(lens).tolist():
        at = np.flatnonzero(lens == dim)
        yield at, flat[start[at][:, None] + np.arange(dim)]


def _narrow(m: np.ndarray) -> np.ndarray:
    top = np.abs(m).max(initial=0)
    return m.astype(np.int8 if top < 128 else np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.float64)


def _wide(columns: bytes, dim: int, n: int) -> np.ndarray:
    size = len(columns) // (dim * n)
    return np.frombuffer(columns, {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}[size]).reshape(dim, n).astype(np.float64)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products in Python integers, clamped to 64 bits; ``q`` and ``x`` are vertical."""
    whole = lambda m: np.array([[int(v) for v in row] for row in m.T.tolist()], object).reshape(m.shape[1], len(m))
    top = (1 << 63) - 1
    s = whole(q) @ whole(x).T
    return np.array([[max(-top, min(top, v)) for v in row] for row in s], np.int64).reshape(s.shape)


def _exact_kind(q: np.ndarray, x: np.ndarray) -> type | None:
    """The float type in which every partial sum of products is exact, if there is one."""
    reach = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * len(x)
    return np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else None


def survivors(q: np.ndarray, x: np.ndarray, q_left: np.ndarray, x_left: np.ndarray, bound: np.ndarray,
              block: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of all pairs whose score reaches the query's ``bound``.

    ``q`` and ``x`` are vertical; ``q_left[d]``, ``x_left[d]`` are the norms of what follows dimension ``d``.
    """
    dim, n = x.shape
    cols = np.arange(n)
    partial = np.zeros((q.shape[1], n), x.dtype)
    pairs = None
    slack = 1 + 1e-6
    for d in range(0, dim, block):
        e = min(d + block, dim)
        if pairs is None:
            partial += q[d:e].T @ x[d:e][:, cols] if len(cols) < n else q[d:e].T @ x[d:e]
            if e == dim:
                a, b = np.nonzero(partial >= bound[:, None])
                return a, cols[b], partial[a, b].astype(np.int64)
            alive = partial + (q_left[e] * slack)[:, None] * x_left[e][cols] + 1 >= bound[:, None]
            if np.count_nonzero(alive) * 16 <= alive.size:
                a, b = np.nonzero(alive)
                pairs = a, cols[b], partial[a, b]
            else:
                used = alive.any(axis=0)
                if np.count_nonzero(used) * 4 < 3 * len(cols):
                    cols, partial = cols[used], np.ascontiguousarray(partial[:, used])
        else:
            a, b, s = pairs
            for k in range(d, e):
                s = s + q[k, a] * x[k, b]
            left = q_left[e][a] * slack * x_left[e][b] + 1 if e < dim else 0
            keep = s + left >= bound[a]
            pairs = a[keep], b[keep], s[keep]
    a, b, s = pairs
    return a, b, s.astype(np.int64)


def _left(m: np.ndarray) -> np.ndarray:
    """Row ``d``: the norms over the dimensions from ``d`` on."""
    sq = np.zeros((len(m) + 1, m.shape[1]))
    sq[:-1] = np.cumsum((m * m)[::-1], axis=0)[::-1]
    return np.sqrt(sq)


def _top(group: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int, groups: int) -> np.ndarray:
    """Positions of the ``k`` best (score, then smaller id) of each group."""
    order = np.lexsort((ids, -score, group))
    return order[core.ranges(np.bincount(group, minlength=groups)) < k]


def best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int,
         query_block: int = 256, chunk: int = 4_096) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query number, id, score): each query's ``k`` best candidates, of those that reach ``bound``."""
    kind = _exact_kind(q, x)
    energy = np.argsort(-(x * x).sum(axis=1), kind="stable")
    x, q = x[energy], q[energy]
    if kind is not None:
        x_left, q_left = _left(x), _left(q)
        x, q = x.astype(kind), q.astype(kind)
    for i in range(0, q.shape[1], query_block):
        mine = slice(i, i + query_block)
        reach = bound[mine].copy()
        a, b, s = (np.empty(0, np.int64) for _ in range(3))
        for j in range(0, x.shape[1], chunk):
            part = slice(j, j + chunk)
            if kind is None:
                all_scores = _scores(q[:, mine], x[:, part])
                u, v = np.nonzero(all_scores >= reach[:, None])
                w = all_scores[u, v]
            else:
                u, v, w = survivors(q[:, mine], x[:, part], q_left[:, mine], x_left[:, part], reach)
            other = query_ids[mine][u] != ids[part][v]
            a, b, s = np.concatenate((a, u[other])), np.concatenate((b, ids[part][v[other]])), np.concatenate((s, w[other]))
            keep = _top(a, b, s, k, len(reach))
            a, b, s = a[keep], b[keep], s[keep]
            n = np.bincount(a, minlength=len(reach))
            full = n == k
            reach[full] = np.maximum(reach[full], s[np.cumsum(n)[full] - 1])
        yield a + i, b, s


def _unpack(table: pa.Table) -> dict[bool, tuple[np.ndarray, ...]]:
    """The pieces of a table in one matrix each for small and for big vectors: (ids, more, bound, matrix)."""
    out: dict[bool, list] = {}
    for r in table.to_pylist():
        ids = np.frombuffer(r["ids"], np.int64)
        out.setdefault(r["big"], []).append((ids, np.frombuffer(r["more"] or b"", np.int64), np.frombuffer(r["bound"] or b"", np.float64),
                                             _wide(r["columns"], r["dim"], len(ids))))
    return {big: tuple(np.concatenate(p, axis=-1) for p in zip(*rows, strict=True)) for big, rows in out.items()}


def search(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
           sample: int = SAMPLE, piece: int = PIECE, stripe: int = STRIPE, query_slice: int = SLICE) -> DataFrame:
    """The ``k`` highest scores of every row for which ``queries`` (over ``vec_id``) holds.

    Returns ``query_id, rank, vec_id, score``.
    """
    spark = vectors.sparkSession
    rows = valid(vectors, id_col, vector_col)
    asked = rows.where(queries).dropDuplicates(["vec_id", "v"]).withColumn("query_key", F.xxhash64("v"))
    n = rows.agg(F.count("*").alias("n"), F.count_if(queries).alias("q")).first()
    stripes = max(-(-n.n // stripe), min(64, -(-n.n // 8_192)), 1)
    slices = max(1, -(-n.q // query_slice))
    first = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    seeds: dict[int, list] = {}
    for b in first.toArrow().to_batches():
        for at, m in matrices(b):
            seeds.setdefault(m.shape[1], []).append((b.column(0).to_numpy()[at], m))
    sent = spark.sparkContext.broadcast({d: (np.concatenate([i for i, _ in s]), np.concatenate([m for _, m in s]).T)
                                         for d, s in seeds.items()})

    def seeded(ids: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The k-th best score of each query within the sample; none where the sample has fewer."""
        out = np.full(len(ids), -np.inf)
        if len(q) in sent.value:
            some, x = sent.value[len(q)]
            small = np.abs(x).max(axis=0) <= SMALL
            if _exact_kind(q, x[:, small]) is not None:
                for a, _, s in best(some[small], x[:, small], ids, q, out, k):
                    n = np.bincount(a, minlength=len(ids))
                    full = n == k
                    out[full] = s[np.cumsum(n)[full] - 1]
        return out

    def pieces(parts: int, query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = b.column(0).to_numpy()
                more = b.column(2).to_numpy() if query else None
                for at, m in matrices(b):
                    big = np.abs(m).max(axis=1) > SMALL
                    for kind in (False, True):
                        some = np.flatnonzero(big == kind)
                        for i in range(0, len(some), piece):
                            r = some[i:i + piece]
                            own, x = ids[at[r]], np.ascontiguousarray(m[r].T)
                            row = {"dim": len(x), "part": zlib.crc32(own.tobytes()) % parts, "big": kind, "ids": own.tobytes(),
                                   "columns": _narrow(x).tobytes()}
                            if query:
                                bound = seeded(own, x) if not kind else np.full(len(own), -np.inf)
                                row |= {"more": more[at[r]].tobytes(), "bound": bound.tobytes()}
                            yield core.batch_of(_PIECES, [row])

        return run

    def compare(data: pa.Table, asks: pa.Table) -> pa.Table:
        out = []
        have = _unpack(data)
        for ids, key, bound, q in _unpack(asks).values():
            for own, _, _, x in have.values():
                for a, b, s in best(own, x, ids, q, bound, k):
                    out.append(pa.table([ids[a], key[a], b, s], schema=core.arrow_schema(FOUND)))
        return pa.concat_tables(out) if out else core.arrow_schema(FOUND).empty_table()

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = rows.mapInArrow(pieces(stripes, False), _PIECES).withColumnRenamed("part", "stripe").withColumn("slice", every(slices))
    asks = asked.select("vec_id", "v", "query_key").mapInArrow(pieces(slices, True), _PIECES) \
        .withColumnRenamed("part", "slice").withColumn("stripe", every(stripes))
    tile = ["dim", "stripe", "slice"]
    found = data.groupBy(*tile).cogroup(asks.groupBy(*tile)).applyInArrow(compare, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
