"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors get one more component that turns the largest inner product into the smallest
Euclidean distance (``sqrt(M**2 - |x|**2)`` with ``M`` the largest norm), are rotated by a
random orthogonal matrix and assigned to the list of the nearest centroid.  A query probes
its nearest lists.  Within a list the rotated columns are read in blocks; after ``d`` of
``D`` columns a candidate's partial distance, scaled by ``D/d``, estimates its distance, and
a candidate whose estimate exceeds the query's current k-th distance by more than the test's
margin ``(1 + eps0 / sqrt(d))**2`` is abandoned.  Survivors are scored in double precision on
the original vectors.

A query starts from its ``k`` best of the sample, scored exactly: candidates below the last of them are
neither scanned to the end nor sent on, so what a list gives does not grow with the number of its pieces.

Centroids are fitted on at most ``sample`` vectors (smallest hash of the id); every vector is
indexed.  The lists are dealt to ``tiles`` and the queries to as many parts as bound a task's share of both;
a tile meets each part once, so a query travels once per tile and not once per list.  A list that holds a third of all
vectors (or one vector many times) is dealt to many tiles and scanned in pieces of bounded size.

Nulls and edge cases: vectors that are null, zero, or hold a null or non-finite component take no
part, nor do rows with a null id; vectors of each length are searched among themselves; a query never finds rows of its own
id; ties go to the smaller id; with fewer candidates than ``k`` all probed are returned; rows that
share an id are candidates each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm import core

SAMPLE = 20_000
PIECE = 2_048
#: Vectors and queries that one task holds, queries that are compared at once, and tiles at least (of ``PIECE`` vectors or more).
TILE, PART, QUERIES, TILES = 1 << 16, 1 << 16, 1_024, 24
#: Where more than this share of a piece passes a test, the whole distances are one matrix product.
MANY = 0.125
#: Pairs whose vectors are gathered at once.
PAIRS = 1 << 14
OUT = "query_id long, rank int, vec_id long, score double"
_FOUND = "query_id long, vec_id long, score double"
_LISTS = "tile long, list long, ids binary, vectors binary"
_ASKS = "part long, ids binary, vectors binary, bound binary"


@dataclass
class Index:
    rotation: np.ndarray
    centroids: np.ndarray
    norm2: float  #: of the longest vector, after division by ``scale``
    scale: float  #: the largest component, so that squares stay finite
    sample_ids: np.ndarray
    sample: np.ndarray
    tiles: int = 1
    shares: np.ndarray | None = None  #: into how many shares a list is dealt

    def tile(self, lists: np.ndarray, ids: np.ndarray) -> np.ndarray:
        share = core.mix64(ids.view(np.uint64)) % self.shares[lists].astype(np.uint64)
        return (core.mix64(lists.astype(np.uint64) * core.U64(1 << 32) + share) % core.U64(self.tiles)).astype(np.int64)

    def rotated(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        x = x / self.scale
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm2 - (x * x).sum(axis=1), 0))
        return np.column_stack((x, more)) @ self.rotation

    def nearest(self, r: np.ndarray, n: int) -> np.ndarray:
        d = (self.centroids ** 2).sum(axis=1) - 2 * r @ self.centroids.T
        n = min(n, len(self.centroids))
        return np.argpartition(d, n - 1, axis=1)[:, :n]


def _kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    c = x[np.random.default_rng(0).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        at = ((c ** 2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.transform(vectors[vector_col], lambda x: x.cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.select(vectors[id_col].cast("long").alias("vec_id"), v.alias("v")) \
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))


def fit(rows: DataFrame, list_size: int = 1000, max_lists: int = 4096, sample: int = SAMPLE) -> Index | None:
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not chosen:
        return None
    dim = len(chosen[0].v)
    rows = rows.where(F.size("v") == dim)
    scale = float(rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0])
    norm = F.aggregate(F.transform("v", lambda x: x / scale), F.lit(0.0), lambda a, x: a + x * x)
    top = rows.agg(F.max(norm).alias("m"), F.count("*").alias("n")).first()
    x = np.array([r.v for r in chosen if len(r.v) == dim])
    ids = np.array([r.vec_id for r in chosen if len(r.v) == dim], np.int64)
    q, r = np.linalg.qr(np.random.default_rng(7).normal(size=(dim + 1, dim + 1)))
    index = Index(q * np.sign(np.diag(r)), np.zeros((1, dim + 1)), float(top.m), scale, ids, x)
    index.tiles = int(max(1, -(-top.n // TILE), min(TILES, top.n // PIECE)))
    lists = int(max(1, min(max_lists, top.n // list_size, len(x) // 8)))
    index.centroids = _kmeans(index.rotated(x), lists)
    size = np.bincount(index.nearest(index.rotated(x), 1)[:, 0], minlength=lists) * (top.n / len(x))
    index.shares = np.maximum(1, np.ceil(size / (4 * PIECE))).astype(np.int64)
    return index


def _best(score: np.ndarray, n: int) -> np.ndarray:
    """Columns of each row's ``n`` largest, the first of equal ones first."""
    if score.shape[1] <= n:
        return np.argsort(-score, axis=1, kind="stable")
    least = np.partition(score, score.shape[1] - n, axis=1)[:, -n]
    some = score >= least[:, None]
    out = np.empty((len(score), n), np.int64)
    plain = some.sum(axis=1) == n
    out[plain] = np.nonzero(some[plain])[1].reshape(-1, n)
    out[~plain] = np.argsort(-score[~plain], axis=1, kind="stable")[:, :n]
    order = np.argsort(-np.take_along_axis(score, out, axis=1), axis=1, kind="stable")
    return np.take_along_axis(out, order, axis=1)


def seeds(index: Index, query_ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query number, id, score): the best ``k`` of the sample for each query, some queries at a time."""
    for i in range(0, len(q), 64):
        rough = q[i:i + 64] @ index.sample.T
        rough[query_ids[i:i + 64, None] == index.sample_ids] = -np.inf
        near = _best(rough, 2 * k)  # some more, as the exact scores may differ in the last bits
        a = np.repeat(np.arange(i, i + len(near)), near.shape[1])
        b = near.ravel()
        own = query_ids[a] == index.sample_ids[b]
        a, b = a[~own], b[~own]
        s = (q[a] * index.sample[b]).sum(axis=1)
        order = np.lexsort((index.sample_ids[b], -s, a))
        best = order[core.ranges(np.bincount(a - i, minlength=len(near))) < k]
        yield a[best], index.sample_ids[b[best]], s[best]


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, as one product."""
    one = lambda x: np.ones((len(x), 1), x.dtype)
    x = np.hstack((a * a.dtype.type(-2), (a * a).sum(axis=1)[:, None], one(a))) @ np.hstack((b, one(b), (b * b).sum(axis=1)[:, None])).T
    return np.maximum(x, 0, out=x)


def scan(index: Index, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int,
         block: int = 16, eps0: float = 2.1, rotated: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, row, score): the best ``k`` of one piece of a list for each query, of those that score ``bound`` or more."""
    r, rq = rotated or (index.rotated(x).astype(np.float32), index.rotated(q, query=True).astype(np.float32))
    dim, k0 = r.shape[1], min(k + 1, len(r))
    reach = np.full(len(q), np.inf)
    if np.isinf(bound).any():
        # some whole candidates give each query a distance to beat (one more, as the query may be among them)
        head = np.arange(0, len(r), max(1, len(r) // 256))
        if len(head) >= k0:
            reach = np.partition(_squares(rq, r[head]), k0 - 1, axis=1)[:, k0 - 1]
    with np.errstate(over="ignore", invalid="ignore"):
        far = ((q / index.scale) ** 2).sum(axis=1) + index.norm2 - 2 * (bound / index.scale / index.scale)
    reach = np.fmin(reach, np.maximum(far, 0)) + 1e-4 * (np.abs(np.fmin(reach, far)) + index.norm2) + 1e-6
    reach = reach.astype(np.float32)
    partial = _squares(rq[:, :block], r[:, :block])
    keep = partial <= (reach * (1 + eps0 / np.sqrt(block)) ** 2 * (min(block, dim) / dim))[:, None]
    if np.count_nonzero(keep) > MANY * keep.size:  # the test parts little here: gathering pairs would cost more than all columns
        keep &= _squares(rq, r) <= reach[:, None]
        a, b = np.nonzero(keep)
    else:
        a, b = np.nonzero(keep)
        partial = partial[a, b]
        for d in range(block, dim, block):
            e = min(d + block, dim)
            margin = 1.0 if e == dim else (1 + eps0 / np.sqrt(e)) ** 2
            more = [((rq[a[i:i + PAIRS], d:e] - r[b[i:i + PAIRS], d:e]) ** 2).sum(axis=1) for i in range(0, len(a), PAIRS)]
            partial = partial + np.concatenate(more) if more else partial
            keep = partial * (dim / e) <= reach[a] * margin
            a, b, partial = a[keep], b[keep], partial[keep]
    own = ids[b] == query_ids[a]
    a, b = a[~own], b[~own]
    score = np.empty(len(a))
    for i in range(0, len(a), PAIRS):
        score[i:i + PAIRS] = (q[a[i:i + PAIRS]] * x[b[i:i + PAIRS]]).sum(axis=1)
    good = ~(score < bound[a])
    return _top(ids, a[good], b[good], score[good], k)


def _top(ids: np.ndarray, a: np.ndarray, b: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids[b], -score, a))
    a, b, score = a[order], b[order], score[order]
    best = core.ranges(np.bincount(a)) < k
    return a[best], b[best], score[best]


def scan_tile(index: Index, lists: np.ndarray, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, bound: np.ndarray,
              k: int, probes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, id, score): the best ``k`` of a tile's rows for each query, from the lists that the query probes."""
    order = np.argsort(lists, kind="stable")
    lists, ids, x = lists[order], ids[order], x[order]
    r = index.rotated(x).astype(np.float32)
    edges = np.flatnonzero(np.diff(lists, prepend=-1, append=-1))
    cuts = [(a, min(a + PIECE, z)) for s, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) for a in range(s, z, PIECE)]
    for i in range(0, len(q), QUERIES):
        some, some_ids, least = q[i:i + QUERIES], query_ids[i:i + QUERIES], bound[i:i + QUERIES]
        rq = index.rotated(some, query=True)
        probed = np.zeros((len(some), len(index.centroids)), bool)
        np.put_along_axis(probed, index.nearest(rq, probes), True, axis=1)
        rq = rq.astype(np.float32)
        found = []
        for a, z in cuts:
            at = np.flatnonzero(probed[:, lists[a]])
            if len(at):
                f, g, s = scan(index, ids[a:z], x[a:z], some_ids[at], some[at], least[at], k, rotated=(r[a:z], rq[at]))
                found.append((at[f], g + a, s))
        if found:
            f, g, s = _top(ids, *(np.concatenate(z) for z in zip(*found, strict=True)), k)
            yield some_ids[f], ids[g], s


def _narrow(x: np.ndarray) -> np.ndarray:
    """In half the bytes if no component changes by that."""
    with np.errstate(over="ignore"):
        y = x.astype(np.float32)
    return y if (y == x).all() else x


def _vectors(raw: list[bytes], ids: list[np.ndarray], dim: int) -> np.ndarray:
    each = [np.frombuffer(v, np.float32 if len(v) < 8 * dim * len(i) else np.float64).reshape(-1, dim) for v, i in zip(raw, ids, strict=True)]
    return np.concatenate(each).astype(np.float64)


def search(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
           probe_share: float = 0.8, list_size: int = 1000, sample: int = SAMPLE) -> DataFrame:
    """The ``k`` nearest found of every row for which ``queries`` (over ``vec_id``) holds.

    ``probe_share`` is the share of the lists that a query probes.
    """
    rows = valid(vectors, id_col, vector_col)
    found = None
    for r in rows.select(F.size("v").alias("dim")).distinct().orderBy("dim").collect():
        some = _search(rows.where(F.size("v") == r.dim), queries, k, probe_share, list_size, sample)
        found = some if found is None else found.unionByName(some)
    if found is None:
        return vectors.sparkSession.createDataFrame([], OUT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search(rows: DataFrame, queries: Column, k: int, probe_share: float, list_size: int, sample: int) -> DataFrame:
    """The candidates of :func:`search` among valid vectors of one length."""
    spark = rows.sparkSession
    index = fit(rows, list_size, sample=sample)
    dim, probes = index.rotation.shape[0] - 1, int(np.ceil(probe_share * len(index.centroids)))
    sent = spark.sparkContext.broadcast(index)

    tiles, asked = index.tiles, rows.where(queries)
    parts = max(1, -(-asked.count() // PART))

    def unpacked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in batches:
            for i in range(0, b.num_rows, size):
                c = b.slice(i, size)
                yield c.column(0).to_numpy(), c.column(1).flatten().to_numpy().reshape(-1, dim)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in unpacked(batches, PIECE * 4):
            of = sent.value.nearest(sent.value.rotated(x), 1)[:, 0]
            tile = sent.value.tile(of, ids)
            order = np.lexsort((of, tile))
            at = np.flatnonzero((np.diff(tile[order], prepend=-1) != 0) | (np.diff(of[order], prepend=-1) != 0))
            yield core.batch_of(_LISTS, [{"tile": int(tile[r[0]]), "list": int(of[r[0]]), "ids": ids[r].tobytes(), "vectors": _narrow(x[r]).tobytes()}
                                         for r in np.split(order, at[1:])])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in unpacked(batches, QUERIES):
            bound = np.full(len(ids), -np.inf)
            for a, _, score in seeds(sent.value, ids, x, k):
                n = np.bincount(a, minlength=len(ids))
                full = n == k
                bound[full] = score[np.cumsum(n)[full] - 1]
            part = (core.mix64(ids.view(np.uint64)) % core.U64(parts)).astype(np.int64)
            yield core.batch_of(_ASKS, [{"part": p, "ids": ids[part == p].tobytes(), "vectors": _narrow(x[part == p]).tobytes(),
                                         "bound": bound[part == p].tobytes()} for p in np.unique(part).tolist()])

    def compare(key: tuple[pa.Scalar, ...], data: pa.Table, asks: pa.Table) -> pa.Table:
        schema = core.arrow_schema(_FOUND)
        out = [schema.empty_table()]
        if data.num_rows and asks.num_rows:
            each, q_each = ([np.frombuffer(i, np.int64) for i in t.column("ids").to_pylist()] for t in (data, asks))
            lists = np.repeat(data.column("list").to_numpy(), [len(i) for i in each])
            x, q = (_vectors(t.column("vectors").to_pylist(), i, dim) for t, i in ((data, each), (asks, q_each)))
            bound = np.concatenate([np.frombuffer(z) for z in asks.column("bound").to_pylist()])
            for a, i, s in scan_tile(sent.value, lists, np.concatenate(each), x, np.concatenate(q_each), q, bound, k, probes):
                out.append(pa.table([a, i, s], schema=schema))
        return pa.concat_tables(out)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in unpacked(batches, QUERIES):
            for a, i, s in seeds(sent.value, ids, x, k):
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(i), pa.array(s)], schema=core.arrow_schema(_FOUND))

    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    data = rows.mapInArrow(deal, _LISTS).select("*", each(parts).alias("part"))
    asks = asked.mapInArrow(ask, _ASKS).select("*", each(tiles).alias("tile"))
    found = data.groupBy("tile", "part").cogroup(asks.groupBy("tile", "part")).applyInArrow(compare, _FOUND)
    seeded = asked.mapInArrow(first, _FOUND)
    # a row that the sample and a list both gave counts once
    both = found.withColumn("c", F.lit(1)).withColumn("d", F.lit(0)).unionByName(seeded.withColumn("c", F.lit(0)).withColumn("d", F.lit(1)))
    both = both.groupBy("query_id", "vec_id", "score").agg(F.greatest(F.sum("c"), F.sum("d")).alias("n"))
    return both.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")
