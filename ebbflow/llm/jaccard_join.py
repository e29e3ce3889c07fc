"""Exact Jaccard self-join of word-shingle sets as a metric-space join.

Jaccard distance ``1 - J`` is a metric.  Within a cell some documents are pivots;
every other document goes to the Voronoi region of its nearest pivot, and by the
triangle inequality a partner within ``e`` lies in a region whose pivot is at most
``2e`` farther than its own: documents in that window are replicated.  Documents far
from all pivots form a region of their own, with the window next to it.  Regions are
joined recursively; pivots are compared with their whole cell and then leave it, and a
region whose documents are already connected is closed, so a dense group never costs
all its pairs.  Where regions overlap too much or one keeps most rows (many documents around
one, each too far from the others to link), further pivots would only leave one by one: the shingles that the rows share
are counted for all pairs of different components at once, frequent shingles as a matrix
product, rare ones from their lists of rows.  Cells beyond a size are split by Spark, one round per level,
or compared slice by slice; smaller ones inside one task.

At distance 1 from everything, unrelated documents cannot be told apart by any pivot,
so the first cells come from exact conditions instead: (1) equal sets collapse to one
representative; (2) a set can only have a partner if at least the threshold's share of
its shingles occurs elsewhere, estimated from above by merged count-min sketches;
(3) partners share one of the rarest shingles of their sets (prefix condition), and
documents connected by such shingles share a cell.  No link is lost in any of them.

Nulls and edge cases: texts without words have no shingles, link with nothing and are
their own component; a text of fewer words than a shingle has one, its whole sequence;
rows with a null id are returned with a null component; rows that share an id share a
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm import core
from ebbflow.llm.components import components

MID = "kind string, doc_id long, n_shingles long, d1 long, d2 long, keys binary"
SETS = "block long, n_keys long, ids binary, lens binary, keys binary"
COUNTS = "shard int, block long, keys binary, more binary"
LEVEL = "a long, b long, doc_id long, n_shingles long, keys binary, cell long, whole long, parent long, home boolean"
#: A cell beyond so many shingles is split by Spark and not in one task.
CELL_SHINGLES = 1 << 21
#: A block and its shingles cost a worker some forty times this.
BLOCK_BYTES = 2 << 20
PIVOTS = 8
#: Spark splits a cell in slices of about a cell's largest size over this, each with its own copy of the pivots.
SLICES = 4
#: A cell is split into regions only if that makes at most so many rows of each, and no region keeps more than ``CROWD`` of them.
SPREAD, CROWD = 1.5, 0.75
#: A shingle that more than one in so many rows have is a column of the matrix product (of at most ``DENSE`` cells).
COMMON, DENSE = 12, 1 << 22
#: Counts of pairs that are held at once.
PAIRS = 1 << 21


def shingles(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle keys of each text."""
    w = core.Words(texts, lower=True)
    h = w.hashes()
    keys, at = w.windows(width, hashes=h)
    doc = w.doc[at]
    short = np.flatnonzero((w.count > 0) & (w.count < width))
    if len(short):
        whole = core.RangeHash(h).of(w.first[short], w.first[short + 1])
        keys, doc = np.concatenate((keys, whole)), np.concatenate((doc, short))
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    keys, doc = keys[new], doc[new]
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [keys[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def _needed(n: np.ndarray | int, share: Fraction) -> np.ndarray | int:
    """The smallest intersection that a partner of a set of ``n`` can have."""
    return -(-n * share.numerator // share.denominator)


class Sets:
    """Shingle sets in one array, with exact link tests and distances."""

    def __init__(self, sets: list[np.ndarray], share: Fraction):
        self.n = np.array([len(s) for s in sets], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        self.keys = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        self.share = share

    def of(self, i: int) -> np.ndarray:
        return self.keys[self.first[i]:self.first[i + 1]]

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``rows``, key) of all their shingles."""
        n = self.n[rows]
        return np.repeat(np.arange(len(rows)), n), self.keys[np.repeat(self.first[rows], n) + core.ranges(n)]

    def common(self, pivot: np.ndarray, rows: np.ndarray) -> np.ndarray:
        n = self.n[rows]
        hit = core.member(pivot, self.keys[np.repeat(self.first[rows], n) + core.ranges(n)])
        edge = np.concatenate(([0], np.cumsum(n)))
        total = np.concatenate(([0], np.cumsum(hit)))
        return total[edge[1:]] - total[edge[:-1]]

    def linked(self, common: np.ndarray, size: int, rows: np.ndarray) -> np.ndarray:
        union = self.n[rows] + size - common
        return common * self.share.denominator >= union * self.share.numerator

    def distance(self, common: np.ndarray, size: int, rows: np.ndarray) -> np.ndarray:
        return 1 - common / (self.n[rows] + size - common)


def regions(d: np.ndarray, e: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, region) of distances (rows x pivots): home, windows, and the far region ``pivots``.

    With home distance r: a row within r <= 3e stays in the regions of pivots at most r + 2e away; rows beyond form
    the far region, and rows with r > 2e are replicated to it.  Any two rows within e meet in one region.
    """
    slack = 1e-9
    r = d.min(axis=1)
    inside = (d <= (r + 2 * e + slack)[:, None]) & (r <= 3 * e + slack)[:, None]
    row, region = np.nonzero(inside)
    far = np.flatnonzero(r > 2 * e - slack)
    return np.concatenate((row, far)), np.concatenate((region, np.full(len(far), d.shape[1])))


class Roots:
    """Components of rows: union-find towards the smallest index."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        root = self.root
        while True:
            y = root[x]
            if (root[y] == y).all():
                return y
            root[x] = root[y]

    def join(self, x: np.ndarray) -> None:
        touched = self.find(x)
        self.root[touched] = touched.min()


def link_all(sets: Sets, left: np.ndarray, right: np.ndarray | None, roots: Roots) -> None:
    """Link all near pairs of a left and a right row (without ``right``: of the left rows); pairs of one component are not compared."""
    alone = right is None
    if alone:  # the largest component last: its rows meet all others before, and need no block of their own
        _, group, size = np.unique(roots.find(left), return_inverse=True, return_counts=True)
        right = left = left[np.lexsort((group, size[group]))]
    n, num, den = len(right), sets.share.numerator, sets.share.denominator
    kind = np.float32 if sets.n.max(initial=0) < 1 << 22 else np.float64  # counts are whole numbers in either
    row, keys = sets.entries(right)
    every, code, often = np.unique(keys, return_inverse=True, return_counts=True)
    top = np.argsort(-often, kind="stable")[:DENSE // max(1, n)]
    top = top[often[top] > max(1, n // COMMON)]
    column = np.full(len(every), -1)
    column[top] = np.arange(len(top))
    dense = np.zeros((n, len(top)), kind)
    at = column[code]
    dense[row[at >= 0], at[at >= 0]] = 1
    holders, first = row[np.argsort(code, kind="stable")], np.cumsum(often) - often
    size = max(16, PAIRS // max(1, n))
    for a in range(0, len(left), size):
        rows = left[a:a + size]
        from_, mine = np.arange(a if alone else 0, n), roots.find(rows)
        others = roots.find(right[from_])
        if (mine == mine[0]).all():
            from_, others = from_[others != mine[0]], others[others != mine[0]]
        if not len(from_):
            continue
        place = np.full(n, -1)
        place[from_] = np.arange(len(from_))
        i, k = sets.entries(rows)
        k_at = np.minimum(np.searchsorted(every, k), len(every) - 1)
        hit = every[k_at] == k
        i, k_at = i[hit], k_at[hit]
        common_in = column[k_at] >= 0
        block = np.zeros((len(rows), len(top)), kind)
        block[i[common_in], column[k_at[common_in]]] = 1
        common = block @ (dense[from_[0]:] if len(from_) == n - from_[0] else dense[from_]).T
        rare = ~common_in & (often[k_at] > (1 if alone else 0))
        i, k_at = i[rare], k_at[rare]
        held = np.cumsum(often[k_at])
        cuts = np.searchsorted(held, np.arange(PAIRS // 2, held[-1], PAIRS // 2)) if len(held) else []
        flat = common.reshape(-1)
        for some in np.split(np.arange(len(i)), cuts):
            times = often[k_at[some]]
            to = place[holders[np.repeat(first[k_at[some]], times) + core.ranges(times)]]
            where = np.repeat(i[some], times) * len(from_) + to
            np.add.at(flat, where[to >= 0], kind(1))
        least = -(-num * (sets.n[rows][:, None] + sets.n[right[from_]]) // (num + den))
        near = (common >= least) & (mine[:, None] != others)
        for x in np.flatnonzero(near.any(axis=1)).tolist():
            roots.join(np.append(right[from_[near[x]]], rows[x]))


def join_cell(sets: Sets, pivots: int = 4) -> np.ndarray:
    """Component (smallest index) of every set of a cell, by recursive pivot regions."""
    n = len(sets.n)
    roots = Roots(n)
    todo = [np.arange(n)]
    while todo:
        rows = todo.pop()
        at = roots.find(rows)
        if len(rows) < 2 or (at == at[0]).all():
            continue
        # pivots from the smallest components: pairs within one component need no comparison
        _, group, size = np.unique(at, return_inverse=True, return_counts=True)
        chosen = rows[np.argsort(size[group], kind="stable")[:pivots]]
        d = np.empty((len(rows), len(chosen)))
        for k, p in enumerate(chosen.tolist()):
            common = sets.common(sets.of(p), rows)
            d[:, k] = sets.distance(common, int(sets.n[p]), rows)
            roots.join(np.append(rows[sets.linked(common, int(sets.n[p]), rows)], p))
        left = ~np.isin(rows, chosen)
        rows, d = rows[left], d[left]
        if len(rows):
            row, region = regions(d, float(1 - sets.share))
            # the windows overlap too much, or one region keeps too much, to be worth splitting
            if len(row) > SPREAD * len(rows) or np.bincount(region).max() > CROWD * len(rows):
                link_all(sets, rows, None, roots)
            else:
                todo += [rows[row[region == k]] for k in np.unique(region).tolist()]
    return roots.find(np.arange(n))


def _blob_sets(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    share: Fraction = Fraction(4, 5), block_bytes: int = BLOCK_BYTES,
                    shard_keys: int = core.SHARD_KEYS, cell_shingles: int = CELL_SHINGLES, pivots: int = PIVOTS) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id`` (the smallest id reachable by links)."""
    mid = _documents(docs, id_col, text_col, width, share, block_bytes, shard_keys)
    rows = mid.where("kind = 'doc'").select("doc_id", "n_shingles", "d1", "d2")
    same = rows.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    copies = rows.where("doc_id IS NOT NULL").join(same, ["n_shingles", "d1", "d2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reps = mid.where("kind = 'set' AND doc_id IS NOT NULL").groupBy("n_shingles", "d1", "d2") \
        .agg(F.min(F.struct("doc_id", "keys")).alias("s")).select("s.doc_id", "n_shingles", "s.keys")
    links = _links(reps, share, shard_keys, cell_shingles, pivots)
    found = components(links.unionByName(copies))
    return rows.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _documents(docs, id_col, text_col, width, share, block_bytes, shard_keys) -> DataFrame:
    """Each document's set size and digest, and the sets of those that may have a partner."""
    spark = docs.sparkSession
    path = core.pack_documents(docs, id_col, text_col, "jaccard", block_bytes)
    blocks = spark.read.schema(core.BLOCK_SCHEMA).parquet(path)
    bits = core.shard_bits(core.total(blocks, "n_bytes") / 6, shard_keys)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in core.rows_of(batches):
            b = core.Block(row)
            sets = shingles(b.texts, width)
            yield core.batch_of(core.ASK_SCHEMA, core.sketch_rows(b.id, np.concatenate(sets), bits))

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in core.rows_of(batches):
            b = core.Block(row)
            sets = Sets(shingles(b.texts, width), share)
            hit = np.concatenate(([0], np.cumsum(core.flagged(sets.keys, row["answers"] or [], bits))))
            known = hit[sets.first[1:]] - hit[sets.first[:-1]]
            d = [np.concatenate(([0], np.cumsum(core.mix64(sets.keys ^ core.U64(c)), dtype=np.uint64))) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
            digest = [(x[sets.first[1:]].astype(np.uint64) - x[sets.first[:-1]].astype(np.uint64)).view(np.int64) for x in d]
            out = []
            for i, (doc, n) in enumerate(zip(b.ids.tolist(), sets.n.tolist(), strict=True)):
                r = {"kind": "doc", "doc_id": None if doc == core.NULL_ID else doc, "n_shingles": n,
                     "d1": int(digest[0][i]), "d2": int(digest[1][i])}
                out.append(r)
                if n and known[i] >= _needed(n, share):
                    out.append(r | {"kind": "set", "keys": sets.of(i).tobytes()})
            yield core.batch_of(MID, out)

    answers = core.repeated_cells(blocks.mapInArrow(sketch, core.ASK_SCHEMA))
    mid, _ = core.stage(core.with_answers(blocks, answers, ["shard", "keys"]).mapInArrow(flag, MID), "jaccard-sets", "kind")
    core.release(spark, path)
    return mid


def _pack_sets(reps: DataFrame, block_keys: int = 1 << 19) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, n = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[int, bytes]] = []
        size = 0

        def block() -> pa.RecordBatch:
            return core.batch_of(SETS, [{"block": base + n, "n_keys": size // 8, "ids": np.array([h[0] for h in held], np.int64).tobytes(),
                                         "lens": np.array([len(h[1]) // 8 for h in held], np.int64).tobytes(),
                                         "keys": b"".join([h[1] for h in held])}])

        for r in core.rows_of(batches):
            held.append((r["doc_id"], r["keys"]))
            size += len(r["keys"])
            if size >= 8 * block_keys:
                yield block()
                held, size, n = [], 0, n + 1
        if held:
            yield block()

    return reps.select("doc_id", "keys").mapInArrow(run, SETS)


def _unpack_sets(row: dict, share: Fraction) -> tuple[np.ndarray, Sets]:
    keys, n = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["lens"], np.int64)
    return np.frombuffer(row["ids"], np.int64), Sets(np.split(keys, np.cumsum(n)[:-1]), share)


def _merged_counts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Per block, the cells that more than one set has, with the number of sets."""
    blocks = table.column("block").to_pylist()
    cells = [np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("more").to_pylist()])
    every, at = np.unique(np.concatenate(cells), return_inverse=True)
    total = np.bincount(at, weights=counts).astype(np.uint32)
    out, i = [], 0
    for b, mine in zip(blocks, cells, strict=True):
        n = total[at[i:i + len(mine)]]
        i += len(mine)
        if (n > 1).any():
            out.append({"shard": key[0].as_py(), "block": b, "keys": mine[n > 1].tobytes(), "more": n[n > 1].tobytes()})
    return pa.Table.from_pylist(out, schema=core.arrow_schema(COUNTS))


def _links(reps: DataFrame, share: Fraction, shard_keys: int, cell_shingles: int, pivots: int) -> DataFrame:
    """Links between different sets (enough of them to connect every group)."""
    blocks, _ = core.stage(_pack_sets(reps), "jaccard-set-blocks")
    bits = core.shard_bits(core.total(blocks, "n_keys"), shard_keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in core.rows_of(batches):
            keys = np.sort(np.frombuffer(row["keys"], np.uint64))
            out = []
            for shard, a, b in core.split_shards(keys, bits):
                cells, n = np.unique(core.cells_of(keys[a:b], bits), return_counts=True)
                out.append({"shard": shard, "block": row["block"], "keys": cells.tobytes(), "more": n.astype(np.uint32).tobytes()})
            yield core.batch_of(COUNTS, out)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in core.rows_of(batches):
            ids, sets = _unpack_sets(row, share)
            n = np.ones(len(sets.keys), np.int64)
            order = np.argsort(sets.keys)
            s = sets.keys[order]
            said = {a["shard"]: (np.frombuffer(a["keys"], np.uint32), np.frombuffer(a["more"], np.uint32)) for a in row["answers"] or []}
            for shard, a, b in core.split_shards(s, bits):
                if shard in said:
                    cells, total = said[shard]
                    mine = core.cells_of(s[a:b], bits)
                    hit = core.member(cells, mine)
                    n[order[a:b][hit]] = total[np.searchsorted(cells, mine[hit])]
            doc = np.repeat(np.arange(len(ids)), sets.n)
            many = np.bincount(doc, weights=n > 1, minlength=len(ids)) >= _needed(sets.n, share)
            by = np.lexsort((sets.keys, n, doc))  # rarest first within each set, one order for all sets
            length = sets.n - _needed(sets.n, share) + 1
            take = by[core.ranges(sets.n) < np.repeat(length, sets.n)]
            take = take[(n[take] > 1) & many[doc[take]]]
            yield pa.RecordBatch.from_arrays([pa.array(sets.keys[take].view(np.int64)), pa.array(ids[doc[take]])],
                                             schema=core.arrow_schema("key long, doc_id long"))

    counts = blocks.mapInArrow(count, COUNTS).groupBy("shard").applyInArrow(_merged_counts, COUNTS)
    asked, _ = core.stage(core.with_answers(blocks, counts, ["shard", "keys", "more"]).mapInArrow(prefixes, "key long, doc_id long"), "jaccard-prefixes")
    low = asked.groupBy("key").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("z")).where("b < z").select("key", "b")
    cells = components(asked.join(low, "key").select(F.col("doc_id").alias("a"), "b").distinct())
    member, _ = core.stage(reps.join(cells.select(F.col("node").alias("doc_id"), F.col("component").alias("cell")), "doc_id"), "jaccard-cells")

    edges = reps.sparkSession.createDataFrame([], "a long, b long")
    e = float(1 - share)

    def small(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids = np.array(table.column("doc_id").to_pylist(), np.int64)
        order = np.argsort(ids, kind="stable")
        blobs = _blob_sets(table)
        root = join_cell(Sets([blobs[i] for i in order.tolist()], share))
        ids = ids[order]
        out = root != np.arange(len(ids))
        return pa.table({"a": ids[out], "b": ids[root[out]]}, schema=core.arrow_schema("a long, b long"))

    def split(key: tuple[pa.Scalar, ...], rows: pa.Table, chosen: pa.Table) -> pa.Table:
        """A slice of a cell against the cell's pivots: its links to them, and its rows by region."""
        ids, cell = rows.column("doc_id").to_numpy(), key[0].as_py()
        sets, near = Sets(_blob_sets(rows), share), chosen.select(["pivot", "pivot_keys"]).rename_columns(["doc_id", "keys"]).sort_by("doc_id")
        pivot_ids, every = near.column("doc_id").to_numpy(), np.arange(len(ids))
        d = np.empty((len(ids), len(pivot_ids)))
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k, pivot in enumerate(_blob_sets(near)):
            common = sets.common(pivot, every)
            d[:, k] = sets.distance(common, len(pivot), every)
            a.append(ids[sets.linked(common, len(pivot), every)])
            b.append(np.full(len(a[-1]), pivot_ids[k]))
        a, b = np.concatenate(a), np.concatenate(b)
        left = np.flatnonzero(~np.isin(ids, pivot_ids))  # pivots leave the cell
        row, region = regions(d[left], e) if len(left) else (left, left)
        home = np.zeros(len(row), bool)
        home[np.unique(row, return_index=True)[1]] = True
        row = left[row]
        at = np.full(1, cell, np.int64).view(np.uint64)
        columns = {"a": a, "b": b, "doc_id": ids[row], "n_shingles": sets.n[row], "keys": rows.column("keys").take(pa.array(row)),
                   "cell": core.mix64(at + (region + 2).astype(np.uint64)).view(np.int64),
                   "whole": np.repeat(core.mix64(at + core.U64(1)).view(np.int64), len(row)), "parent": np.full(len(row), cell), "home": home}
        schema = core.arrow_schema(LEVEL)
        parts = [{n: columns[n] if (n in "ab") == of_links else pa.nulls(size, schema.field(n).type) for n in schema.names}
                 for of_links, size in ((True, len(a)), (False, len(row)))]
        return pa.concat_tables([pa.table(x, schema=schema) for x in parts])

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Two slices of a cell (or one with itself): the links that join known groups."""
        ids, of = table.column("doc_id").to_numpy(), table.column("slice").to_numpy()
        _, first, at = np.unique(table.column("group").to_numpy(), return_index=True, return_inverse=True)
        start, roots = first[at], Roots(len(ids))
        roots.root = start.copy()
        i, j = (x.as_py() for x in key[1:])
        link_all(Sets(_blob_sets(table), share), np.flatnonzero(of == i), None if i == j else np.flatnonzero(of == j), roots)
        tops = np.unique(start)
        to = roots.find(tops)
        return pa.table({"a": ids[tops[to != tops]], "b": ids[to[to != tops]]}, schema=core.arrow_schema("a long, b long"))

    level, links = 0, None
    member = member.withColumn("group", F.lit(None).cast("long")).withColumn("whole", F.lit(False))
    while True:
        size = member.groupBy("cell").agg(F.sum("n_shingles").alias("size"), F.count("*").alias("n"), F.max("whole").alias("whole"),
                                          F.min(F.coalesce("group", "doc_id")).alias("g"), F.max(F.coalesce("group", "doc_id")).alias("h"))
        size = size.where("n > 1 AND g < h")  # the documents of other cells are connected already
        fit = member.join(size.where(F.col("size") <= cell_shingles).select("cell"), "cell").select("cell", "doc_id", "keys")
        edges = edges.unionByName(fit.groupBy("cell").applyInArrow(small, "a long, b long"))
        over = size.where(F.col("size") > cell_shingles)
        if level:
            edges = edges.unionByName(_tasks(member, over.where("whole"), cell_shingles).groupBy("cell", "i", "j").applyInArrow(compare, "a long, b long"))
        big = over.where(~F.col("whole")).select("cell", F.ceil(F.col("size") * SLICES / cell_shingles).alias("slices"))
        if big.isEmpty():
            return edges
        level += 1
        large = member.join(big, "cell")
        rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.col("group").isNotNull(), F.xxhash64("doc_id", F.lit(level)), "doc_id"))
        # columns of their own: both sides of the cogroup come from one table
        chosen = large.withColumn("k", rank).where(F.col("k") <= pivots) \
            .select(F.col("cell").alias("in_cell"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("in_slice"),
                    F.col("doc_id").alias("pivot"), F.col("keys").alias("pivot_keys"))
        sliced = large.select("cell", F.pmod(F.xxhash64("doc_id"), "slices").alias("slice"), "doc_id", "keys")
        step, _ = core.stage(sliced.groupBy("cell", "slice").cogroup(chosen.groupBy("in_cell", "in_slice")).applyInArrow(split, LEVEL), "jaccard-level")
        found = step.where("a IS NOT NULL").select("a", "b")
        edges, links = edges.unionByName(found), found if links is None else links.unionByName(found)
        rows = step.where("a IS NULL")
        part = rows.groupBy("parent", "cell").agg(F.count("*").alias("n"), F.count_if("home").alias("own"))
        wide = part.groupBy("parent").agg(((F.sum("n") > SPREAD * F.sum("own")) | (F.max("n") > CROWD * F.sum("own"))).alias("wide"))
        rows = rows.join(wide, "parent").where(F.col("home") | ~F.col("wide")) \
            .select("doc_id", "n_shingles", "keys", F.when(F.col("wide"), F.col("whole")).otherwise(F.col("cell")).alias("cell"), F.col("wide").alias("whole"))
        groups = components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("group"))
        member, _ = core.stage(rows.join(groups, "doc_id", "left"), "jaccard-members")


def _tasks(member: DataFrame, cells: DataFrame, cell_shingles: int) -> DataFrame:
    """The rows of cells in slices, each two of which (and each one alone) make one task."""
    slices = cells.select("cell", F.ceil(F.col("size") * 2 / cell_shingles).alias("slices"))
    other = F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)
    return member.join(slices, "cell").withColumn("slice", F.pmod(F.xxhash64("doc_id"), "slices")).withColumn("other", F.explode(other)) \
        .select("cell", F.least("slice", "other").alias("i"), F.greatest("slice", "other").alias("j"), "slice", "doc_id",
                F.coalesce("group", "doc_id").alias("group"), "keys")
