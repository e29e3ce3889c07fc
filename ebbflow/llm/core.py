"""Shared building blocks: vectorised tokenising and hashing, packed document
blocks, and the block/shard exchange.

*Words* are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.

*Blocks.*  :func:`pack_documents` writes the documents once, as rows that each
hold a few MB of compressed text, to the shared checkpoint folder.  A block has
a fixed id from then on, so later passes over it (and retried tasks) agree.

*Exchange.*  A block asks about a set of 64-bit keys by sending one binary cell
per (block, shard) - a shard is a range of key space - and the task that owns a
shard answers per block.  A key held by a third of all documents is sent once
per block and not once per document, so no shard is hot.
"""

from __future__ import annotations

import ctypes
import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.session import scratch_path

BLOCK_BYTES = 4 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What a pass holds of its input at once, in a worker and beside the heap (Spark's own bound is many blocks).
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
#: Rows of blocks and cells are long: a writer looks at its sizes after each few rows, else it holds a hundred of them
#: in a page (and the codec's buffers beside the heap grow to that) and many more in a row group.
_PARQUET = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "4", "parquet.page.size.row.check.min": "4"}
#: What a worker unpacks of a batch's texts at once; tables of powers of such a length are kept.
PIECE_BYTES = 3 << 18
#: Keys that one shard of an exchange holds on average.
SHARD_KEYS = 1 << 20
#: A null doc_id sorts after every id and comes back as null.
NULL_ID = np.iinfo(np.int64).max

U64 = np.uint64
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1)
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWER_BYTES = LOWER.tobytes()


def lower_ascii(b: bytes) -> bytes:
    return b.translate(_LOWER_BYTES)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit keys (splitmix finaliser)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_TABLES = [mix64(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F + 2 * i)) for i in range(2)]


#: What a task leaves in its Python worker for later tasks of the same operator.
_CACHES: list[dict] = []


def task_cache() -> dict:
    """A dict that lives on in a Python worker until a task of another operator calls :func:`drop_caches`."""
    _CACHES.append({})
    return _CACHES[-1]


def drop_caches() -> None:
    for c in _CACHES:
        c.clear()


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, at least ``n + 1`` of each."""
    have = _POW.get(which)
    if have is None or len(have[0]) <= n:
        m = max(n + 1, 1 << 16)
        base = _BASES[which]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.empty(m, U64)
            p[0] = 1
            filled = 1
            step = b
            while filled < m:
                k = min(filled, m - filled)
                p[filled:filled + k] = p[:k] * U64(step)
                filled += k
                step = step * step % (1 << 64)
            out.append(p)
        have = (out[0], out[1])
        if m <= 1 << 20:
            _POW[which] = have
    return have


class RangeHash:
    """64-bit hashes of any ranges of a sequence, from one prefix sum."""

    def __init__(self, values: np.ndarray, which: int = 0):
        self.pow, self.inv = _powers(len(values), which)
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * self.pow[:len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inv[start]
        return mix64(h + (end - start).astype(U64) * U64(0x632BE59BD9B4E019))

    def every(self, k: int) -> np.ndarray:
        """Hashes of all ranges of length ``k``, by start."""
        n = len(self.sums) - k
        if n <= 0:
            return np.empty(0, U64)
        h = self.sums[k:] - self.sums[:n]
        h *= self.inv[:n]
        h += U64(k * 0x632BE59BD9B4E019 % (1 << 64))
        return mix64(h)


def byte_hash(buf: np.ndarray, which: int = 0) -> RangeHash:
    return RangeHash(_TABLES[which][buf], which)


def factorize(buf: np.ndarray, inside: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Codes of consecutive byte strings, and the distinct strings, compared byte by byte.

    ``inside`` masks the strings' bytes in ``buf``, ``lens`` are their lengths.
    """
    offsets = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=offsets[1:])
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(buf[inside])])
    found = strings.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary.to_pylist()


def strong_hashes(strings: list[bytes]) -> np.ndarray:
    """128-bit hashes of strings, as two columns of 64 bits that do not fail together."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, strings)), ">u8").astype(U64).reshape(-1, 2)


class Words:
    """The words of documents joined by one separator byte each.

    ``start``/``end`` are byte ranges in ``buf``; ``first[i]:first[i+1]`` are the
    words of document ``i``; ``doc`` is the document of a word.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join(texts) + b"\n" if texts else b""
        if lower:
            joined = lower_ascii(joined)
        self.raw = joined
        self.buf = np.frombuffer(joined, np.uint8)
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offset = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lens + 1, out=self.offset[1:])
        blank = SPACE[self.buf]
        change = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(blank) and not blank[0]:
            change = np.concatenate(([0], change))
        self.start, self.end = change[0::2], change[1::2]
        self.first = np.searchsorted(self.start, self.offset)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self._hashes: np.ndarray | None = None

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes; the two kinds together make 128 bits."""
        if self._hashes is None:
            codes, words = factorize(self.buf, ~SPACE[self.buf], self.end - self.start)
            self._hashes = strong_hashes(words)[codes]
        return np.ascontiguousarray(self._hashes[:, which])

    def windows(self, k: int, which: int = 0, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the first word) of every run of ``k`` words of one document."""
        h = self.hashes(which) if hashes is None else hashes
        every = RangeHash(h, which).every(k)
        inside = np.flatnonzero(self.doc[: len(every)] == self.doc[k - 1:]) if len(every) else np.empty(0, np.int64)
        return every[inside], inside


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the positions 0..n-1 that a window of ``width`` from one of ``starts`` covers."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + width, n), -1)
    return np.cumsum(d[:n]) > 0


def member(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Mask of the ``x`` that occur in ``sorted_keys``."""
    if not len(sorted_keys) or not len(x):
        return np.zeros(len(x), bool)
    at = np.searchsorted(sorted_keys, x)
    at[at == len(sorted_keys)] = 0
    return sorted_keys[at] == x


# ------------------------------------------------------------------ blocks

BLOCK_SCHEMA = "block long, n_docs long, n_bytes long, ids binary, lens binary, text binary, carry binary"
_CODEC = "zstd"


def pack(block: int, ids: np.ndarray, texts: list[bytes | None], carry: list[bytes] | None = None) -> dict:
    raw = b"".join(t or b"" for t in texts)
    lens = np.fromiter((-1 if t is None else len(t) for t in texts), np.int64, len(texts))
    return {"block": block, "n_docs": len(texts), "n_bytes": len(raw), "ids": np.asarray(ids, np.int64).tobytes(),
            "lens": lens.tobytes(), "text": pa.compress(raw, codec=_CODEC, asbytes=True),
            "carry": b"\n".join(carry) if carry is not None else None}


class Block:
    """An unpacked block: ids (int64, null as NULL_ID), texts (bytes), null flags."""

    def __init__(self, row: dict):
        self.id = row["block"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        lens = np.frombuffer(row["lens"], np.int64)
        raw = pa.decompress(row["text"], decompressed_size=row["n_bytes"], codec=_CODEC, asbytes=True) if row["n_bytes"] else b""
        self.null = lens < 0
        ends = np.cumsum(np.maximum(lens, 0))
        starts = ends - np.maximum(lens, 0)
        self.carry = row["carry"].split(b"\n") if row.get("carry") is not None else None
        self.texts = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def ids_of(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False)


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=np.asarray(ids) == NULL_ID)


def pack_documents(docs: DataFrame, id_col: str, text_col: str, name: str, block_bytes: int = BLOCK_BYTES,
                   carry: Column | None = None) -> str:
    """Write the documents as blocks below the shared checkpoint folder; returns the path.

    ``carry`` is a string without line breaks (such as ``to_json`` of other columns) kept with each document.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, f"{name}-blocks")
    with_carry = carry is not None
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                      (carry if with_carry else F.lit("")).alias("carry"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        drop_caches()
        base, n = TaskContext.get().partitionId() << 32, 0
        ids: list[int] = []
        texts: list[bytes | None] = []
        more: list[bytes] = []
        held = 0

        def block() -> pa.RecordBatch:
            return batch_of(BLOCK_SCHEMA, [pack(base + n, np.array(ids, np.int64), texts, more if with_carry else None)])

        for b in batches:
            cols = ids_of(b.column(0)).tolist(), *(b.column(k).cast(pa.large_binary()).to_pylist() for k in (1, 2))
            for i, t, c in zip(*cols, strict=True):
                ids.append(i)
                texts.append(t)
                more.append(c or b"")
                held += len(t or b"") + 1
                if held >= block_bytes:
                    yield block()
                    ids, texts, more, held, n = [], [], [], 0, n + 1
        if ids:
            yield block()

    src.mapInArrow(run, BLOCK_SCHEMA).write.options(**_PARQUET).parquet(path)
    return path


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string(),
          "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary()),
          "array<string>": pa.list_(pa.string())}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (x.strip().split(" ", 1) for x in ddl.split(","))])


def batch_of(ddl: str, rows: list[dict]) -> pa.RecordBatch:
    """Rows as a batch of the given schema; a field that a row lacks is null."""
    return pa.RecordBatch.from_pylist(rows, schema=arrow_schema(ddl))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of batches one by one, so that only one unpacked row is held."""
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(k)[i].as_py() for k, n in enumerate(b.schema.names)}
    trim()


def trim() -> None:
    """Give memory that is free back to the system: workers are reused, and idle ones stay beside those at work."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        give = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
        if give is not None:
            give(0)


def total(df: DataFrame, column: str) -> int:
    return int(df.agg(F.sum(column)).first()[0] or 0)


def release(spark: SparkSession, *paths: str) -> None:
    """Delete folders below the checkpoint folder that no later pass reads."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> tuple[DataFrame, str]:
    """Write a pass to the shared checkpoint folder and read it back: later passes do not recompute it.

    The shuffle files of the pass are dropped as soon as it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = (df.write.partitionBy(partition_by) if partition_by else df.write).options(**_PARQUET)
    schema = df.schema
    during = {_CLEANUP: "true", _BATCH: str(BATCH_BYTES)}
    before = {k: spark.conf.get(k, None) for k in during}
    for k, v in during.items():
        spark.conf.set(k, v)
    try:
        w.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(schema).parquet(path), path


def bounded_batches(spark: SparkSession) -> None:
    """Passes that the caller of a query runs hold as little of their input at once as those of :func:`stage`."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def pieces(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into runs (from, to) of about ``limit`` bytes, to bound what a worker unpacks at once."""
    a, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) + 1
        if held >= limit:
            yield a, i + 1
            a, held = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def texts_of(column: pa.Array) -> list[bytes]:
    """The column's strings in UTF-8; a null is an empty text."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def keep_rows(docs: DataFrame, text_col: str, keep: Callable[[], Callable[[list[bytes]], np.ndarray]]) -> DataFrame:
    """The rows (all columns, unchanged) whose text passes; ``keep()`` makes the test once per task."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        test = keep()
        for b in batches:
            texts = texts_of(b.column(at).cast(pa.string()))
            ok = [test(texts[i:j]) for i, j in pieces(texts, PIECE_BYTES)]
            if ok:
                yield b.filter(pa.array(np.concatenate(ok)))
        trim()

    return docs.mapInArrow(run, docs.schema)


# ------------------------------------------------------------------ exchange

ASK_SCHEMA = "shard int, block long, keys binary, more binary"


def shard_bits(keys: float, per_shard: int = SHARD_KEYS) -> int:
    return max(0, math.ceil(math.log2(max(1.0, keys / per_shard))))


def split_shards(sorted_keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of sorted 64-bit keys; a shard is the keys' leading ``bits``."""
    if not len(sorted_keys):
        return
    if bits == 0:
        yield 0, 0, len(sorted_keys)
        return
    top = (sorted_keys >> U64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(top)) + 1
    edges = np.concatenate(([0], cut, [len(top)]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(top[a]), a, b


def cells_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """The 32-bit count-min cell of a key within its shard."""
    return ((keys << U64(bits)) >> U64(32)).astype(np.uint32)


# A partition's sketch is sparse: the cells it saw once, and those it saw more
# often, per shard of the cell space.  The width is 2**(32 + bits) counters, so
# it grows with the input and the share of false alarms stays the same.

def sketch_rows(block: int, keys: np.ndarray, bits: int) -> list[dict]:
    """A block's count-min sketch of its keys, cut into shards."""
    # a key's shard and cell together are its leading bits: one pass over all shards, as blocks x shards grow with the square of the input
    low = U64(max(0, 32 - bits))
    every, n = np.unique(keys >> low, return_counts=True)
    every, many = every << low, n >= 2
    cells, top = cells_of(every, bits), np.concatenate(([0], np.cumsum(many))).tolist()
    once, more = cells[~many].tobytes(), cells[many].tobytes()
    return [{"shard": shard, "block": block, "keys": once[4 * (a - top[a]):4 * (b - top[b])], "more": more[4 * top[a]:4 * top[b]]}
            for shard, a, b in split_shards(every, bits)]


def repeated_cells(asks: DataFrame) -> DataFrame:
    """Merge the sketches of all blocks; per block, the cells whose count is two or more.

    Cells that a block itself counted twice are not sent back to it.
    """

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_pylist()
        once = [np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]
        more = [np.frombuffer(x, np.uint32) for x in table.column("more").to_pylist()]
        cells, counts = np.unique(np.concatenate(once + more + more), return_counts=True)
        heavy = cells[counts > 1]
        size = np.array([len(x) for x in once])
        mine = np.concatenate(once)
        hit = member(heavy, mine)
        end = np.concatenate(([0], np.cumsum(hit)))[np.cumsum(size)].tolist()
        said = mine[hit].tobytes()
        out = [{"shard": key[0].as_py(), "block": b, "keys": said[4 * i:4 * j]} for b, i, j in zip(blocks, [0, *end[:-1]], end, strict=True) if i < j]
        return pa.Table.from_pylist(out, schema=arrow_schema("shard int, block long, keys binary"))

    return asks.groupBy("shard").applyInArrow(merge, "shard int, block long, keys binary")


def flagged(keys: np.ndarray, answers: list[dict], bits: int) -> np.ndarray:
    """Mask of a block's keys whose estimated count over all blocks is two or more."""
    order = np.argsort(keys)
    s = keys[order]
    low = U64(max(0, 32 - bits))
    at = s >> low  # shard and cell
    answers = sorted(answers, key=lambda a: a["shard"])
    said = np.frombuffer(b"".join(a["keys"] for a in answers), np.uint32).astype(U64)
    shard = np.repeat(np.array([a["shard"] for a in answers], U64), np.array([len(a["keys"]) // 4 for a in answers], np.int64))
    mask = member(shard << U64(32) | said, at)
    again = at[1:] == at[:-1]
    mask[1:] |= again
    mask[:-1] |= again
    out = np.empty(len(keys), bool)
    out[order] = mask
    return out


def with_answers(blocks: DataFrame, answers: DataFrame, cols: list[str]) -> DataFrame:
    """Blocks with the answers to their questions (at most one per shard) as an array of structs."""
    a = answers.groupBy("block").agg(F.collect_list(F.struct(*cols)).alias("answers"))
    return blocks.join(a, "block", "left")


def ranges(n: np.ndarray) -> np.ndarray:
    """0..n[0]-1, 0..n[1]-1, ... in one array."""
    n = np.asarray(n, np.int64)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
