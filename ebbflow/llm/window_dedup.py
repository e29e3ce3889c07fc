"""Substring dedup: repeated word windows found by a count-min prefilter.

Pass 1 sketches every block's windows (:func:`core.sketch_rows`) and merges the
sketches per shard of the cell space; merged counts only ever overestimate, so a
window that is repeated anywhere is flagged everywhere.  Pass 2 groups exactly,
by 96-bit keys of the word sequences, only the windows flagged: per key the
smallest document id.  Pass 3 marks the words of windows that also start in a
document with a smaller id.  Documents without a flagged window are final after
pass 2.

Nulls and edge cases: a null text has no words; a null id sorts after all ids
and comes back null; rows that share an id do not remove each other's words;
documents of fewer words than a window keep everything; an empty table gives an
empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.llm import core

OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
MID = f"kind string, block long, n_docs long, n_bytes long, ids binary, lens binary, text binary, carry binary, said binary, {OUT}"
ASK = "shard int, block long, keys binary, more binary, base long, low binary, several binary"
ANSWER = "shard int, block long, keys binary, more binary, low binary"


def _keys(w: core.Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """96-bit keys (64 and 32 bits) of all windows, and their first words."""
    a, at = w.windows(width)
    b, _ = w.windows(width, which=1)
    return a, (b >> core.U64(32)).astype(np.uint32), at


def _result(kept_text: bool) -> str:
    return OUT + (", text string, carry string" if kept_text else "")


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13,
                            kept_text: bool = False, block_bytes: int = core.BLOCK_BYTES,
                            shard_keys: int = core.SHARD_KEYS, carry: Column | None = None) -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed, kept_sha256``.

    ``kept_text`` adds ``text`` (the kept words, or the whole text where nothing was removed) and ``carry``,
    the string given for the row.
    """
    spark = docs.sparkSession
    bits, mid_path = _flagged_documents(docs, id_col, text_col, width, kept_text, block_bytes, shard_keys, carry)
    mid = spark.read.schema(_mid(kept_text)).parquet(mid_path)
    held = mid.where("kind = 'hold'").select("block", "n_docs", "n_bytes", "ids", "lens", "text", "carry", "said")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in core.rows_of(batches):
            yield core.batch_of(ASK, _ask(core.Block(row), np.frombuffer(row["said"], np.uint8), bits, width))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in core.rows_of(batches):
            yield _finish(core.Block(row), row["answers"] or [], width, kept_text)

    smallest = held.mapInArrow(ask, ASK).groupBy("shard").applyInArrow(_smallest, ANSWER)
    done = mid.where("kind = 'done'").select(*[c.split()[0] for c in OUT.split(", ")], *["kept", "kept_carry"] * kept_text)
    rest = core.with_answers(held.drop("said"), smallest, ["keys", "more", "low"]).mapInArrow(finish, _result(kept_text))
    return (done.withColumnsRenamed({"kept": "text", "kept_carry": "carry"}) if kept_text else done).unionByName(rest)


def _mid(kept_text: bool) -> str:
    return MID + (", kept string, kept_carry string" if kept_text else "")


def _flagged_documents(docs, id_col, text_col, width, kept_text, block_bytes, shard_keys, carry) -> tuple[int, str]:
    """Passes 1 and 2a: the documents' blocks without, and (with the flags) with, windows estimated repeated."""
    spark = docs.sparkSession
    blocks_path = core.pack_documents(docs, id_col, text_col, "windows", block_bytes, carry)
    blocks = spark.read.schema(core.BLOCK_SCHEMA).parquet(blocks_path)
    bits = core.shard_bits(core.total(blocks, "n_bytes") / 6, shard_keys)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in core.rows_of(batches):
            b = core.Block(row)
            keys, _ = core.Words(b.texts).windows(width)
            yield core.batch_of(core.ASK_SCHEMA, core.sketch_rows(b.id, keys, bits))

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in core.rows_of(batches):
            yield core.batch_of(_mid(kept_text), _flag(core.Block(row), row["answers"] or [], bits, width, kept_text))

    answers = core.repeated_cells(blocks.mapInArrow(sketch, core.ASK_SCHEMA))
    flagged = core.with_answers(blocks, answers, ["shard", "keys"]).mapInArrow(flag, _mid(kept_text))
    _, mid_path = core.stage(flagged, "windows-flagged", "kind")
    core.release(spark, blocks_path)
    return bits, mid_path


def _row(b: core.Block, i: int, keep: np.ndarray | None, kept_text: bool, text: str = "text", carry: str = "carry") -> dict:
    words, doc = b.texts[i].split(), int(b.ids[i])
    kept = b" ".join(words if keep is None else compress(words, keep.tolist()))
    n_removed = 0 if keep is None else int(len(words) - keep.sum())
    out = {"doc_id": None if doc == core.NULL_ID else doc, "n_words": len(words), "n_removed": n_removed,
           "kept_sha256": hashlib.sha256(kept).hexdigest()}
    if kept_text:
        out[text] = None if b.null[i] else (kept if n_removed else b.texts[i]).decode()
        out[carry] = b.carry[i].decode() if b.carry is not None else None
    return out


def _flag(b: core.Block, answers: list[dict], bits: int, width: int, kept_text: bool) -> list[dict]:
    """Final rows of documents without a flagged window; the others with their windows' flags."""
    w = core.Words(b.texts)
    keys, at = w.windows(width)
    hit = core.flagged(keys, answers, bits)
    pending = np.zeros(len(b.texts), bool)
    pending[w.doc[at[hit]]] = True
    out = [_row(b, i, None, kept_text, "kept", "kept_carry") | {"kind": "done"}
           for i in np.flatnonzero(~pending).tolist()]
    which = np.flatnonzero(pending)
    if len(which):
        said = np.packbits(hit[pending[w.doc[at]]]).tobytes()
        out.append(core.pack(b.id, b.ids[which], [b.texts[i] for i in which], b.carry and [b.carry[i] for i in which]) | {"kind": "hold", "said": said})
    return out


def _ask(b: core.Block, said: np.ndarray, bits: int, width: int) -> list[dict]:
    """The flagged windows' distinct keys, each with the block's smallest id and whether it has several."""
    w = core.Words(b.texts)
    a, c, at = _keys(w, width)
    hit = np.unpackbits(said, count=len(a)).astype(bool)
    a, c, ids = a[hit], c[hit], b.ids[w.doc[at[hit]]]
    order = np.lexsort((ids, c, a))
    a, c, ids = a[order], c[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1]))))
    last = np.concatenate((first[1:], [len(a)])) - 1
    a, c, low, several = a[first], c[first], ids[first], ids[first] != ids[last]
    base = int(low.min())
    low = low - base
    low = low.astype(np.uint32) if low.max() < 1 << 32 else low
    return [{"shard": s, "block": b.id, "keys": a[i:j].tobytes(), "more": c[i:j].tobytes(), "base": base,
             "low": low[i:j].tobytes(), "several": np.packbits(several[i:j]).tobytes()}
            for s, i, j in core.split_shards(a, bits)]


def _smallest(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Per block and key, the smallest id over all blocks, where the key has more than one id."""
    rows = table.to_pylist()
    keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
    a, c = np.concatenate(keys), np.concatenate([np.frombuffer(r["more"], np.uint32) for r in rows])
    low = np.concatenate([np.frombuffer(r["low"], np.uint32 if len(r["low"]) == 4 * len(k) else np.int64).astype(np.int64) + r["base"]
                          for r, k in zip(rows, keys, strict=True)])
    several = np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(k)) for r, k in zip(rows, keys, strict=True)])
    order = np.lexsort((c, a))
    new = np.concatenate(([True], (np.diff(a[order]) != 0) | (np.diff(c[order]) != 0)))
    first = np.flatnonzero(new)
    group = np.empty(len(a), np.int64)
    group[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(low[order], first)
    several = (np.maximum.reduceat(several[order], first) > 0) | (least < np.maximum.reduceat(low[order], first))
    out, i = [], 0
    for r, mine in zip(rows, keys, strict=True):
        j = i + len(mine)
        g = group[i:j]
        m = several[g]
        if m.any():
            out.append({"shard": key[0].as_py(), "block": r["block"], "keys": a[i:j][m].tobytes(),
                        "more": c[i:j][m].tobytes(), "low": least[g[m]].tobytes()})
        i = j
    return pa.Table.from_pylist(out, schema=core.arrow_schema(ANSWER))


def _finish(b: core.Block, answers: list[dict], width: int, kept_text: bool) -> pa.RecordBatch:
    w = core.Words(b.texts)
    a, c, at = _keys(w, width)
    gone = np.zeros(len(a), bool)
    if answers:
        ka, kc, low = (np.concatenate([np.frombuffer(x[n], t) for x in answers])
                       for n, t in (("keys", np.uint64), ("more", np.uint32), ("low", np.int64)))
        # equal leading 64 bits are rare: the pairs are then looked up one by one
        order = np.lexsort((kc, ka))
        ka, kc, low = ka[order], kc[order], low[order]
        where = {k: v for k, v in zip(zip(ka.tolist(), kc.tolist(), strict=True), low.tolist(), strict=True)} \
            if (ka[1:] == ka[:-1]).any() else None
        if where is None:
            i = np.searchsorted(ka, a)
            i[i == len(ka)] = 0
            gone = (ka[i] == a) & (kc[i] == c) & (low[i] < b.ids[w.doc[at]])
        else:
            mine = b.ids[w.doc[at]].tolist()
            gone = np.array([where.get(k, core.NULL_ID) < m for k, m in zip(zip(a.tolist(), c.tolist(), strict=True), mine, strict=True)], bool)
    removed = core.covered(at[gone], width, len(w.start))
    rows = [_row(b, i, ~removed[w.first[i]:w.first[i + 1]], kept_text)
            for i in range(len(b.texts))]
    return core.batch_of(_result(kept_text), rows)


def cut_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """The rows (all columns) without the repeated words; rows that lose all their words go, others keep their text as it is."""
    others = [c for c in docs.columns if c != text_col]
    kind = docs.select(*others).schema
    whole = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}  # JSON cuts to milliseconds by itself
    out = remove_repeated_windows(docs, id_col, text_col, width, kept_text=True, carry=F.to_json(F.struct(*[docs[c] for c in others]), whole))
    row = F.from_json("carry", kind, whole)
    return out.where("n_removed = 0 OR n_removed < n_words") \
        .select(*[(F.col("text") if c == text_col else row[c]).alias(c) for c in docs.columns])
