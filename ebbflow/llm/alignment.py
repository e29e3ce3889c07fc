"""Alignment of two tokenizers' tokens over the same text, and how often each pair of tokens meets.

Tokenizer A is a byte-level BPE of the tokenizers library and reads a space and the text; B is a sentencepiece
model, which adds that space itself.

*Spans.*  A's and B's offsets say where tokens end, in characters and in their bytes.  They
serve as coarse cuts: where a character is shared by several tokens (a multibyte character
split by A, a byte-fallback run of B), the ends inside it come from the tokens' own decoded bytes.  So
every token has a byte range.  Where A and B both end a token, a group ends.  Tokens of A and B link where their byte ranges
overlap.

*Units.*  A text is cut before each blank that has a character other than a blank before it and an
ordinary character after it.  A's pattern always starts a token there, and no piece of B's vocabulary holds a
word start behind another character (checked when the model is loaded), so both tokenizers do the same on a
unit alone as within its text, and a group never crosses.  Each distinct unit of a block is tokenised and aligned once.

*Counts.*  A block sends its distinct pairs with their counts to the shards of the B ids (one binary cell for a block and
shard).  A shard adds up its cells, slice by slice, and tells each block its pairs' corpus-wide counts and
which of them are the highest of their B id.  One B id has at most as many pairs as A has ids, so a shard's totals are
bounded by the vocabularies.

Nulls and edge cases: a null or empty text, and one whose joined A or B bytes are not the space and the text (such as one that
holds U+2581), has no tokens: all its numbers are 0 and its digest is the empty string.  Strings of special tokens
inside texts are plain text.  Rows that share an id or a text are counted each; a null id comes back null; an empty table
gives an empty result; other columns are ignored.  A very long text is held whole with its units (about 12 bytes a
unit); a single unit (a run without blanks) goes to the tokenizers whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm import core

OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
#: A block's documents, its units' links (as places in ``pairs``), and the distinct pairs with their counts.
_HELD = "block long, ids binary, bad binary, docs binary, units binary, sums binary, links binary, first binary, digests binary, pairs binary, counts binary"
_ASK = "shard int, slice int, block long, pairs binary, counts binary"
_TOTAL = "shard int, pairs binary, counts binary"
_ANSWER = "block long, shard int, totals binary, best binary"
BLOCK_BYTES = 8 << 20
#: Bytes of units that go to a tokenizer in one call.
BATCH = 1 << 16
#: Blocks that are answered together.
SLICE = 512

_BLANK = 0x20
#: What comes after a token of a group: one of its side, the other side, the next group, nothing.
_AFTER = (b",", b"|", b";", b"")
#: Bytes that may follow the blank before which a text is cut: no white space begins with them.
_FOLLOWS = np.zeros(256, bool)
_FOLLOWS[0x21:0x7F] = True
_FOLLOWS[0x80:] = True
_FOLLOWS[[0xC2, 0xE1, 0xE2, 0xE3]] = False


def _letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        vocab = self.a.get_vocab()
        letters = _letters()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        #: what a digest shows of a token, by 4 * id and what comes after it
        self.names = np.array([b"%d%s" % (i, c) for i in range(max(len(self.a_bytes), len(pieces))) for c in _AFTER], object)
        made = json.loads(self.a.to_str())
        split = made["pre_tokenizer"] or {}
        #: Whether texts may be cut into units.
        self.cuts = made["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") \
            and not split.get("add_prefix_space") and not any("▁" in p.lstrip("▁") for p in pieces)

    def spans(self, text: str) -> tuple[np.ndarray, ...] | None:
        """(A ids, A byte ends, B ids, B byte ends) of a text that starts with a blank; None if either's bytes are not the text."""
        raw = text.encode()
        e = self.a.encode(text, add_special_tokens=False)
        a = np.array(e.ids, np.int64)
        if b"".join([self.a_bytes[i] for i in a.tolist()]) != raw:
            return None
        found = self.b.encode(raw[1:], return_type="offset_mapping")
        b = np.array(found["ids"], np.int64)
        if b"".join([self.b_bytes[i] for i in b.tolist()]) != raw:
            return None
        # A's offsets count characters of the text with its blank, B's bytes of the text without
        offsets = np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        if len(raw) > len(text):
            leads = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
            offsets = np.concatenate((leads, [len(raw)]))[offsets]
        theirs = np.fromiter(chain.from_iterable(found["offsets"]), np.int64, 2 * len(b)).reshape(-1, 2) + 1
        theirs[:1, 0] = 0  # the blank is the first token's
        return a, refine(offsets, self.a_len[a]), b, refine(theirs, self.b_len[b])


def refine(span: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Token ends in bytes from (begin, end) spans that may cover a shared character, and the tokens' own lengths.

    A span's end counts where the next token begins behind it.  Where a character is shared by several tokens their ends
    are counted back, by decoded bytes, from the next end that counts.
    """
    if not len(span):
        return np.empty(0, np.int64)
    begin, end = span[:, 0], span[:, 1]
    cut = np.concatenate(((end[1:] > end[:-1]) & (begin[1:] >= end[:-1]) & (end[:-1] > begin[:-1]), [True]))
    total = np.cumsum(lens)
    anchor = np.flatnonzero(cut)[np.cumsum(cut) - cut]
    return end[anchor] - (total[anchor] - total)


def cut_units(texts: list[bytes], cuts: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts of the units, starts of the texts) of the texts with a blank before each, joined."""
    raw = b" " + b" ".join(texts) if texts else b""
    buf = np.frombuffer(raw, np.uint8)
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    begins = np.zeros(len(buf) + 1, bool)
    if cuts and len(buf) > 2:
        begins[1:-2] = (buf[1:-1] == _BLANK) & (buf[:-2] != _BLANK) & _FOLLOWS[buf[2:]]
    begins[first] = True
    return buf, np.flatnonzero(begins[:-1]), first[:-1]


class Units:
    """Distinct units, aligned: digest strings, sums and links (unit by unit) of each."""

    def __init__(self, units: list[bytes], aligner: Aligner):
        n = len(units)
        self.ok = np.ones(n, bool)
        self.sums = np.zeros((n, 4), np.int64)  # A tokens, B tokens, groups, links
        self.groups: list[bytes] = [b""] * n
        self._found: list[tuple[np.ndarray, np.ndarray]] = []
        for some in _batches(units):
            self._align(aligner, units, some)
        links, of = (np.concatenate(x) for x in zip(*self._found, strict=True)) if self._found else (np.empty(0, np.int64),) * 2
        self.links = links[np.argsort(of, kind="stable")]

    def _align(self, aligner: Aligner, units: list[bytes], some: list[int]) -> None:
        got = aligner.spans(b"".join([units[i] for i in some]).decode())
        if got is None:
            if len(some) > 1:
                for i in some:
                    self._align(aligner, units, [i])
            else:
                self.ok[some[0]] = False
            return
        a, a_end, b, b_end = got
        ends = np.cumsum([len(units[i]) for i in some])
        both = a_end[core.member(b_end, a_end)]
        # links: a B token overlaps the A tokens from the one that holds its first byte to the one that holds its last
        lo = np.searchsorted(a_end, np.concatenate(([0], b_end[:-1])), side="right")
        hi = np.searchsorted(a_end, b_end, side="left")
        many = hi - lo + 1
        key = (np.repeat(b, many) << 20) | a[np.repeat(lo, many) + core.ranges(many)]
        # what lies in which unit
        cuts = [np.searchsorted(x, ends, side="right") for x in (a_end, b_end, both)]
        cuts.append(np.concatenate(([0], np.cumsum(many)))[cuts[1]])
        self.sums[some] = np.diff(np.column_stack(cuts), axis=0, prepend=0)
        self._found.append((key, np.repeat(some, self.sums[some, 3])))
        x, y = (np.searchsorted(e, both, side="right") for e in (a_end, b_end))
        g = cuts[2]
        shown = _shown(a, b, a_end, b_end, both, x, y, g[np.diff(g, prepend=0) > 0] - 1)
        text = aligner.names[shown].tolist()
        edges = np.concatenate(([0], x + y))[g].tolist()
        for u, i, j in zip(some, [0, *edges[:-1]], edges, strict=True):
            self.groups[u] = b"".join(text[i:j])


def _shown(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray, both: np.ndarray, x: np.ndarray, y: np.ndarray,
           last: np.ndarray) -> np.ndarray:
    """The tokens group by group, A's before B's, each as its place in ``Aligner.names``; ``x``, ``y``: tokens up to each group, ``last``: groups that end a unit."""
    n, m = int(x[-1]), int(y[-1])
    out = np.empty(n + m, np.int64)
    after = np.zeros(n, np.int64)
    after[x - 1] = 1
    out[np.arange(n) + np.concatenate(([0], y))[np.searchsorted(both, a_end[:n])]] = 4 * a[:n] + after
    after = np.zeros(m, np.int64)
    after[y - 1] = 2
    after[y[last] - 1] = 3
    out[np.arange(m) + x[np.searchsorted(both, b_end[:m])]] = 4 * b[:m] + after
    return out


def _batches(units: list[bytes]) -> Iterator[list[int]]:
    """Units that are tokenised in one call: none but the first may begin, and none but the last end, with two blanks in a row."""
    some, held = [], 0
    for i, u in enumerate(units):
        plain = len(u) > 1 and _FOLLOWS[u[1]] and u[-1] != _BLANK and not u.endswith(b"\xe2\x96\x81")
        if not plain:
            yield [i]
            continue
        some.append(i)
        held += len(u)
        if held >= BATCH:
            yield some
            some, held = [], 0
    if some:
        yield some


def _digests(doc_of: np.ndarray, unit: np.ndarray, groups: list[bytes], n: int) -> bytes:
    """SHA-256 (32 bytes) of each document's groups."""
    edges = np.searchsorted(doc_of, np.arange(n + 1)).tolist()
    codes = unit.tolist()
    return b"".join([hashlib.sha256(b";".join([groups[c] for c in codes[x:y]])).digest() for x, y in zip(edges[:-1], edges[1:], strict=True)])


def hold(block: int, ids: np.ndarray, texts: list[bytes], aligner: Aligner) -> dict:
    """Everything about a block but the corpus-wide counts."""
    buf, start, first = cut_units(texts, aligner.cuts)
    lens = np.diff(np.concatenate((start, [len(buf)])))
    code, distinct = core.factorize(buf, np.ones(len(buf), bool), lens)
    doc = np.searchsorted(first, start, side="right") - 1
    units = Units(distinct, aligner)
    bad = np.fromiter((not t for t in texts), bool, len(texts))
    bad[doc[~units.ok[code]]] = True
    good = ~bad[doc]
    doc, code = doc[good], code[good]
    times = np.bincount(code, minlength=len(distinct))
    pairs, links = np.unique(units.links, return_inverse=True)
    counts = np.bincount(links, weights=np.repeat(times, units.sums[:, 3]), minlength=len(pairs)).astype(np.int64)
    pack = lambda x: pa.compress(x, codec="zstd", asbytes=True) if len(x) else b""
    return {"block": block, "ids": ids.tobytes(), "bad": bad.tobytes(), "docs": np.bincount(doc, minlength=len(texts)).astype(np.int64).tobytes(),
            "units": pack(code.astype(np.uint32).tobytes()), "sums": pack(units.sums.astype(np.uint32).tobytes()),
            "links": pack(links.astype(np.uint32).tobytes()), "first": np.array([len(code), len(units.sums), len(links)], np.int64).tobytes(),
            "digests": _digests(doc, code, units.groups, len(texts)), "pairs": pairs.tobytes(), "counts": counts.tobytes()}


def ask(r: dict, bits: int, slices: int) -> list[dict]:
    """A block's pairs that occur, by the shard of their B id."""
    pairs, counts = np.frombuffer(r["pairs"], np.int64), np.frombuffer(r["counts"], np.int64)
    shard = _shard(pairs, bits)
    order = np.argsort(shard, kind="stable")
    edges = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1)) if len(order) else []
    return [{"shard": int(shard[order[x]]), "slice": r["block"] % slices, "block": r["block"], "pairs": pairs[order[x:y]].tobytes(),
             "counts": counts[order[x:y]].tobytes()} for x, y in zip(edges[:-1], edges[1:], strict=True)]


def _shard(pairs: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(len(pairs), np.int64)
    return (core.mix64((pairs >> 20).astype(np.uint64) + core.U64(1)) >> core.U64(64 - bits)).astype(np.int64)


def _add(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    rows = table.select(["pairs", "counts"]).to_pylist()
    pairs, counts = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in ("pairs", "counts"))
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    return pairs[first], np.add.reduceat(counts[order], first)


def total(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One cell for a shard (and slice), with the pairs' counts added up."""
    pairs, counts = _add(table)
    return pa.Table.from_pylist([{"shard": key[0].as_py(), "pairs": pairs.tobytes(), "counts": counts.tobytes()}], schema=core.arrow_schema(_TOTAL))


def answer(asks: pa.Table, totals: pa.Table) -> pa.Table:
    """Per block, its pairs' counts over all blocks, and whether each is the highest of its B id."""
    out = []
    if asks.num_rows:
        pairs, counts = _add(totals)
        b = pairs >> 20
        first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
        most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.concatenate((first, [len(b)]))))
        best = counts == most
        for r in asks.select(["shard", "block", "pairs"]).to_pylist():
            at = np.searchsorted(pairs, np.frombuffer(r["pairs"], np.int64))
            out.append({"block": r["block"], "shard": r["shard"], "totals": counts[at].tobytes(), "best": np.packbits(best[at]).tobytes()})
    return pa.Table.from_pylist(out, schema=core.arrow_schema(_ANSWER))


def finish(r: dict, bits: int) -> pa.RecordBatch:
    """The documents' rows of a block and its answers."""
    n_units, n_distinct, n_links = np.frombuffer(r["first"], np.int64).tolist()
    unpack = lambda x, n: np.frombuffer(pa.decompress(x, decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b"", np.uint32)
    code, sums, links = unpack(r["units"], n_units), unpack(r["sums"], 4 * n_distinct).reshape(-1, 4).astype(np.int64), unpack(r["links"], n_links)
    ids, bad, per_doc = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["bad"], bool), np.frombuffer(r["docs"], np.int64)
    pairs = np.frombuffer(r["pairs"], np.int64)
    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    order = np.argsort(_shard(pairs, bits), kind="stable")
    said = sorted(r["answers"] or [], key=lambda x: x["shard"])
    if said:
        count[order] = np.concatenate([np.frombuffer(x["totals"], np.int64) for x in said])
        best[order] = np.concatenate([np.unpackbits(np.frombuffer(x["best"], np.uint8), count=len(x["totals"]) // 8) for x in said])
    of = np.repeat(np.arange(n_distinct), sums[:, 3])
    per_unit = np.column_stack((sums, _sum(best[links], of, n_distinct), _sum(count[links], of, n_distinct)))
    doc = np.repeat(np.arange(len(ids)), per_doc)
    rows = np.column_stack([_sum(per_unit[code, k], doc, len(ids)) for k in range(6)])
    digest = [("" if x else r["digests"][32 * i:32 * i + 32].hex()) for i, x in enumerate(bad.tolist())]
    return pa.RecordBatch.from_arrays([core.id_array(ids), *(pa.array(rows[:, k]) for k in range(6)), pa.array(digest, pa.string())],
                                      schema=core.arrow_schema(OUT))


def _sum(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Sums in whole numbers of runs of a sorted ``group``."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    edges = np.searchsorted(group, np.arange(n + 1))
    return total[edges[1:]] - total[edges[:-1]]


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = BLOCK_BYTES, shard_keys: int = core.SHARD_KEYS, slice_blocks: int = SLICE) -> DataFrame:
    """Per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    spark = docs.sparkSession
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = Aligner(a_path, b_path)
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            ids, texts = core.ids_of(b.column(0)), core.texts_of(b.column(1))
            for x, y in core.pieces(texts, block_bytes):
                yield core.batch_of(_HELD, [hold(block, ids[x:y], texts[x:y], aligner)])
                block += 1

    blocks, path = core.stage(src.mapInArrow(held, _HELD), "alignment")
    sizes = blocks.agg(F.count("*").alias("n"), F.sum(F.octet_length("pairs")).alias("b")).first()
    bits = core.shard_bits((sizes.b or 0) / 8, shard_keys)
    slices = max(1, -(-sizes.n // slice_blocks))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in core.rows_of(batches):
            yield core.batch_of(_ASK, ask(r, bits, slices))

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in core.rows_of(batches):
            yield finish(r, bits)

    asks = blocks.select("block", "pairs", "counts").mapInArrow(asked, _ASK)
    totals = asks.groupBy("shard", "slice").applyInArrow(total, _TOTAL).groupBy("shard").applyInArrow(total, _TOTAL) \
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    said = asks.groupBy("shard", "slice").cogroup(totals.groupBy("shard", "slice")).applyInArrow(answer, _ANSWER)
    return core.with_answers(blocks.drop("counts"), said, ["shard", "totals", "best"]).mapInArrow(done, OUT)
