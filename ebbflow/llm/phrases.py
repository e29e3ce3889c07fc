"""Phrase collocations by Toivonen mining, exact over all documents.

1. *Sample.*  A hashed share of the documents counts all its phrases of 1 to 4 words per language; those
   that reach a lowered threshold are the proposal.
2. *Full pass.*  Every document counts, besides its words, each phrase whose two parts (without
   its last and without its first word) are proposed: that is the proposal and its negative border, the smallest
   phrases not proposed.  Counts are merged per shard of the key space, so they are exact.
3. *Closing.*  A counted phrase that is frequent but was not proposed is a border failure.  It joins the
   proposal, and another pass counts the phrases this newly admits.  When no failure is left, every frequent phrase has been
   counted, as all its parts are frequent and proposed.
4. *Texts.*  The sample, and a pass for phrases it does not hold, give the words of the frequent phrases; cuts, scores, containment and
   ranks are then joins and aggregates over the frequent phrases alone.

The proposal travels to the tasks as a bitmap over leading key bits, of at most 2**27 bits (16 MB) whatever its size:
a phrase that shares a bit is counted without need, which costs work but changes no result.  Phrases are keyed by 96
bits made of the words' 128-bit hashes and the language.

Words are lower-cased (A-Z) runs outside blanks and tabs within pieces, which end at ``[.,;:!?\\n\\x0b\\x0c\\r]``.

Nulls and edge cases: a null text is empty, a null language is ``und`` (and shares its counts with a language of that
name); rows that share an id or a text all count; a very long text is cut at piece ends, so only a
single piece is held whole (about 50 times its size); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbflow.llm import core

LONGEST = 4
#: Share of the documents that propose, and what of the expected count in the sample a proposal must have.
SAMPLE_SHARE = 0.125
LOWERED = 0.6
MAX_BITS = 27
CHUNK = 4 << 20

_CLASS = np.zeros(256, np.uint8)
_CLASS[[ord(c) for c in " \t"]] = 1
_CLASS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2

#: Rows of a counting pass: keys of one shard with their counts, or (lang, words) of a language.
_COUNTS = "shard int, keys binary, more binary, counts binary, lang string, words long"
#: ``fresh`` holds the bitmap places of the keys that were not proposed.
_FREQUENT = "shard int, keys binary, more binary, counts binary, fresh binary, lang string, words long"
_CELLS = "shard int, n int, keys binary, more binary, lang binary, langs string, texts binary"
_RESOLVED = "shard int, keys binary, more binary, counts binary, lang array<string>, phrase array<string>, n array<long>, f array<long>"


class Chunk:
    """The words of some documents and the keys of their phrases."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        raw = core.lower_ascii(b"\n".join(texts) + b"\n")
        buf = np.frombuffer(raw, np.uint8)
        kind = _CLASS[buf]
        inside = kind == 0
        change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            change = np.concatenate(([0], change))
        start, end = change[0::2], change[1::2]
        self.codes, words = core.factorize(buf, inside, end - start)
        piece = np.cumsum(kind == 2, dtype=np.int32)
        self.piece = piece[start]
        lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        doc = np.searchsorted(np.cumsum(lens), start, side="right")
        self.langs = sorted(set(langs))
        number = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.fromiter((number[x] for x in langs), np.int32, len(langs))[doc]
        self.words = words
        hashes = core.strong_hashes(words)
        lang_hashes = core.strong_hashes([x.encode() for x in self.langs])
        self.ranges = [core.RangeHash(hashes[:, which][self.codes], which) for which in range(2)]
        self.lang_hash = [np.ascontiguousarray(lang_hashes[:, which]) for which in range(2)]

    def starts(self, n: int) -> np.ndarray:
        """The first words of all phrases of ``n`` words."""
        last = max(0, len(self.codes) - n + 1)
        return np.flatnonzero(self.piece[:last] == self.piece[n - 1:][:last])

    def keys(self, at: np.ndarray, n: int, which: int = 0) -> np.ndarray:
        """64-bit keys of the phrases of ``n`` words that start at ``at``; the two kinds together make 128 bits."""
        return core.mix64(self.ranges[which].of(at, at + n) ^ self.lang_hash[which][self.lang[at]])

    def more(self, at: np.ndarray, n: int) -> np.ndarray:
        return (self.keys(at, n, 1) >> core.U64(32)).astype(np.uint32)


@dataclass
class Bitmap:
    """A set of 64-bit keys by their leading ``bits`` bits; it may hold more than was put in, never less."""

    bits: int
    packed: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> core.U64(64 - self.bits)
        return (self.packed[(at >> core.U64(3)).astype(np.int64)] >> (at & core.U64(7)).astype(np.uint8)) & 1 > 0

    def add(self, at: np.ndarray) -> None:
        at = at.astype(np.int64)
        np.bitwise_or.at(self.packed, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))


def admitted(chunk: Chunk, now: Bitmap, before: Bitmap | None, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The keys of the phrases that ``now`` admits and ``before`` did not: words always, longer ones by their two parts."""
    at = chunk.starts(1)
    k0 = chunk.keys(at, 1)
    if before is None:
        yield k0, chunk.more(at, 1)
    for n in range(2, longest + 1):
        ok, old = (np.zeros(len(chunk.codes) + 1, np.uint8) for _ in range(2))
        ok[at] = now.has(k0)
        if before is not None:
            old[at] = before.has(k0) & (True if n == 2 else counted)
        at = chunk.starts(n)
        at = at[(ok[at] & ok[at + 1]) > 0]
        k0 = chunk.keys(at, n)
        if before is None:
            yield k0, chunk.more(at, n)
        else:
            counted = (old[at] & old[at + 1]) > 0
            yield k0[~counted], chunk.more(at[~counted], n)


def _counted(parts: list[tuple[np.ndarray, ...]], bits: int) -> list[dict]:
    k0, k1 = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.argsort(k0)
    k0, k1 = k0[order], k1[order]
    # of equal 64-bit keys a run of equal 32-bit keys counts as one; the shard adds up the runs
    first = np.flatnonzero(np.concatenate(([True], (k0[1:] != k0[:-1]) | (k1[1:] != k1[:-1])))) if len(k0) else np.empty(0, np.int64)
    counts = np.diff(np.concatenate((first, [len(k0)])))
    k0, k1 = k0[first], k1[first]
    out = []
    for s, a, b in core.split_shards(k0, bits):
        n = counts[a:b]
        out.append({"shard": s, "keys": k0[a:b].tobytes(), "more": k1[a:b].tobytes(),
                    "counts": n.astype(np.uint8 if n.max() < 256 else np.uint32).tobytes()})
    return out


def _counts(r: dict) -> np.ndarray:
    n = len(r["more"]) // 4
    return np.frombuffer(r["counts"], {1: np.uint8, 4: np.uint32, 8: np.int64}[len(r["counts"]) // n]).astype(np.int64)


def _merge(least: int, sent: Broadcast, bits: int):
    """Per shard, the keys that occur at least ``least`` times; ``fresh`` are the bitmap places of those the proposal lacks."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        if shard < 0:
            words = table.select(["lang", "words"]).group_by("lang").aggregate([("words", "sum")])
            return pa.Table.from_pylist([{"shard": shard, "lang": r["lang"], "words": r["words_sum"]} for r in words.to_pylist()],
                                        schema=core.arrow_schema(_FREQUENT))
        rows = table.select(["keys", "more", "counts"]).to_pylist()
        k0 = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
        k1 = np.concatenate([np.frombuffer(r["more"], np.uint32) for r in rows])
        n = np.concatenate([_counts(r) for r in rows])
        del rows
        order = np.argsort(k0)
        if ((k0[order][1:] == k0[order][:-1]) & (k1[order][1:] != k1[order][:-1])).any():
            order = np.lexsort((k1, k0))
        k0, k1 = k0[order], k1[order]
        first = np.flatnonzero(np.concatenate(([True], (k0[1:] != k0[:-1]) | (k1[1:] != k1[:-1]))))
        n = np.add.reduceat(n[order], first)
        some = n >= least
        k0, k1, n = k0[first][some], k1[first][some], n[some]
        if not len(k0):
            return core.arrow_schema(_FREQUENT).empty_table()
        now = sent.value[0]
        missing = k0 if now is None else k0[~now.has(k0)]
        places = np.unique(missing >> core.U64(64 - bits)).astype(np.uint32)
        return pa.Table.from_pylist([{"shard": shard, "keys": k0.tobytes(), "more": k1.tobytes(), "counts": n.tobytes(),
                                      "fresh": zlib.compress(np.diff(places, prepend=np.uint32(0)).tobytes(), 1)}],
                                    schema=core.arrow_schema(_FREQUENT))

    return run


def _parts(text: bytes, limit: int) -> list[bytes]:
    """A long text cut behind piece ends, into parts of about ``limit`` bytes."""
    if len(text) <= limit:
        return [text]
    ends = np.flatnonzero(_CLASS[np.frombuffer(text, np.uint8)] == 2) + 1
    cuts, a = [0], 0
    while len(text) - a > limit:
        i = np.searchsorted(ends, a + limit)
        if i == len(ends):
            break
        a = int(ends[i])
        cuts.append(a)
    return [text[x:y] for x, y in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[Chunk]:
    """The documents (text, lang) of batches, some MB at a time."""
    texts: list[bytes] = []
    langs: list[str] = []
    held = 0
    for b in batches:
        for i in range(0, b.num_rows, 256):
            some = b.slice(i, 256)
            for t, lang in zip(core.texts_of(some.column(0)), some.column(1).to_pylist(), strict=True):
                for part in _parts(t, limit):
                    texts.append(part)
                    langs.append(lang)
                    held += len(part) + 1
                    if held >= limit:
                        made, texts, langs, held = Chunk(texts, langs), [], [], 0
                        yield made
    if texts:
        yield Chunk(texts, langs)


def _places(rows: list) -> Iterator[np.ndarray]:
    for r in rows:
        yield np.cumsum(np.frombuffer(zlib.decompress(r.fresh), np.uint32), dtype=np.uint32)


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", least: int = 30,
         longest: int = LONGEST, sample_share: float = SAMPLE_SHARE, max_bits: int = MAX_BITS, chunk: int = CHUNK,
         shard_keys: int = core.SHARD_KEYS) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words that occur at least ``least`` times in a language.

    Returns ``lang, phrase, n, f`` (phrase space-joined, n its words) and ``lang, words`` (all word occurrences).
    """
    spark = docs.sparkSession
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit("und"))
    src = docs.select(docs[text_col].cast("string").alias("text"), lang.alias("lang"),
                      F.xxhash64(docs[id_col], docs[text_col]).alias("h")).where("text IS NOT NULL")
    size = core.total(src.select(F.octet_length("text").alias("b")), "b")
    shards = core.shard_bits(size / 6, shard_keys)
    bits = max(shards, min(max_bits, max(16, math.ceil(math.log2(size / 8 + 1)))))

    def counting(sent: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, before = sent.value
            for c in _chunks(batches, chunk):
                if now is None:
                    keys = [(c.keys(at, n), c.more(at, n)) for n in range(1, longest + 1) for at in [c.starts(n)]]
                else:
                    keys = list(admitted(c, now, before, longest))
                rows = _counted(keys, shards)
                if now is not None and before is None:
                    rows += [{"shard": -1 - zlib.crc32(x.encode()) % 64, "lang": x, "words": int(n)}
                             for x, n in zip(c.langs, np.bincount(c.lang, minlength=len(c.langs)), strict=True)]
                if rows:
                    yield core.batch_of(_COUNTS, rows)

        return run

    def counted(docs: DataFrame, least: int, now: Bitmap | None, before: Bitmap | None, name: str) -> DataFrame:
        sent = spark.sparkContext.broadcast((now, before))
        rows = docs.select("text", "lang").mapInArrow(counting(sent), _COUNTS)
        out = core.stage(rows.groupBy("shard").applyInArrow(_merge(least, sent, bits), _FREQUENT), name)[0]
        sent.destroy()  # else Python workers keep every pass's bitmaps
        return out

    top = 1 << 32
    sampled = src.where(F.pmod("h", F.lit(top)) < int(sample_share * top))
    lowered = max(2, math.floor(LOWERED * least * sample_share))
    now, before, passes = Bitmap(bits, np.zeros(max(1, (1 << bits) // 8), np.uint8)), None, []
    found = counted(sampled, lowered, None, None, "phrases-sample")
    while True:
        fresh = found.where("fresh IS NOT NULL").select("fresh").toLocalIterator()
        grown = Bitmap(bits, now.packed.copy())
        n = 0
        for at in _places(fresh):
            grown.add(at)
            n += len(at)
        if passes and not n:
            break
        before = now if passes else None
        now = grown
        found = counted(src, least, now, before, "phrases-counted")
        passes.append(found)
    frequent = passes[0]
    for p in passes[1:]:
        frequent = frequent.unionByName(p)
    words = frequent.where("shard < 0").select("lang", "words")
    phrases = frequent.where("shard >= 0").select("shard", "keys", "more", "counts")
    # nearly all frequent phrases occur in the sample too; the others' words come from all documents
    known = _texts(spark, sampled, phrases, shards, bits, longest, chunk)
    rest = known.where("keys IS NOT NULL").select("shard", "keys", "more", "counts")
    others = _texts(spark, src, rest, shards, bits, longest, chunk)
    texts = known.where("keys IS NULL").unionByName(others.where("keys IS NULL"))
    return texts.select(F.explode(F.arrays_zip("lang", "phrase", "n", "f")).alias("x")).select("x.lang", "x.phrase", "x.n", "x.f"), words


def _texts(spark: SparkSession, src: DataFrame, frequent: DataFrame, shards: int, bits: int, longest: int, chunk: int) -> DataFrame:
    """Rows with the words of the frequent phrases that ``src`` holds, and a row with the other keys, for each shard.

    A task sends each phrase once (again after two million others), in one cell for a shard.
    """
    places = _key_places(bits)
    wanted = Bitmap(bits, np.zeros(max(1, (1 << bits) // 8), np.uint8))
    for at in _places(frequent.select("keys").mapInArrow(places, "fresh binary").toLocalIterator()):
        wanted.add(at)
    sent = spark.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.empty(0, np.uint64)
        for c in _chunks(batches, chunk):
            for n in range(1, longest + 1):
                at = c.starts(n)
                key = c.keys(at, n)
                ok = sent.value.has(key)
                key, first = np.unique(key[ok], return_index=True)
                new = ~core.member(seen, key)
                key, at = key[new], at[ok][first[new]]
                seen = np.sort(np.concatenate((seen, key))) if len(seen) < 1 << 21 else key
                columns = [[c.words[x] for x in c.codes[at + j].tolist()] for j in range(n)]
                texts = list(map(b" ".join, zip(*columns, strict=True)))
                more, lang = c.more(at, n), c.lang[at].astype(np.uint16)
                names = "\n".join(x.replace("\\", "\\\\").replace("\n", "\\n") for x in c.langs)
                rows = [{"shard": s, "n": n, "keys": key[i:j].tobytes(), "more": more[i:j].tobytes(), "lang": lang[i:j].tobytes(),
                         "langs": names, "texts": zlib.compress(b"\n".join(texts[i:j]), 1)} for s, i, j in core.split_shards(key, shards)]
                if rows:
                    yield core.batch_of(_CELLS, rows)

    def resolve(wanted: pa.Table, cells: pa.Table) -> pa.Table:
        rows = wanted.to_pylist()
        if not rows:
            return core.arrow_schema(_RESOLVED).empty_table()
        k0 = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
        k1 = np.concatenate([np.frombuffer(r["more"], np.uint32) for r in rows])
        f = np.concatenate([_counts(r) for r in rows])
        where = dict(zip(zip(k0.tolist(), k1.tolist(), strict=True), range(len(k0)), strict=True))
        found: dict[int, tuple[str, str, int]] = {}
        for r in cells.to_pylist():
            langs = [x.replace("\\n", "\n").replace("\\\\", "\\") for x in r["langs"].split("\n")]
            keys = zip(np.frombuffer(r["keys"], np.uint64).tolist(), np.frombuffer(r["more"], np.uint32).tolist(), strict=True)
            for key, x, text in zip(keys, np.frombuffer(r["lang"], np.uint16).tolist(), zlib.decompress(r["texts"]).split(b"\n"), strict=True):
                i = where.get(key)
                if i is not None and i not in found:
                    found[i] = langs[x], text.decode(), r["n"]
        shard = rows[0]["shard"]
        at = np.fromiter(found, np.int64, len(found))
        lost = np.ones(len(k0), bool)
        lost[at] = False
        out = []
        if len(at):
            lang, phrase, n = map(list, zip(*found.values(), strict=True))
            out.append({"shard": shard, "lang": lang, "phrase": phrase, "n": n, "f": f[at].tolist()})
        if lost.any():
            out.append({"shard": shard, "keys": k0[lost].tobytes(), "more": k1[lost].tobytes(), "counts": f[lost].tobytes()})
        return pa.Table.from_pylist(out, schema=core.arrow_schema(_RESOLVED))

    cells = src.select("text", "lang").mapInArrow(run, _CELLS)
    out = core.stage(frequent.groupBy("shard").cogroup(cells.groupBy("shard")).applyInArrow(resolve, _RESOLVED), "phrases-texts")[0]
    sent.destroy()
    return out


def _key_places(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in core.rows_of(batches):
            at = np.unique(np.frombuffer(r["keys"], np.uint64) >> core.U64(64 - bits)).astype(np.uint32)
            yield core.batch_of("fresh binary", [{"fresh": zlib.compress(np.diff(at, prepend=np.uint32(0)).tobytes(), 1)}])

    return run


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, cover_percent: int = 80, **options) -> DataFrame:
    """Each language's ``top`` phrases of two or more words by their weakest cut.

    Returns ``lang, rank, phrase, a, l, r, n, score``.  A candidate is dropped if a longer candidate holds its words
    in a row and occurs in at least ``cover_percent`` of its count.
    """
    phrases, words = mine(docs, least=least, **options)
    part = lambda w, a, b: F.array_join(F.slice(w, a, b), " ")
    cand = phrases.where("n >= 2").select("lang", "phrase", F.col("f").alias("a"), "n", F.split("phrase", " ").alias("w"))
    cuts = cand.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"), "w", "n") \
        .select("lang", "phrase", "a", "k", part("w", F.lit(1), F.col("k")).alias("left_part"),
                part("w", F.col("k") + 1, F.col("n") - F.col("k")).alias("right_part"))
    counts = lambda c, n: phrases.select("lang", F.col("phrase").alias(c), F.col("f").alias(n))
    cuts = cuts.join(counts("left_part", "l"), ["lang", "left_part"]).join(counts("right_part", "r"), ["lang", "right_part"])
    exact = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div CAST(l + r AS DECIMAL(20,0))")
    best = cuts.withColumn("score", exact.cast("long")).groupBy("lang", "phrase") \
        .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")
    inner = cand.where("n > 2").select("lang", "a", "w", "n", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("m")) \
        .select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("m") + 1)).alias("at")) \
        .groupBy("lang", part("w", F.col("at"), F.col("m")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        f"longer IS NULL OR CAST(100 AS DECIMAL(3,0)) * CAST(longer AS DECIMAL(19,0)) < {cover_percent} * CAST(a AS DECIMAL(19,0))")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's candidates are ranked in 64 groups first, so that a large language is not one task
    some = kept.withColumn("_g", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = some.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_g").orderBy(*order))).where(F.col("_r") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    total = words.groupBy("lang").agg(F.sum("words").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
