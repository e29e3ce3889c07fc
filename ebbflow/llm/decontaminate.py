"""Benchmark decontamination by spaced seeds.

A seed mask takes some of the words at fixed offsets of a span and ignores the
others, so a substituted word spoils only the masks that look at it.  The masks of an
overlap's length are such that every set of substitutions the rule accepts leaves one of
them whole (:func:`masks_of` proves it by enumeration), so no accepted overlap goes
without a seed.  Seeds of the
benchmark items are joined with the seeds of every position of the training texts;
around each hit the two texts are aligned on the hit's diagonal, and an overlap
counts if ``overlap`` words in a row (the whole item, if it is shorter) agree in at
least ``agree`` of their places.

The benchmark is sent to the tasks in slices of at most ``slice_words`` words: one
slice in the usual case, one pass over the texts per slice for a larger one.

Words are compared with A-Z lowered and ASCII punctuation taken off their ends.
Nulls and edge cases: a null or empty text or item has no seeds and no overlap; items
under ``least`` words are not searched (1 searches all, as the query and the pipeline do); a null id comes back null; repeated rows are each
reported; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm import core

#: 1: the word counts, 0: it is ignored; a mask survives substitutions at its 0 places.
#: At 75 % these hit every accepted overlap of 9 to 13 words.
MASKS = ("111011", "110100011", "1001111", "111000101", "110111")
#: Lighter masks, tried in turn for lengths that those before do not cover.
_LIGHTER = (("11011", "1111", "1100011"), ("111", "1101", "1011"))
_PATTERNS = 20_000
_HITS = 1 << 20
OUT = "doc_id long, item_id long, overlap_words long, equal_words long, doc_word long, item_word long"
SLICE_WORDS = 1 << 20
#: Items under so many words need an exact overlap to remove a document.
SHORT = 9
_PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _normal(text: bytes) -> bytes:
    """Words in lower case without punctuation at their ends, one space apart; words of punctuation only vanish."""
    return b" ".join(filter(None, [w.strip(_PUNCT) for w in core.lower_ascii(text).split()]))


def masks_of(words: int, missing: int) -> tuple[str, ...]:
    """Masks of which one at least, somewhere in ``words`` words, avoids any ``missing`` of the words."""
    if math.comb(words, missing) <= _PATTERNS:
        for group in (MASKS, *_LIGHTER):
            fit = tuple(m for m in group if len(m) <= words)
            seen = [sum(1 << (a + k) for k, c in enumerate(m) if c == "1") for m in fit for a in range(words - len(m) + 1)]
            if all(any(not x & lost for x in seen) for lost in (sum(1 << k for k in c) for c in combinations(range(words), missing))):
                return fit
    return ("1" * max(1, words // (missing + 1)),)  # of missing + 1 runs of words one is whole


def _seeds(h: np.ndarray, doc: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the mask at every place where its span lies in one document."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[len(mask) - 1:])
    out = np.full(len(at), len(mask), np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            out = core.mix64(out * core.U64(0x9E3779B97F4A7C15) + h[at + k])
    return out, at


class Slice:
    """Seeds and words of some benchmark items."""

    def __init__(self, items: list[tuple[int, bytes]], overlap: int, agree: float, least: int):
        self.overlap, self.agree = overlap, agree
        self.ids = np.array([core.NULL_ID if i is None else i for i, _ in items], np.int64)
        w = core.Words([_normal(t) for _, t in items])
        self.h, self.first, self.count = w.hashes(), w.first, w.count
        need = np.minimum(w.count, overlap)
        fit: dict[str, list[int]] = {}
        for n in np.unique(need[w.count >= max(1, least)]).tolist():
            for m in masks_of(n, n - math.ceil(agree * n - 1e-9)):
                fit.setdefault(m, []).append(n)
        self.masks, self.seeds = list(fit), []
        for m, lengths in fit.items():
            k, at = _seeds(self.h, w.doc, m)
            ok = (np.isin(need, lengths) & (w.count >= least))[w.doc[at]]
            k, at = k[ok], at[ok]
            order = np.argsort(k, kind="stable")
            self.seeds.append((k[order], at[order]))
        self.item = w.doc

    def overlaps(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, item, overlap words, equal words, text word, item word): the best overlap of each pair."""
        w = core.Words([_normal(t) for t in texts])
        h = w.hashes()
        out, found, held = [np.empty((6, 0), np.int64)], [], 0
        for m, (keys, places) in zip(self.masks, self.seeds, strict=True):
            k, at = _seeds(h, w.doc, m)
            low, high = np.searchsorted(keys, k), np.searchsorted(keys, k, side="right")
            hit = np.flatnonzero(high > low)
            for part in np.split(hit, np.flatnonzero(np.diff(np.cumsum((high - low)[hit]) // _HITS)) + 1):
                n = (high - low)[part]
                p = places[np.repeat(low[part], n) + core.ranges(n)]
                found.append(np.stack((w.doc[np.repeat(at[part], n)], self.item[p], np.repeat(at[part], n) - p)))
                held += len(p)
                if held >= _HITS:
                    out.append(self._best(w, h, found))
                    found, held = [], 0
        if found:
            out.append(self._best(w, h, found))
        return tuple(self._first(np.concatenate(out, axis=1)))

    def _best(self, w: core.Words, h: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
        # one candidate per text, item and diagonal (where the item's word 0 would lie)
        cand = np.unique(np.concatenate(found, axis=1), axis=1)
        out = [np.empty((6, 0), np.int64)]
        for a in range(0, cand.shape[1], 1 << 14):
            out.append(self._verify(w, h, *cand[:, a:a + (1 << 14)]))
        return self._first(np.concatenate(out, axis=1))

    @staticmethod
    def _first(got: np.ndarray) -> np.ndarray:
        """The longest overlap of each text and item."""
        got = got[:, np.lexsort((got[5], got[4], -got[3], -got[2], got[1], got[0]))]
        best = np.ones(got.shape[1], bool)
        best[1:] = (got[0, 1:] != got[0, :-1]) | (got[1, 1:] != got[1, :-1])
        return got[:, best]

    def _verify(self, w: core.Words, h: np.ndarray, text: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        start, end = self.first[item], self.first[item + 1]
        lo = np.maximum(start, w.first[text] - diagonal)
        hi = np.minimum(end, w.first[text + 1] - diagonal)
        n = hi - lo
        which = np.repeat(np.arange(len(n)), n)
        p = np.repeat(lo, n) + core.ranges(n)
        same = np.concatenate(([0], np.cumsum(self.h[p] == h[p + diagonal[which]])))
        need = np.minimum(self.overlap, end - start)
        i = np.flatnonzero(np.repeat(n, n) - core.ranges(n) >= need[which])  # a window of `need` words fits
        good = same[i + need[which[i]]] - same[i] >= np.ceil(self.agree * need[which[i]] - 1e-9)
        i = i[good]
        if not len(i):
            return np.empty((6, 0), np.int64)
        c, first = np.unique(which[i], return_index=True)
        last = np.concatenate((first[1:], [len(i)])) - 1
        a, b = i[first], i[last] + need[c]
        return np.stack((text[c], item[c], b - a, same[b] - same[a], p[a] + diagonal[c] - w.first[text[c]], p[a] - start[c]))


def _slices(benchmark: DataFrame, id_col: str, text_col: str, slice_words: int) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark in slices of bounded size, by a hash of the item."""
    items = benchmark.select(benchmark[id_col].cast("long").alias("i"), benchmark[text_col].cast("string").alias("t")).where("t IS NOT NULL")
    words = int(items.agg(F.sum(F.size(F.split("t", r"\s+")))).first()[0] or 0)
    n = -(-words // slice_words)
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r.i, r.t.encode()) for r in part.toLocalIterator()]


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", overlap: int = 13, agree: float = 0.75,
             least: int = 9, slice_words: int = SLICE_WORDS) -> DataFrame:
    """Per document and benchmark item that overlap: the best overlap and where it starts."""
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], OUT)
    for items in _slices(benchmark, item_col, item_text_col, slice_words):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            s = Slice(items, overlap, agree, least)
            for b in batches:
                texts, ids = core.texts_of(b.column(1)), core.ids_of(b.column(0))
                for i, j in core.pieces(texts):
                    t, item, *rest = s.overlaps(texts[i:j])
                    yield pa.RecordBatch.from_arrays(
                        [core.id_array(ids[i:j][t]), core.id_array(s.ids[item]), *(pa.array(x, pa.int64()) for x in rest)],
                        schema=core.arrow_schema(OUT))

        out = out.unionByName(src.mapInArrow(run, OUT))
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text", overlap: int = 13, agree: float = 0.75, least: int = 9,
                        exact: int = 4, slice_words: int = SLICE_WORDS) -> DataFrame:
    """The documents (all their columns) that overlap with no benchmark item.

    An overlap with an item under nine words is evidence only where it equals the whole item, and the item has at least ``exact``
    words or is all the words of the document: one common word in a text does not make it a copy.
    """
    for items in _slices(benchmark, item_col, item_text_col, slice_words):

        def keep(items=items):
            s = Slice(items, overlap, agree, least)

            def test(texts: list[bytes]) -> np.ndarray:
                ok = np.ones(len(texts), bool)
                text, item, _, equal, _, _ = s.overlaps(texts)
                n = s.count[item]
                short = np.flatnonzero((n < SHORT) & (n < exact) & (equal == n))
                alone = np.array([len(_normal(texts[i]).split()) for i in text[short].tolist()], np.int64) == n[short]
                evidence = (n >= SHORT) | ((equal == n) & (n >= exact))
                evidence[short[alone]] = True
                ok[text[evidence]] = False
                return ok

            return test

        docs = core.keep_rows(docs, text_col, keep)
    return docs
