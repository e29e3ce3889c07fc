"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and texts taken as unlabelled (U) train several linear
classifiers in numpy.  With class prior p the risk is
``p E_P[l(+)] + max(0, E_U[l(-)] - p E_P[l(-)])``: the toxic share hidden in U is
taken out of its loss, and when a batch makes that difference negative the step goes
the other way, so that the model cannot overfit by pushing it below zero.

A text's features are its distinct words (runs of letters, A-Z lowered) and the words'
first 4, 5 and 6 bytes, hashed; a feature is used if it occurs in at least ``least`` P
texts and far more often there than in U (by a ratio and by standard deviations).
Scoring covers whole texts.

Training uses at most ``max_positive`` and ``max_unlabelled`` texts, those with the
smallest hash of their id.  The prior is the share of toxic rows among the labels
used, unless given.

Nulls and edge cases: null and empty texts score like any text, from the bias alone;
rows with a null id are scored and never train; several labels of an id count as toxic
if one is; without any confirmed toxic text the model scores every text 0; repeated
rows are each scored; other columns are ignored (or kept, by :func:`reject_toxic`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.llm import core

BITS = 20
PREFIXES = (4, 5, 6)
MAX_POSITIVE = 4_000
MAX_UNLABELLED = 12_000
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` modulo ``folds``; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text: (feature, text), sorted by text."""
    raw = core.lower_ascii(b"\n".join(texts) + b"\n")
    buf = np.frombuffer(raw, np.uint8)
    letter = _LETTER[buf]
    change = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    if len(letter) and letter[0]:
        change = np.concatenate(([0], change))
    start, end = change[0::2], change[1::2]
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    text = np.searchsorted(np.cumsum(lens + 1), start, side="right")
    h = core.byte_hash(buf)
    shift = core.U64(64 - BITS)
    found = [(text << BITS) | (h.of(start, end) >> shift).astype(np.int64)]
    for k in PREFIXES:
        long = end - start > k
        found.append((text[long] << BITS) | (core.mix64(h.of(start[long], start[long] + k)) >> shift).astype(np.int64))
    keys = np.unique(np.concatenate(found))
    return (keys & ((1 << BITS) - 1)).astype(np.int32), keys >> BITS


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        f, text = features(texts)
        z = np.bincount(text, weights=self.weights[f], minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _sample(docs: DataFrame, ids: DataFrame, limit: int) -> list[np.ndarray]:
    """Features of the ``limit`` documents of ``ids`` whose ids hash smallest."""
    chosen = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core.drop_caches()
        for b in batches:
            texts = core.texts_of(b.column(1))
            for i, j in core.pieces(texts, core.PIECE_BYTES):
                f, text = features(texts[i:j])
                cut = np.searchsorted(text, np.arange(j - i + 1))
                yield core.batch_of("doc_id long, f binary", [
                    {"doc_id": d, "f": f[cut[k]:cut[k + 1]].tobytes()} for k, d in enumerate(b.column(0).to_pylist()[i:j])])
        core.trim()

    rows = docs.join(F.broadcast(chosen), "doc_id").mapInArrow(run, "doc_id long, f binary").collect()
    return [np.frombuffer(r.f, np.int32) for r in sorted(rows, key=lambda r: (r.doc_id, bytes(r.f)))]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          train_on: Column | None = None, prior: float | None = None, max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED, least: int = 3, models: int = 3) -> Model:
    """Train on the texts whose ids satisfy ``train_on`` (over a column ``doc_id``; default all)."""
    core.bounded_batches(docs.sparkSession)
    ok = F.col("doc_id").isNotNull() & (F.lit(True) if train_on is None else train_on)
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).where(ok)
    marks = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].alias("y")).where(ok & F.col("y").isNotNull()) \
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    if prior is None:
        prior = float(marks.agg(F.avg("y")).first()[0] or 0.0)
    toxic = marks.where("y = 1").select("doc_id")
    pos = _sample(src, src.select("doc_id").join(toxic, "doc_id", "left_semi"), max_positive)
    unl = _sample(src, src.select("doc_id").join(toxic, "doc_id", "left_anti"), max_unlabelled)
    fitted = [_fit(pos, unl, prior, least, seed) for seed in range(models)]
    return Model(np.mean([m.weights for m in fitted], axis=0).astype(np.float32), float(np.mean([m.bias for m in fitted])))


def _fit(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, least: int, seed: int,
         ratio: float = 2.5, deviations: float = 5.0, epochs: int = 30, batch: int = 512, rate: float = 0.1,
         decay: float = 1e-4) -> Model:
    n = 1 << BITS
    if not pos or prior <= 0:
        return Model(np.zeros(n, np.float32), -50.0)
    in_pos = np.bincount(np.concatenate(pos), minlength=n)
    by_chance = (np.bincount(np.concatenate(unl), minlength=n) if unl else np.zeros(n)) * (len(pos) / max(1, len(unl)))
    often = (in_pos >= least) & (in_pos >= ratio * by_chance) & (in_pos - by_chance >= deviations * np.sqrt(by_chance + 0.5))
    name = np.cumsum(often) - 1
    pos, unl = ([name[x[often[x]]] for x in part] for part in (pos, unl))
    rng = np.random.default_rng(seed)
    k = int(often.sum())
    w, m, v, step = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1), 0

    def risk(rows: list[np.ndarray], sign: int) -> tuple[float, np.ndarray]:
        """Mean logistic loss as class ``sign``, and its gradient; the last weight is the bias."""
        which = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        f = np.concatenate(rows) if len(which) else np.empty(0, np.int64)
        z = sign * (np.bincount(which, weights=w[f], minlength=len(rows)) + w[k])
        slope = -sign / (1 + np.exp(np.clip(z, -500, 500))) / len(rows)
        g = np.bincount(f, weights=slope[which], minlength=k + 1)
        g[k] = slope.sum()
        return float(np.logaddexp(0, -z).mean()), g

    w[k] = np.log(prior / (1 - prior)) if prior < 1 else 0.0
    for _ in range(epochs):
        order = rng.permutation(len(unl)) if unl else np.zeros(1, int)
        for a in range(0, len(order), batch):
            p = [pos[i] for i in rng.choice(len(pos), min(batch, len(pos)), replace=False)]
            u = [unl[i] for i in order[a:a + batch]] if unl else []
            _, as_pos = risk(p, 1)
            p_neg, p_neg_g = risk(p, -1)
            u_neg, u_neg_g = risk(u, -1) if u else (0.0, np.zeros(k + 1))
            hidden = u_neg_g - prior * p_neg_g
            g = prior * as_pos + hidden if u_neg - prior * p_neg >= 0 else -hidden
            g[:k] += decay * w[:k]
            step += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    out = np.zeros(n, np.float32)
    out[often] = w[:k]
    return Model(out, float(w[k]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` (0 to 1) of every row."""
    core.bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core.drop_caches()
        for b in batches:
            texts = core.texts_of(b.column(1))
            for i, j in core.pieces(texts, core.PIECE_BYTES):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(sent.value.score(texts[i:j]))],
                                                 schema=core.arrow_schema("doc_id long, score double"))
        core.trim()

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double")


def reject_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows (all columns) that score below the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return core.keep_rows(docs, text_col, lambda: lambda texts: sent.value.score(texts) < threshold)
