"""Language identification by a bidirectional gated recurrent network over bytes.

Segments are runs of letter bytes (A-Z lowered, bytes from 0x80 on) cut at
``SEGMENT`` bytes.  A forward and a backward GRU read a segment's bytes; a softmax on
both states labels every byte position with a distribution over the learned
languages, and a document's distribution is the mean over all its positions.  The
network is trained in numpy by backpropagation through time, on the most frequent
segments of each language (all of a language with few) of a bounded sample of labelled
documents, with their observed language shares as targets.  States start anew at each segment, so a segment that occurs many
times among the texts in hand is labelled once and counted as often as it occurs.

Nulls and edge cases: a null text, or one without any letter, is ``und`` with score 0;
rows with a null language or id do not train; a null id is scored; without training
data every text is ``und``; repeated rows are each scored; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.llm import core

SEGMENT = 24
HIDDEN = 16
DOCS_PER_LANGUAGE = 1_500
SEGMENTS = 30_000
#: Segments a language may bring, however many languages there are.
SEGMENTS_PER_LANGUAGE = 5_000
OUT = "doc_id long, lang_pred string, score double"
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ANY_LETTER = regex.compile(r"\p{L}")


def segments(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes buffer, start, length, text) of every segment."""
    buf = np.frombuffer(core.lower_ascii(b"\n".join(texts) + b"\n"), np.uint8)
    letter = _LETTER[buf]
    change = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    if len(letter) and letter[0]:
        change = np.concatenate(([0], change))
    start, end = change[0::2], change[1::2]
    n = -(-(end - start) // SEGMENT)
    start = np.repeat(start, n) + SEGMENT * core.ranges(n)
    length = np.minimum(np.repeat(end, n) - start, SEGMENT)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    return buf, start, length, np.searchsorted(np.cumsum(lens + 1), start, side="right")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class BiGru:
    """Two GRUs and a softmax at each position; all sequences of a batch have one length."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p: dict[str, np.ndarray] = {"o": rng.normal(0, 0.3, (2 * hidden, classes)), "ob": np.zeros(classes)}
        for d in "fb":
            self.p[d + "x"] = rng.normal(0, 0.3, (256, 3 * hidden))  # the byte's row: update, reset, candidate
            self.p[d + "u"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 2 * hidden))
            self.p[d + "c"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, hidden))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _read(self, d: str, x: np.ndarray) -> tuple[np.ndarray, list]:
        n, steps, h = *x.shape, self.h
        state = np.zeros((n, h), np.float32)
        out, kept = np.empty((n, steps, h), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = self.p[d + "x"][x[:, t]]
            g = _sigmoid(a[:, :2 * h] + state @ self.p[d + "u"])
            z, r = g[:, :h], g[:, h:]
            c = np.tanh(a[:, 2 * h:] + (r * state) @ self.p[d + "c"])
            kept.append((t, state, z, r, c))
            state = c + z * (state - c)
            out[:, t] = state
        return out, kept

    def label(self, x: np.ndarray) -> np.ndarray:
        """Distribution at every position: sequences x positions x classes."""
        s = np.concatenate((self._read("f", x)[0], self._read("b", x)[0]), axis=2)
        return _softmax(s @ self.p["o"] + self.p["ob"])

    def gradients(self, x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted cross entropy of all positions against the sequence's target, and its gradients through time."""
        n, steps, h = *x.shape, self.h
        sides = {d: self._read(d, x) for d in "fb"}
        s = np.concatenate((sides["f"][0], sides["b"][0]), axis=2)
        p = _softmax(s @ self.p["o"] + self.p["ob"])
        w = (weight / (weight.sum() * steps)).astype(np.float32)[:, None, None]
        loss = float(-(w * target[:, None] * np.log(p + 1e-9)).sum())
        dy = w * (p - target[:, None])
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["o"] = s.reshape(-1, 2 * h).T @ dy.reshape(-1, dy.shape[2])
        grad["ob"] = dy.sum(axis=(0, 1))
        ds = dy @ self.p["o"].T
        for d, part in (("f", ds[:, :, :h]), ("b", ds[:, :, h:])):
            back = np.zeros((n, h), np.float32)
            for t, state, z, r, c in reversed(sides[d][1]):
                back = back + part[:, t]
                dc = back * (1 - z) * (1 - c * c)
                dz = back * (state - c) * z * (1 - z)
                drs = dc @ self.p[d + "c"].T
                dr = drs * state * r * (1 - r)
                dg = np.concatenate((dz, dr), axis=1)
                grad[d + "c"] += (r * state).T @ dc
                grad[d + "u"] += state.T @ dg
                np.add.at(grad[d + "x"], x[:, t], np.concatenate((dg, dc), axis=1))
                back = back * z + drs * r + dg @ self.p[d + "u"].T
        return loss, grad

    def fit(self, words: list[bytes], target: np.ndarray, weight: np.ndarray, epochs: int = 16, batch: int = 256, rate: float = 0.01) -> None:
        rng = np.random.default_rng(1)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        length = np.array([len(w) for w in words])
        groups = {n: np.flatnonzero(length == n) for n in np.unique(length).tolist()}
        data = {n: np.frombuffer(b"".join([words[i] for i in g]), np.uint8).reshape(-1, n) for n, g in groups.items()}
        step = 0
        for e in range(epochs):
            parts = [(n, part) for n, g in groups.items() for part in np.array_split(rng.permutation(len(g)), -(-len(g) // batch))]
            for k in rng.permutation(len(parts)).tolist():
                n, part = parts[k]
                rows = groups[n][part]
                _, grad = self.gradients(data[n][part], target[rows], weight[rows])
                step += 1
                lr = rate * (0.1 if e >= epochs * 3 // 4 else 1)
                for q, g in grad.items():
                    m[q] += 0.1 * (g - m[q])
                    v[q] += 0.01 * (g * g - v[q])
                    self.p[q] -= (lr * (m[q] / (1 - 0.9 ** step)) / (np.sqrt(v[q] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    net: BiGru | None

    def pool(self, texts: list[bytes]) -> np.ndarray:
        """Mean distribution over all positions of each text (zeros without a position)."""
        out = np.zeros((len(texts), len(self.languages)))
        buf, start, length, text = segments(texts)
        if not len(start) or self.net is None:
            return out
        _, first, of = np.unique(core.byte_hash(buf).of(start, start + length), return_index=True, return_inverse=True)
        total = np.zeros((len(first), len(self.languages)), np.float32)
        size = length[first]
        for n in np.unique(size).tolist():
            rows = np.flatnonzero(size == n)
            for part in np.array_split(rows, -(-len(rows) // 8192)):
                total[part] = self.net.label(buf[start[first[part]][:, None] + np.arange(n)]).sum(axis=1)
        positions = np.bincount(text, weights=length, minlength=len(texts))
        for c in range(out.shape[1]):
            out[:, c] = np.bincount(text, weights=total[of, c], minlength=len(texts)) / np.maximum(positions, 1)
        return out


def quotas(have: list[int], total: int) -> list[int]:
    """How many segments each language brings: equal parts of ``total``; what one lacks goes to the others."""
    out, left = [0] * len(have), max(total, SEGMENTS_PER_LANGUAGE * len(have) if total >= SEGMENTS_PER_LANGUAGE else total)
    for k, i in enumerate(sorted(range(len(have)), key=have.__getitem__)):
        out[i] = min(have[i], -(-left // (len(have) - k)))
        left -= out[i]
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_on: Column | None = None, docs_per_language: int = DOCS_PER_LANGUAGE, max_segments: int = SEGMENTS) -> Model:
    """Fit on at most ``docs_per_language`` documents of each language (smallest id hash) among ``train_on``."""
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), docs[lang_col].alias("lang")) \
        .where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    src = src if train_on is None else src.where(train_on)
    languages = sorted(r.lang for r in src.select("lang").distinct().collect())
    chosen = None
    for lang in languages:
        ids = src.where(F.col("lang") == lang).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(docs_per_language)
        chosen = ids if chosen is None else chosen.union(ids)
    if chosen is None:
        return Model([], None)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, langs = core.texts_of(b.column(0)), b.column(1).to_pylist()
            seen: dict[tuple[str, bytes], int] = {}
            for i, j in core.pieces(texts):
                buf, start, length, text = segments(texts[i:j])
                raw = buf.tobytes()
                for s, n, t in zip(start.tolist(), length.tolist(), text.tolist(), strict=True):
                    k = langs[i + t], raw[s:s + n]
                    seen[k] = seen.get(k, 0) + 1
            yield core.batch_of("lang string, seg binary, n long", [{"lang": k[0], "seg": k[1], "n": n} for k, n in seen.items()])

    counts = src.join(F.broadcast(chosen.distinct()), "doc_id").select("text", "lang").mapInArrow(count, "lang string, seg binary, n long")
    names = [f"n{c}" for c in range(len(languages))]
    shares = counts.groupBy("seg").pivot("lang", languages).agg(F.sum("n")).fillna(0).toDF("seg", *names)
    shares, path = core.stage(shares, "langid-segments")
    have = shares.agg(*[F.count_if(F.col(x) > 0).alias(x) for x in names]).first()
    found: dict[bytes, list[int]] = {}
    for x, quota in zip(names, quotas([have[x] for x in names], max_segments), strict=True):
        for r in shares.where(F.col(x) > 0).orderBy(F.desc(x), "seg").limit(quota).collect():
            found[bytes(r.seg)] = [r[y] for y in names]
    core.release(docs.sparkSession, path)
    if not found:
        return Model(languages, None)
    words = sorted(found)
    n = np.array([found[x] for x in words], np.float64)
    per_language = n / np.maximum(n.sum(axis=0), 1)
    target = (per_language / per_language.sum(axis=1, keepdims=True)).astype(np.float32)
    net = BiGru(len(languages))
    net.fit(words, target, np.sqrt(n.sum(axis=1)))
    return Model(languages, net)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            texts, strings = core.texts_of(b.column(1)), b.column(1).to_pylist()
            for i, j in core.pieces(texts):
                p = m.pool(texts[i:j])
                best = p.argmax(axis=1) if p.shape[1] else np.zeros(j - i, int)
                rows = []
                for k in range(j - i):
                    known = p.shape[1] and p[k, best[k]] > 0 and _ANY_LETTER.search(strings[i + k] or "")
                    rows.append((m.languages[best[k]], min(1.0, float(p[k, best[k]]))) if known else ("und", 0.0))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array([r[0] for r in rows], pa.string()),
                                                  pa.array([r[1] for r in rows], pa.float64())], schema=core.arrow_schema(OUT))

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, OUT)
