"""Byte-level BPE encoding and decoding by a prefix-sharing trie.

The distinct words (pre-tokens) of a batch go into a trie in sorted order, which is a
depth-first walk of it.  The walk keeps, for the prefix at every depth of its path, the
last token of that prefix's encoding, and each node remembers its own; the last token of a longer prefix is the one vocabulary entry that is a
suffix of it and follows the token before it as BPE would leave the two (a pair
test).  So the encoding of a shared prefix is computed once, and a
word's ids are read back along the path.  Words of up to ``WIDE`` bytes take this walk
together, depth by depth in numpy: of the sorted words, the first with a prefix stands for it.
Decoding joins the ids' bytes.

The added token's text in a document becomes its id, as the vocabulary file says.
Nulls and edge cases: a null text is an empty one (no ids); a null id comes back
null; words of any length are walked iteratively; repeated rows give repeated rows;
other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ebbflow.llm import core

# Fixed values of the byte-level format: the pre-token pattern and the printable
# stand-ins of bytes (bytes that are printable stand for themselves, the others
# follow from code point 256 on).
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
OUTPUTS = "doc_id long, n_tokens long, ids array<long>, decoded string"
#: Words a worker remembers between chunks.
MEMORY = 120_000
#: Trie nodes a worker keeps between chunks.
NODES = 300_000
#: Tested pairs a worker keeps between chunks.
PAIRS = 300_000
#: Beyond every rank.
NEVER = 1 << 62
#: Longer words are walked one by one; up to the first width, a worker walks up to CELLS / (width + 1) words at once.
NARROW, WIDE = 32, 256
CELLS = 1 << 20
#: Bytes of text that a worker cuts into words at once.
CHUNK_BYTES = 1 << 20


def vocabulary(path: str) -> bytes:
    """The tokenizer file's content; read on the driver (its size is fixed) and sent to the workers."""
    with open(path, "rb") as f:
        return f.read()


class _Lookup:
    """Values of int64 keys (none of them negative) for whole arrays of keys, ``none`` for others."""

    def __init__(self, of: dict[int, int], none: int):
        self.shift = np.uint64(64 - max(4, (4 * len(of)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values, self.none, self.last = np.full(size, -1), np.full(size, none), none, size - 1
        keys, values = np.fromiter(of.keys(), np.int64, len(of)), np.fromiter(of.values(), np.int64, len(of))
        at = self._first(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            placed = self.keys[at] == keys  # of several keys in a free slot, one stays
            self.values[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], (at[~placed] + 1) & self.last

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._first(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], self.none)
        rows = np.flatnonzero((held != keys) & (held >= 0))
        while len(rows):
            at[rows] = (at[rows] + 1) & self.last
            held = self.keys[at[rows]]
            hit = held == keys[rows]
            out[rows[hit]] = self.values[at[rows[hit]]]
            rows = rows[~hit & (held >= 0)]
        return out


class TrieEncoder:
    def __init__(self, content: bytes):
        spec = json.loads(content)
        other = [b for b in range(256) if b not in set(_PRINTABLE)]
        byte_of = {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(other)}
        model = spec["model"]
        as_bytes = {t: bytes(byte_of[c] for c in t) for t in model["vocab"]}
        self.id_of = {as_bytes[t]: i for t, i in model["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.rank = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[as_bytes[a], as_bytes[b]] = r
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.split_added = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") \
            if self.added else None
        #: a token's parts and its merge's rank (-1: a byte), and the rank of each pair of tokens that merge
        self.parts: list[tuple[int, int]] = []
        self.made: list[int] = []
        self.joined: dict[int, int] = {}
        self._merges()
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        ends: dict[bytes, set[int]] = {}
        for b in self.id_of:
            if len(b) > 2 and self.stays(self.id_of[b]):
                ends.setdefault(b[-3:], set()).add(len(b))
        #: lengths of the entries of three bytes or more that end so
        self.lengths = {k: sorted(v, reverse=True) for k, v in ends.items()}
        #: the trie: (node << 8 | byte) -> node; last[node]: last token of the prefix's encoding
        self.child: dict[int, int] = {}
        self.last = [-1]
        self.written = {i: str(i) for i in self.bytes_of}
        self.size_of = {i: len(b) for i, b in self.bytes_of.items()}
        if self.joined:
            self._arrays()
        self.spaced: dict[bytes, tuple[int, ...]] = {}
        self.known: dict[str, tuple[str, int, bytes, tuple[int, ...]]] = {}

    def _merges(self) -> None:
        """Number the merges by tokens; only where each token has one merge, after those of its parts (else the pair test merges whole tokens)."""
        n = 1 + max(self.bytes_of, default=-1)
        parts, made, joined = [(-1, -1)] * n, [-1] * n, {}
        for (a, b), r in sorted(self.rank.items(), key=lambda x: x[1]):
            x, y, z = (self.id_of.get(t, -1) for t in (a, b, a + b))
            if min(x, y, z) < 0 or made[z] >= 0 or len(a) > 1 and made[x] < 0 or len(b) > 1 and made[y] < 0:
                return
            parts[z], made[z], joined[x << 20 | y] = (x, y), r, r
        self.parts, self.made, self.joined = parts, made, joined

    def _arrays(self) -> None:
        """The merges, and a trie of the tokens that stay, read from their last byte, for whole arrays."""
        self.merged = _Lookup(self.joined, NEVER)
        self.left_of, self.right_of = np.array(self.parts).T.copy()
        self.made_at = np.array(self.made)
        self.sizes = np.array([self.size_of.get(i, 0) for i in range(len(self.made))])
        edges: dict[int, int] = {}
        token = [-1]
        for b, i in self.id_of.items():
            if self.stays(i):
                node = 0
                for c in reversed(b):
                    at = edges.setdefault(node << 8 | c, len(token))
                    if at == len(token):
                        token.append(-1)
                    node = at
                token[node] = i
        self.back, self.token_at = _Lookup(edges, -1), np.array(token)

    def plain(self, b: bytes) -> list[bytes]:
        """Merges in the order of their ranks, for the pair test's short inputs."""
        parts = [b[i:i + 1] for i in range(len(b))]
        while len(parts) > 1:
            ranks = [self.rank.get(p) for p in zip(parts, parts[1:], strict=False)]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def stays(self, token: int) -> bool:
        ok = self.alone.get(token)
        if ok is None:
            if not self.joined:
                ok = len(self.plain(self.bytes_of[token])) == 1
            elif self.made[token] < 0:
                ok = len(self.bytes_of[token]) == 1
            else:
                left, right = self.parts[token]
                ok = self.stays(left) and self.stays(right) and self.apart(left, right, self.made[token])
            self.alone[token] = ok
        return ok

    def follows(self, left: int, right: int) -> bool:
        key = left << 20 | right
        ok = self.pairs.get(key)
        if ok is None:
            ok = self.stays(left) and self.stays(right)
            if ok and self.joined:
                ok = self.apart(left, right)
            elif ok:
                a, b = self.bytes_of[left], self.bytes_of[right]
                ok = self.plain(a + b) == [a, b]
            self.pairs[key] = ok
        return ok

    def apart(self, left: int, right: int, before: int = NEVER) -> bool:
        """Whether no merge of a rank below ``before`` crosses from one token (that stays) to the next.

        Both are taken apart from their last merge back, and the pairs that met are looked up.
        """
        parts, made, joined = self.parts, self.made, self.joined
        left_end = right_end = before
        while True:
            r = joined.get(left << 20 | right, NEVER)
            if r < left_end and r <= right_end and r < before:  # of equal ranks the leftmost goes first
                return False
            x, y = made[left], made[right]
            if x < 0 and y < 0:
                return True
            if x >= y:
                left, left_end = parts[left][1], x
            if y >= x:
                right, right_end = parts[right][0], y

    def all_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`apart` of whole arrays of pairs."""
        ok = np.ones(len(left), bool)
        rows = np.arange(len(left))
        left_end = right_end = np.full(len(left), NEVER)
        while len(rows):
            r = self.merged(left << 20 | right)
            x, y = self.made_at[left], self.made_at[right]
            crossed = (r < left_end) & (r <= right_end)
            ok[rows[crossed]] = False
            go = np.flatnonzero(~crossed & ((x >= 0) | (y >= 0)))
            rows, left, right, x, y = rows[go], left[go], right[go], x[go], y[go]
            a, b = x >= y, y >= x
            left, left_end = np.where(a, self.right_of[left], left), np.where(a, x, left_end[go])
            right, right_end = np.where(b, self.left_of[right], right), np.where(b, y, right_end[go])
        return ok

    def _levels(self, words: list[bytes], width: int) -> Iterator[tuple[bytes, tuple[int, ...]]]:
        """The ids of sorted, distinct words of 1 to ``width`` bytes, all words a byte further at a time."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width)
        alike = np.zeros(len(words), np.int64)  # bytes shared with the word before
        alike[1:] = np.minimum(np.minimum(n[1:], n[:-1]), np.argmin(np.pad(raw[1:] == raw[:-1], ((0, 0), (0, 1))), axis=1))
        new = n - alike
        word = np.repeat(np.arange(len(words)), new)
        depth = 1 + alike[word] + core.ranges(new)
        at, node, found = np.arange(len(word)), np.zeros(len(word), np.int64), []
        for size in range(1, width + 1):  # the tokens that end each new prefix, short ones first
            node = self.back(node << 8 | raw[word[at], depth[at] - size])
            token = self.token_at[node]
            hit = np.flatnonzero((node >= 0) & (token >= 0))
            found.append((at[hit], np.full(len(hit), size), token[hit]))
            go = np.flatnonzero((node >= 0) & (depth[at] > size))
            if not len(go):
                break
            at, node = at[go], node[go]
        at, size, token = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(depth[at].astype(np.uint16), kind="stable")
        at, size, token = at[order], size[order], token[order]
        cut = np.searchsorted(depth[at], np.arange(1, width + 2))
        last = np.full((len(words), width + 1), -1, np.int32)
        rows = np.arange(len(words))
        for d in range(1, width + 1):
            a, b = cut[d - 1:d + 1]
            w, k, t = word[at[a:b]], size[a:b], token[a:b]
            ok = k == d
            inside = np.flatnonzero(~ok)
            ok[inside] = self.all_apart(last[w[inside], d - k[inside]].astype(np.int64), t[inside])
            last[w[ok], d] = t[ok]
            last[:, d] = last[np.maximum.accumulate(np.where(alike < d, rows, 0)), d]
        w, d, steps = rows, n, []
        while len(w):
            t = last[w, d]
            steps.append((w, t))
            d = d - self.sizes[t]
            w, d = w[d > 0], d[d > 0]
        of, ids = (np.concatenate(x[::-1]) for x in zip(*steps, strict=True))
        ids = ids[np.argsort(of, kind="stable")].tolist()
        ends = np.cumsum(np.bincount(of, minlength=len(words))).tolist()
        return zip(words, [tuple(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)], strict=True)

    def encode_words(self, words: list[bytes]) -> dict[bytes, tuple[int, ...]]:
        """The ids of every word."""
        words = sorted(set(words))
        out: dict[bytes, tuple[int, ...]] = {}
        least = 0
        for width in (NARROW, WIDE) if self.joined else ():
            some = [w for w in words if least < len(w) <= width]
            least, step = width, CELLS // (width + 1)
            for a in range(0, len(some), step):
                out.update(self._levels(some[a:a + step], max(map(len, some[a:a + step]))))
        return out | self._walk([w for w in words if len(w) > least or not w])

    def _walk(self, words: list[bytes]) -> dict[bytes, tuple[int, ...]]:
        """Insert the sorted words one by one, that is, walk the trie depth first; nodes of earlier calls are kept."""
        if len(self.last) > NODES:
            self.child, self.last = {}, [-1]
        if len(self.pairs) > PAIRS:
            self.pairs = {}
        child, state, id_of, lengths, pairs = self.child, self.last, self.id_of, self.lengths, self.pairs
        out: dict[bytes, tuple[int, ...]] = {}
        before, nodes, last = b"", [0], [-1]
        for w in words:
            d, most = 0, min(len(w), len(before))
            while d < most and w[d] == before[d]:
                d += 1
            del nodes[d + 1:], last[d + 1:]
            before, node = w, nodes[d]
            for end in range(d + 1, len(w) + 1):
                edge = node << 8 | w[end - 1]
                node = child.get(edge)
                if node is not None:
                    nodes.append(node)
                    last.append(state[node])
                    continue
                token = -1
                for n in (*lengths.get(w[end - 3:end], ()), 2, 1) if end > 2 else (2, 1) if end == 2 else (1,):
                    if n > end:
                        continue
                    t = id_of.get(w[end - n:end])
                    if t is None:
                        continue
                    if n == end:
                        ok = self.stays(t)
                    else:
                        ok = pairs.get(last[end - n] << 20 | t)
                        if ok is None:
                            ok = self.follows(last[end - n], t)
                    if ok:
                        token = t
                        break
                node = child[edge] = len(state)
                state.append(token)
                nodes.append(node)
                last.append(token)
            ids, d = [], len(w)
            while d:
                ids.append(last[d])
                d -= self.size_of[last[d]]
            out[w] = tuple(reversed(ids))
        return out

    def words(self, text: str) -> list[str]:
        """Pre-tokens; an added token's text stands alone."""
        if self.split_added is None or not any(t in text for t in self.added):
            return PATTERN.findall(text)
        out = []
        for i, part in enumerate(self.split_added.split(text)):
            if i % 2:
                out.append(part)
            else:
                out += PATTERN.findall(part)
        return out

    def learn(self, words: set[str]) -> None:
        """Encode the words not yet known; of too many known ones, those stay that are asked for again."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > MEMORY:
            self.known = {w: self.known[w] for w in words if w in self.known}
        plain = [w for w in new if w not in self.added]
        raw = [w.encode() for w in plain]
        encoded = self.encode_words(raw)
        written, bytes_of = self.written, self.bytes_of
        self.known |= {w: (",".join([written[i] for i in ids]), len(ids), b"".join([bytes_of[i] for i in ids]), ids)
                       for w, ids in [*zip(plain, map(encoded.__getitem__, raw), strict=True), *((w, (self.added[w],)) for w in new if w in self.added)]}


_ENCODERS: dict[int, TrieEncoder] = core.task_cache()


def _encoder(content: bytes) -> TrieEncoder:
    key = hash(content)
    if key not in _ENCODERS:
        core.drop_caches()  # of the operators before
        _ENCODERS[key] = TrieEncoder(content)
        core.trim()
        gc.freeze()  # its tables stay as they are: the collector need not walk them again and again
    return _ENCODERS[key]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    for b in batches:
        ids: list[int | None] = []
        texts: list[str] = []
        held = 0
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ids.append(i)
            texts.append(t or "")
            held += len(texts[-1])
            if held >= CHUNK_BYTES:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts
    core.trim()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Per document its ids and the text decoded from them, or (``digests``) their SHA-256."""
    core.bounded_batches(docs.sparkSession)
    content = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    schema = DIGESTS if digests else OUTPUTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(content.value)
        for ids, texts in _chunks(batches):
            split = [enc.words(t) for t in texts]
            enc.learn(set().union(*split))
            known = enc.known
            rows = []
            for i, words in zip(ids, split, strict=True):
                got = [known[w] for w in words]
                decoded = b"".join([g[2] for g in got])
                row = {"doc_id": i, "n_tokens": sum([g[1] for g in got])}
                if digests:
                    text = decoded.decode("utf-8", "replace").encode()
                    row |= {"ids_sha256": hashlib.sha256(",".join([g[0] for g in got]).encode()).hexdigest(),
                            "decoded_sha256": hashlib.sha256(text).hexdigest()}
                else:
                    row |= {"ids": [x for g in got for x in g[3]], "decoded": decoded.decode("utf-8", "replace")}
                rows.append(row)
            yield core.batch_of(schema, rows)

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, schema)
