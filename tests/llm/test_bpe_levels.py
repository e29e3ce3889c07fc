"""Words of a batch walk the trie together: their pairs are tested as arrays, with the ids of a walk one by one."""

import random

import numpy as np
import public_tokenizers

from ebbflow.llm import bpe_trie

PATH = public_tokenizers.path("byte_bpe_50k.json")


def words():
    r = random.Random(5)
    parts = [b" ", b"the", b"ing", b"tion", b"a", b"aa", b"\x00", b"\xff", "é".encode(), "漢".encode(), "😀".encode(), b"!!", b"==", b"  ", b"2024"]
    out = {b"".join(r.choices(parts, k=r.randint(1, 14))) for _ in range(1500)}
    out |= {bytes(r.choices(b"abc\x00\n ", k=n)) for n in (1, 31, 32, 33, 255, 256, 257, 700) for _ in range(5)}
    return [*out, b"a", b"a\x00", b"a\x00\x00", b"=" * 300, b" " * 200, b"ab" * 60]


def test_pairs_of_a_batch_are_tested_as_arrays(monkeypatch):
    enc = bpe_trie.TrieEncoder(bpe_trie.vocabulary(PATH))
    some = [w for w in words() if len(w) <= bpe_trie.WIDE]
    want = {w: tuple(enc.id_of[b] for b in enc.plain(w)) for w in some}

    def never(*pair):
        raise AssertionError(f"{pair} was tested alone")

    monkeypatch.setattr(enc, "follows", never)
    assert enc.encode_words([*some, *some[:20]]) == want
    monkeypatch.setattr(bpe_trie, "CELLS", 1500)
    assert enc.encode_words(some) == want
    assert enc.encode_words([]) == {}


def test_long_words_and_single_walks_agree():
    enc = bpe_trie.TrieEncoder(bpe_trie.vocabulary(PATH))
    every = words()
    assert enc.encode_words(every) == enc._walk(sorted(set(every)))


def test_lookup_of_arrays():
    r = random.Random(6)
    of = {r.randrange(1 << 40): r.randrange(100) for _ in range(5000)} | {0: 7}
    find = bpe_trie._Lookup(of, -1)
    keys = np.array([*of, *(r.randrange(1 << 40) for _ in range(5000))])
    assert find(keys).tolist() == [of.get(k, -1) for k in keys.tolist()]
    assert bpe_trie._Lookup({}, -1)(keys[:3]).tolist() == [-1, -1, -1]
