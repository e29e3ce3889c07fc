"""The pair test from the table of merges against merging both tokens' bytes."""

import json
import random

import public_tokenizers

from ebbflow.llm import bpe_trie

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_pairs_are_tested_without_merging_their_bytes(monkeypatch):
    enc = bpe_trie.TrieEncoder(bpe_trie.vocabulary(PATH))
    merge = enc.plain
    words = [w.encode() for w in (" the", " ofthehand", " aaaaaaa", " Straßenbahn", "!!!!!!!", " 2024", " ciónquequedo", "\n\n")]
    want = {w: tuple(enc.id_of[b] for b in merge(w)) for w in words}
    r = random.Random(4)
    short = [i for b, i in enc.id_of.items() if len(b) <= 3]
    equal = [i for b, i in enc.id_of.items() if len(set(b)) == 1 and b[:1] in b" a-=!"]
    pairs = [(r.choice(short), r.choice(short)) for _ in range(3000)] + [(x, y) for x in equal for y in equal]
    apart = [merge(enc.bytes_of[x] + enc.bytes_of[y]) == [enc.bytes_of[x], enc.bytes_of[y]] for x, y in pairs]
    assert 0 < sum(apart) < len(apart)

    def never(b):
        raise AssertionError(f"{b} was merged byte by byte")

    monkeypatch.setattr(enc, "plain", never)
    assert [enc.follows(x, y) for x, y in pairs] == apart
    assert enc.encode_words(words) == want


def test_a_vocabulary_whose_token_has_two_merges_falls_back():
    spec = {"model": {"vocab": {t: i for i, t in enumerate(["a", "b", "c", "ab", "bc", "abc"])}, "merges": ["a b", "b c", "ab c", "a bc"]}}
    enc = bpe_trie.TrieEncoder(json.dumps(spec).encode())
    assert not enc.joined
    assert enc.encode_words([b"abcab", b"bcabc"]) == {b"abcab": (5, 3), b"bcabc": (4, 5)}
