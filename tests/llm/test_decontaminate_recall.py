"""Decontamination finds every overlap that its rule accepts: all substitution patterns, no seed condition."""

import math
from itertools import combinations

import pytest

from ebbflow.llm import decontaminate
from ebbflow.llm.decontaminate import Slice


def missing(n):
    return n - math.ceil(0.75 * n - 1e-9)


@pytest.mark.parametrize("n", range(9, 14))
def test_every_accepted_pattern_is_found(n):
    item = [f"v{k}" for k in range(n)]
    s = Slice([(1, " ".join(item).encode())], 13, 0.75, 9)
    texts = []
    for m in range(missing(n) + 2):
        for lost in combinations(range(n), m):
            w = ["zz" if k in lost else x for k, x in enumerate(item)]
            texts.append((m, " ".join(["a", *w, "b"]).encode()))
    got = set(s.overlaps([t for _, t in texts])[0].tolist())
    assert got == {i for i, (m, _) in enumerate(texts) if m <= missing(n)}


def test_overlap_inside_long_texts():
    item = [f"v{k}" for k in range(30)]
    s = Slice([(1, " ".join(item).encode())], 13, 0.75, 9)
    texts = [" ".join(["zz" if k in lost else item[8 + k] for k in range(13)]).encode() for lost in combinations(range(13), 3)]
    assert s.overlaps(texts)[0].tolist() == list(range(len(texts)))


def test_other_lengths_and_shares():
    for words, lost in ((13, 6), (20, 5), (40, 10), (9, 0)):
        item = [f"v{k}" for k in range(words)]
        s = Slice([(1, " ".join(item).encode())], words, (words - lost) / words, 9)
        spread = {round(k * words / lost) for k in range(lost)} if lost else set()
        text = " ".join("zz" if k in spread else x for k, x in enumerate(item)).encode()
        assert s.overlaps([text])[0].tolist() == [0], (words, lost)


def test_chunks_of_hits_do_not_change_the_result(monkeypatch):
    items = [(i, f"q{i % 3} b c d e f g h i j k l m n o".encode()) for i in range(9)]
    texts = [b"x b c d e f g h i j k l m n o " * 5, b"b c d e"]
    want = [x.tolist() for x in Slice(items, 13, 0.75, 9).overlaps(texts)]
    monkeypatch.setattr(decontaminate, "_HITS", 4)
    assert [x.tolist() for x in Slice(items, 13, 0.75, 9).overlaps(texts)] == want and len(want[0]) == 9
