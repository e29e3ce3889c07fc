"""Tokenizer alignment against a direct version on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ebbflow.llm.alignment import Aligner, align, cut_units, refine

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def aligner():
    return Aligner(A, B)


def brute(rows, aligner):
    docs, count = [], Counter()
    for i, text in rows:
        raw = (" " + (text or "")).encode()
        a = aligner.a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = aligner.b.encode(text) if text else []
        ta, tb = [aligner.a_bytes[x] for x in a], [aligner.b_bytes[x] for x in b]
        if b"".join(ta) != raw or b"".join(tb) != raw:
            docs.append((i, [], [], [], []))
            continue
        ea, eb = np.cumsum([len(x) for x in ta]).tolist(), np.cumsum([len(x) for x in tb]).tolist()
        links, x, y = [], 0, 0
        while x < len(a) and y < len(b):
            links.append((a[x], b[y]))
            x, y = x + (ea[x] <= eb[y]), y + (eb[y] <= ea[x])
        groups, x, y = [], 0, 0
        for e in sorted(set(ea) & set(eb)):
            x2, y2 = ea.index(e) + 1, eb.index(e) + 1
            groups.append(",".join(map(str, a[x:x2])) + "|" + ",".join(map(str, b[y:y2])))
            x, y = x2, y2
        count.update(links)
        docs.append((i, a, b, groups, links))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(((i, len(a), len(b), len(g), len(ln), sum(count[p] == most[p[1]] for p in ln), sum(count[p] for p in ln),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for i, a, b, g, ln in docs), key=repr)


def cases():
    r = random.Random(4)
    vocab = ["the", "Ansible", "é", "日本語", "😀👍🏽", "don't", "  ", "\n", "\t", "x y", " z", "naïve", "1234567", "--", "नमस्ते", "á",
             "<s>", "<|endoftext|>", "</s>", "\x00", "\x85k", "　", "<0x41>", "ÿ", "it's", "'ll", "​", "\r\n"]
    rows = [(i, r.choice([" ", ""]).join(r.choices(vocab, k=r.randint(1, 25)))) for i in range(150)]
    rows += [(200 + i, "the same words again and again, the same") for i in range(30)]
    rows += [(300, None), (301, ""), (302, " "), (303, "▁x"), (304, "  x  "), (305, "a ▁ b"), (306, "y" * 3000), (307, "ab " * 2000), (None, "the é"), (308, "\n"),
             (0, rows[0][1]), (0, rows[0][1]), (309, "x ́y   z"), (310, "﻿ a"), (311, " '"), (312, "tail ")]
    return rows


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3) \
        .withColumn("block", F.lit("x")).withColumn("n_a", F.lit(1)).withColumn("pairs", F.lit(2))
    return sorted(map(tuple, align(df, A, B, **more).collect()), key=repr)


def test_matches_whole_texts(spark, aligner):
    rows = cases()
    want = brute(rows, aligner)
    assert sum(w[1] > 0 for w in want) > 150 and any(w[1] == 0 for w in want)
    assert run(spark, rows) == want


def test_blocks_shards_and_slices(spark, aligner):
    rows = cases()
    assert run(spark, rows, block_bytes=400, shard_keys=100, slice_blocks=4) == brute(rows, aligner)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_spans_are_the_tokens_bytes(aligner):
    assert aligner.cuts
    for _, t in cases():
        got = aligner.spans(" " + (t or ""))
        if got is not None:
            a, a_end, b, b_end = got
            assert a_end.tolist() == np.cumsum(aligner.a_len[a]).tolist() and b_end.tolist() == np.cumsum(aligner.b_len[b]).tolist()


def test_refine():
    # a token of 2 bytes, three that share a character of 4 bytes, one of 1; then two that split the character between them
    assert refine(np.array([[0, 2], [2, 6], [2, 6], [2, 6], [6, 7]]), np.array([2, 1, 1, 2, 1])).tolist() == [2, 3, 4, 6, 7]
    assert refine(np.array([[0, 4], [1, 5], [5, 6]]), np.array([2, 3, 1])).tolist() == [2, 5, 6]
    # empty spans before or behind the one that has the character
    assert refine(np.array([[0, 1], [1, 1], [1, 1], [1, 4]]), np.array([1, 1, 1, 1])).tolist() == [1, 2, 3, 4]
    assert refine(np.array([[0, 1], [1, 4], [4, 4], [4, 4], [4, 5]]), np.array([1, 1, 1, 1, 1])).tolist() == [1, 2, 3, 4, 5]


def test_units_join_to_the_texts():
    texts = [t.encode() for _, t in cases() if t is not None]
    buf, start, first = cut_units(texts, True)
    assert buf.tobytes() == b"".join(b" " + t for t in texts) and set(first.tolist()) <= set(start.tolist()) and len(start) > len(first)
