"""Trie BPE against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbflow.llm.bpe_trie import TrieEncoder, encode, vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    alphabet = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", "'s", "'LL", "1", "23", "!!", "漢", "😀", " ", " ", "\x1c", "\x85",
                "the", "ing", "tion", " of", "<|endoftext|>", "<|", "\x00", "é", "​", "٣", "²", "ſ"]
    out = ["".join(r.choices(alphabet, k=r.randint(0, 60))) for _ in range(1500)]
    return [*out, "", "x" * 30000, "ab" * 9000, " " * 5000, "<|endoftext|>" * 3, "Donaudampfschiff " * 50]


def test_ids_match_the_library(texts):
    enc, lib = TrieEncoder(vocabulary(PATH)), Tokenizer.from_file(PATH)
    split = [enc.words(t) for t in texts]
    enc.learn(set().union(*split))
    for t, words, want in zip(texts, split, lib.encode_batch(texts, add_special_tokens=False), strict=True):
        assert [i for w in words for i in enc.known[w][3]] == want.ids, t


def test_operator(spark, texts):
    rows = [*enumerate(texts[:200]), (None, "ab"), (7, None), (7, texts[7])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("ids", F.lit(1))
    lib = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode(df, PATH, digests=True).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    plain = encode(df, PATH).collect()
    assert sorted((r.n_tokens, r.decoded) for r in plain) == sorted((len(lib.encode(t or "", add_special_tokens=False).ids), t or "") for _, t in rows)
    assert encode(df.limit(0), PATH).collect() == []


def test_a_worker_remembers_a_bounded_number_of_words_and_pairs(texts, monkeypatch):
    from ebbflow.llm import bpe_trie

    monkeypatch.setattr(bpe_trie, "MEMORY", 300)
    monkeypatch.setattr(bpe_trie, "PAIRS", 50)
    monkeypatch.setattr(bpe_trie, "NODES", 500)
    enc, lib = TrieEncoder(vocabulary(PATH)), Tokenizer.from_file(PATH)
    for i in range(0, 400, 10):
        part = texts[i:i + 10]
        split = [enc.words(t) for t in part]
        before = set(enc.known)
        words = set().union(*split)
        enc.learn(words)
        assert before & words <= set(enc.known) and len(enc.known) <= max(300, len(words))
        enc.encode_words([])
        assert len(enc.pairs) <= 50 and len(enc.last) <= 500
        for s, want in zip(split, lib.encode_batch(part, add_special_tokens=False), strict=True):
            assert [i for w in s for i in enc.known[w][3]] == want.ids


def test_passes_run_by_the_caller_hold_small_batches(spark, texts):
    from ebbflow.llm import core
    from ebbflow.llm.toxicity import Model, reject_toxic, score

    for build in (lambda d: encode(d, PATH, digests=True), lambda d: reject_toxic(d, Model(None, 0.0)), lambda d: score(d, Model(None, 0.0))):
        own = spark.newSession()
        build(own.createDataFrame([(1, "a")], "doc_id long, text string"))
        assert own.conf.get(core._BATCH) == str(core.BATCH_BYTES)
        own.conf.set(core._BATCH, "1m")
        build(own.createDataFrame([(1, "a")], "doc_id long, text string"))
        assert own.conf.get(core._BATCH) == "1m"
