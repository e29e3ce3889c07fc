"""Substring dedup against brute force."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from ebbflow.llm.window_dedup import cut_repeated_windows, remove_repeated_windows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, width=13):
    words = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, w in words:
        for k in range(len(w) - width + 1):
            s = tuple(w[k:k + width])
            first[s] = min(first.get(s, float("inf")), key(i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < key(i):
                gone.update(range(k, k + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def cases():
    r = random.Random(5)
    vocab = ["ab", "c", "dé", "xyz", "Ab", "e,"]
    passage = " ".join(r.choices(vocab, k=30))
    rows = [(i, " ".join(r.choices(vocab, k=r.randint(0, 40))) + " " + passage[: r.randint(0, 90)]) for i in range(40)]
    rows += [(100 + i, passage) for i in range(20)]
    rows += [(200, None), (201, ""), (None, passage), (None, passage + " x"), (202, "a " * 500), (203, "a\t\n" * 300),
             (204, "x" * 20000), (10, rows[3][1]), (10, rows[3][1])]
    return rows


def test_matches_brute_force(spark):
    rows = cases()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5) \
        .withColumn("block", F.lit(1)).withColumn("n_words", F.lit("x"))
    got = remove_repeated_windows(df, block_bytes=700, shard_keys=64, kept_text=True).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute(rows)
    assert all(hashlib.sha256(" ".join(r.text.split(" ")).encode()).hexdigest() == r.kept_sha256 for r in got if r.n_removed)
    cut = cut_repeated_windows(df).collect()
    assert cut and list(cut[0].asDict()) == df.columns
    texts = dict(rows)
    assert sorted(repr((r.doc_id, r.text)) for r in cut if r.doc_id not in (None, 10) and r.text == texts[r.doc_id]) == \
        sorted(repr((r.doc_id, texts[r.doc_id])) for r in got if r.doc_id not in (None, 10) and not r.n_removed)
    assert len(cut) == sum(not r.n_removed or r.n_removed < r.n_words for r in got)
    assert {(r.block, r.n_words) for r in cut} == {(1, "x")}
    assert sum(r.n_removed for r in got) > 300


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeated_windows(df).collect() == []
