"""Phrase mining against brute force."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from ebbflow.llm.phrases import Chunk, _parts, collocations, mine

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    f, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, 5):
                f.update((lang, tuple(w[i:i + n])) for i in range(len(w) - n + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in cand.items():
        s, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        inside = lambda v: any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))
        if not any(g == lang and len(v) > len(w) and inside(v) and 100 * b >= 80 * a for (g, v), b in cand.items()):
            out.append((lang, -s, -a, " ".join(w).encode(), l, r))
    rows, rank = [], Counter()
    for lang, s, a, p, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], p.decode(), -a, l, r, total[lang], -s))
    return sorted(rows)


def cases():
    r = random.Random(2)
    vocab = ["a", "B", "b", "çà", "Ça", "x\u00a0y", "d'e", "日本", "the", "The"]
    rows = []
    for i in range(150):
        w = r.choices(vocab, weights=range(1, 11), k=r.randint(0, 40))
        rows.append((i, "".join(x + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for x in w), r.choice(["en", "fr", None, "und"])))
    rows += [(200 + i, "New York, new york city new york city hall. " * 3, "en") for i in range(10)]
    rows += [(300, None, "en"), (301, "", None), (302, " \t.,", "de"), (303, "a " * 3000 + ". " + "b a " * 500, "de"), (None, "new york", "en"),
             (0, rows[0][1], "en"), (0, rows[0][1], "en")]
    return rows


def run(spark, rows, least, top, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4) \
        .withColumn("n", F.lit("x")).withColumn("phrase", F.lit(1)).withColumn("score", F.lit(2))
    return sorted(map(tuple, collocations(df, least=least, top=top, **more).collect()))


def test_matches_brute_force(spark):
    rows = cases()
    want = brute(rows, 4, 25)
    assert len(want) > 60
    assert run(spark, rows, 4, 25) == want


def test_border_failures_are_closed(spark):
    """With hardly any sample the proposal is (nearly) empty: all that is frequent comes from the expansion passes."""
    rows = cases()
    assert run(spark, rows, 4, 500, sample_share=0.002, max_bits=20, chunk=500, shard_keys=50) == brute(rows, 4, 500)


def test_crowded_bitmap(spark):
    rows = cases()
    assert run(spark, rows, 3, 500, max_bits=8, shard_keys=1 << 30) == brute(rows, 3, 500)


def test_all_phrases(spark):
    df = spark.createDataFrame([(1, "a b a b a", "en"), (2, "a. b", "fr")], "doc_id long, text string, lang string")
    phrases, words = mine(df, least=2)
    assert {(r.lang, r.phrase): r.f for r in phrases.collect()} == {("en", k): v for k, v in
                                                                   {"a": 3, "b": 2, "a b": 2, "b a": 2, "a b a": 2}.items()}
    assert {(r.lang, r.words) for r in words.collect()} == {("en", 5), ("fr", 2)}


def test_empty_table(spark):
    assert run(spark, [], 2, 5) == []


def test_long_texts_are_cut_at_piece_ends():
    text = b"ab cd. " * 1000 + b"e f g h" * 50
    parts = _parts(text, 100)
    assert b"".join(parts) == text and max(map(len, parts[:-1])) < 120 and all(p.endswith(b".") for p in parts[:-1])


def test_long_words_with_patterned_bytes_differ():
    """Two words whose polynomial hashes modulo 2**64 agree (Thue-Morse)."""
    t = [bin(i).count("1") & 1 for i in range(1024)]
    x, y = bytes(97 + b for b in t), bytes(98 - b for b in t)
    c = Chunk([x + b" " + y], ["en"])
    at = c.starts(1)
    assert len(set(c.keys(at, 1).tolist())) == 2 == len(set(c.more(at, 1).tolist()))
