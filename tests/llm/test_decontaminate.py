"""Spaced-seed decontamination against brute force over all diagonals."""

import math
import random

from pyspark.sql import functions as F

from ebbflow.llm.decontaminate import MASKS, overlaps, remove_contaminated

PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def norm(t):
    return [x for x in (w.strip(PUNCT) for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()) if x]


def brute(docs, items):
    """Pairs with an overlap and a seed hit on its diagonal."""
    out = set()
    for d, t in docs:
        w = norm(t)
        for i, x in items:
            v = norm(x)
            if len(v) < 9:
                continue
            need = min(13, len(v))
            for diag in range(-len(v), len(w)):
                eq = [0 <= k + diag < len(w) and w[k + diag] == v[k] for k in range(len(v))]
                inside = [0 <= k + diag < len(w) for k in range(len(v))]
                seed = any(all(inside[a:a + len(m)]) and all(eq[a + k] for k, c in enumerate(m) if c == "1")
                           for m in MASKS for a in range(len(v) - len(m) + 1))
                if seed and any(all(inside[a:a + need]) and sum(eq[a:a + need]) >= math.ceil(0.75 * need)
                                for a in range(len(v) - need + 1)):
                    out.add((d, i))
    return out


def cases():
    r = random.Random(1)
    vocab = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choices(vocab, k=r.randint(5, 40)))) for i in range(12)] + [(98, None), (99, ""), (None, "")]
    docs = []
    for i in range(60):
        w = r.choices(vocab, k=r.randint(0, 30))
        if i % 2:
            p = r.choice(items[:12])[1].split()
            for k in range(len(p)):
                if r.random() < 0.12 * (i % 3):
                    p[k] = "zz"
            w += [x.upper() + "," if r.random() < 0.2 else x for x in p] + r.choices(vocab, k=5)
        docs.append((i, "  ".join(w)))
    docs += [(70, None), (71, ""), (None, items[3][1]), (1, docs[1][1]), (72, "w1 " * 30000)]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("item_id", F.lit(0))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    want = brute(docs, items)
    assert len(want) > 15
    for words in (1 << 20, 60):  # one slice; several
        got = overlaps(d, b, slice_words=words).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
        assert all(r.equal_words >= 0.75 * min(13, r.overlap_words) and r.equal_words <= r.overlap_words for r in got)
        left = remove_contaminated(d, b, slice_words=words)
        assert left.columns == d.columns
        assert sorted(map(repr, left.collect())) == sorted(repr(r) for r in d.collect() if r.doc_id not in {x for x, _ in want})


def test_empty_tables(spark):
    docs, items = cases()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert overlaps(d.limit(0), b).collect() == []
    assert overlaps(d, b.limit(0)).collect() == []
    assert remove_contaminated(d, b.limit(0)).count() == d.count()
