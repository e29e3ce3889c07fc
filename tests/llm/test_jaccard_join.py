"""Jaccard join against all pairs."""

import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.llm.components import components
from ebbflow.llm import core, jaccard_join
from ebbflow.llm.jaccard_join import Sets, join_cell, near_duplicates, regions

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sets_of(t):
    w = WORD.findall(bytes((t or "").encode()).translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows):
    s = [sets_of(t) for _, t in rows]
    low = {i: i for i, _ in rows if i is not None}
    links = [(rows[a][0], rows[b][0]) for a in range(len(rows)) for b in range(a) if rows[a][0] is not None and rows[b][0] is not None
             and s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])]
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if before == low:
            return sorted(((i, len(x), low.get(i)) for (i, _), x in zip(rows, s, strict=True)), key=repr)


def cases():
    r = random.Random(8)
    vocab = [f"v{i}" for i in range(60)]
    rows, k = [], 0
    for _ in range(12):
        base = r.choices(vocab, k=r.randint(5, 120))
        for _ in range(r.randint(1, 14)):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(vocab)
            base = w if r.random() < 0.5 else base  # chains drift away from their start
            rows.append((k, " ".join(x.upper() if r.random() < 0.1 else x for x in w)))
            k += 1
    passage = " ".join(r.choices(vocab, k=30))
    rows += [(k + i, passage + " " + " ".join(r.choices(vocab, k=60))) for i in range(20)]
    rows += [(500 + i, rows[0][1]) for i in range(5)]
    rows += [(600, None), (601, ""), (602, " \n"), (603, "one two"), (604, "ONE  two"), (605, "one"), (None, rows[0][1]), (None, None),
             (606, "a " * 400), (607, "a " * 9000), (3, rows[3][1]), (608, "x" * 50000)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("cell", [1 << 21, 3000])  # in one task; split by Spark
def test_matches_all_pairs(spark, cell):
    rows = cases()
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("component_id", F.lit(1)).withColumn("keys", F.lit(2))
    got = near_duplicates(d, block_bytes=4000, shard_keys=512, cell_shingles=cell, pivots=3).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)


def test_a_large_cell_is_split_by_spark(spark, monkeypatch):
    """One cell of near copies beyond the limit: the pivots split it, level by level, and no link is lost."""
    import random

    r = random.Random(9)
    base = [f"w{r.randint(0, 400)}" for _ in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for k in r.sample(range(60), r.choice([0, 0, 1, 2, 8])):
            w[k] = f"x{r.randint(0, 5)}"
        rows.append((i, " ".join(w)))
    names, stage = [], core.stage
    monkeypatch.setattr(core, "stage", lambda df, name, *a: names.append(name) or stage(df, name, *a))
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_duplicates(d, cell_shingles=2000, pivots=8).collect()
    assert names.count("jaccard-level") > 0
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=repr) == brute(rows)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_any_two_rows_within_reach_meet():
    """Points on a line, any pivots: two rows within e share a region."""
    rng = np.random.default_rng(0)
    for _ in range(200):
        x, p, e = rng.random(30), rng.random(rng.integers(1, 6)), rng.uniform(0.01, 0.3)
        row, region = regions(np.abs(x[:, None] - p), e)
        where = [set(region[row == i].tolist()) for i in range(30)]
        assert all(where[i] & where[j] for i in range(30) for j in range(i) if abs(x[i] - x[j]) <= e)


def test_join_cell_random():
    rng = np.random.default_rng(1)
    for _ in range(30):
        base = rng.integers(0, 1 << 40, 40, dtype=np.uint64)
        sets = [np.unique(np.concatenate((rng.choice(base, rng.integers(20, 38), replace=False), rng.integers(0, 99, 3, dtype=np.uint64)))) for _ in range(25)]
        root = join_cell(Sets(sets, Fraction(4, 5)))
        want = list(range(25))
        for _ in range(25):
            for i in range(25):
                for j in range(25):
                    a, b = set(sets[i].tolist()), set(sets[j].tolist())
                    if 100 * len(a & b) >= 80 * len(a | b):
                        want[i] = want[j] = min(want[i], want[j])
        assert root.tolist() == want


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(40)] + [(7, 7), (500, 900)]
    low = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: got.get(k, k) for k in low} == low


def ball(rng, n, shared=100, own=12):
    """Sets around one, each with some shingles of its own: any two are farther apart than a link, few regions part them."""
    base = rng.integers(0, 1 << 60, shared, dtype=np.uint64)
    return [np.unique(np.concatenate((rng.choice(base, shared - own, replace=False), rng.integers(0, 1 << 60, own, dtype=np.uint64)))) for _ in range(n)]


def test_a_ball_of_unlinked_sets_is_counted_at_once(monkeypatch):
    """Rows that no pivot parts are not tried pivot by pivot; a few near pairs among them are found."""
    rng = np.random.default_rng(2)
    sets = ball(rng, 300)
    sets += [np.unique(np.append(sets[i], np.uint64(i))) for i in (3, 77, 200)] + ball(rng, 2, own=0)
    pivots, common = [], Sets.common
    monkeypatch.setattr(Sets, "common", lambda self, pivot, rows: pivots.append(len(rows)) or common(self, pivot, rows))
    root = join_cell(Sets(sets, Fraction(4, 5)))
    want = np.arange(305)
    want[[300, 301, 302]], want[304] = [3, 77, 200], 303
    assert root.tolist() == want.tolist()
    assert len(pivots) <= 8


def test_slices_and_small_blocks_give_the_same_links(monkeypatch):
    rng = np.random.default_rng(3)
    for pairs, dense in ((64, 1), (500, 200), (1 << 21, 1 << 22)):
        monkeypatch.setattr(jaccard_join, "PAIRS", pairs)
        monkeypatch.setattr(jaccard_join, "DENSE", dense)
        for _ in range(10):
            sets = [s[: rng.integers(30, 99)] for s in ball(rng, 40, own=3)] + ball(rng, 20, 30, 2)
            n = len(sets)
            links = [[len(np.intersect1d(a, b)) * 5 >= 4 * len(np.union1d(a, b)) for b in sets] for a in sets]
            want = list(range(n))
            for _ in range(n):
                want = [min(want[j] for j in range(n) if links[i][j]) for i in range(n)]
            whole = Sets(sets, Fraction(4, 5))
            roots, of = jaccard_join.Roots(n), rng.integers(0, 3, n)
            for i in range(3):
                for j in range(i, 3):
                    jaccard_join.link_all(whole, np.flatnonzero(of == i), None if i == j else np.flatnonzero(of == j), roots)
            assert roots.find(np.arange(n)).tolist() == want == join_cell(whole).tolist()


def test_a_ball_beyond_the_limit_takes_one_round(spark, monkeypatch):
    """Documents around one, each a little too far from the others: Spark compares slices, not eight pivots a round."""
    r = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(90):
        w = list(base)
        for k in r.sample(range(200), 5 if i % 9 else 0):
            w[k] = f"x{r.randint(0, 9999)}"
        rows.append((i, " ".join(w if i % 9 else w[i // 9:])))
    names, stage = [], core.stage
    monkeypatch.setattr(core, "stage", lambda df, name, *a: names.append(name) or stage(df, name, *a))
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_duplicates(d, cell_shingles=5000, pivots=2).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=repr) == brute(rows)
    assert names.count("jaccard-level") == 1


def test_sketches_of_many_shards_count_by_leading_bits():
    """Rows and answers of a block are cut from one pass over its keys, whatever the number of shards."""
    rng = np.random.default_rng(6)
    for bits in (0, 3, 12):
        blocks = [rng.integers(0, 1 << 63, 400, dtype=np.uint64) for _ in range(3)]
        blocks[1] = np.concatenate((blocks[1], blocks[0][:90], blocks[1][:5]))
        low = np.uint64(32 - bits)
        every = np.concatenate([b >> low for b in blocks])
        rows = [r for i, b in enumerate(blocks) for r in core.sketch_rows(i, b, bits)]
        assert len(rows) == sum(len(np.unique(b >> low >> np.uint64(32))) for b in blocks)
        for i, b in enumerate(blocks):
            mine = [r for r in rows if r["block"] == i]
            answers = []
            for r in mine:
                own = np.frombuffer(r["keys"], np.uint32).astype(np.uint64)
                at = np.uint64(r["shard"]) << np.uint64(32) | own
                again = own[[np.count_nonzero(every == x) > 1 for x in at]].astype(np.uint32)
                answers.append({"shard": r["shard"], "keys": again.tobytes()})
            want = [np.count_nonzero(every == x) > 1 for x in b >> low]
            assert core.flagged(b, answers[::-1], bits).tolist() == want


def test_flagged_does_one_search_over_all_shards(monkeypatch):
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    answers = [{"shard": r["shard"], "keys": r["keys"]} for r in core.sketch_rows(0, keys, 8)]
    calls, member = [], core.member
    monkeypatch.setattr(core, "member", lambda *a: calls.append(1) or member(*a))
    assert core.flagged(keys, answers, 8).all()
    assert len(calls) == 1 < len(answers)
