"""Word hashes do not fail on patterned long words (Thue-Morse pairs collide in any polynomial modulo 2**64)."""

from ebbflow.llm import core
from ebbflow.llm.decontaminate import overlaps
from ebbflow.llm.jaccard_join import near_duplicates
from ebbflow.llm.window_dedup import remove_repeated_windows


def pair(n=2048):
    t = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in t), "".join("ba"[b] for b in t)


def test_hashes_differ():
    w = core.Words([" ".join(pair()).encode(), b"x y x"])
    for which in range(2):
        h = w.hashes(which).tolist()
        assert len(set(h)) == 4 and h[2] == h[4]


def test_substring_dedup_keeps_other_words(spark):
    a, b = pair()
    tail = " ".join(f"w{i}" for i in range(12))
    df = spark.createDataFrame([(1, f"{a} {tail}"), (2, f"{b} {tail}")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in remove_repeated_windows(df).collect()} == {1: 0, 2: 0}


def test_jaccard_join_links_nothing(spark):
    a, b = pair()
    df = spark.createDataFrame([(1, f"{a} c d e f"), (2, f"{b} c d e f")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(df).collect()} == {1: 1, 2: 2}


def test_decontamination_finds_nothing(spark):
    a, b = pair()
    docs = spark.createDataFrame([(1, f"{a} {a} {a} {a} c d")], "doc_id long, text string")
    items = spark.createDataFrame([(1, f"{b} {b} {b} {b} e f")], "item_id long, text string")
    assert overlaps(docs, items, least=1).collect() == []
