"""Pipeline stages over shared and null ids, timestamps, clashing columns and short benchmark items."""

import datetime as dt

import corpus_pipeline
from ebbflow.llm.decontaminate import remove_contaminated
from ebbflow.llm.window_dedup import cut_repeated_windows

A, B, C = (" ".join(f"{w}{i}" for i in range(20)) for w in "abc")


def test_rows_with_shared_and_null_ids(spark):
    rows = [(1, A, "x"), (2, B, "x"), (2, C, "y"), (3, C, "z"), (None, A, "n"), (None, "free text", "n"), (None, "free text", "m"), (4, "", "e"), (5, None, "e")]
    d = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, d, "")
    assert got.columns == d.columns
    out = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(out, key=repr) == sorted([(1, A), (2, B), (3, C), (None, "free text"), (4, ""), (5, None)], key=repr)
    one = corpus_pipeline.near_duplicates(spark, d.where("doc_id IN (1, 3, 4, 5)"), "")
    assert one.count() == 4
    assert corpus_pipeline.near_duplicates(spark, d.limit(0), "").count() == 0


def test_timestamps_keep_microseconds(spark):
    at = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    d = spark.createDataFrame([(1, A, at, at), (2, A + " end", at, None)], "doc_id long, text string, at timestamp, local timestamp_ntz")
    got = {r.doc_id: (r.text, r.at, r.local) for r in cut_repeated_windows(d).collect()}
    assert got == {1: (A, at, at), 2: ("end", at, None)}


def test_short_items_need_the_whole_item(spark):
    items = spark.createDataFrame([(1, "the"), (2, "who was the first king"), (3, None)], "item_id long, text string")
    rows = [(1, "the cat sat"), (2, "The!"), (3, "he asked who was the first king of all"), (4, "who was the last king"), (5, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in remove_contaminated(docs, items, least=1).collect()) == [1, 4, 5, 6]
