"""The corpus pipeline on the small tables, stage by stage."""

import os

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_stages(spark):
    from test_jaccard_join import brute
    from test_window_dedup import brute as windows

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, before, SF)
        assert after.columns == columns
        a, b = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
        assert b and set(b) <= set(a) and after.count() == len(b)
        if name != "substring_dedup":
            assert all(b[i] == a[i] for i in b)
        rows = [(i, r.text) for i, r in a.items()]
        if name == "near_duplicates":
            assert set(b) == {i for i, _, c in brute(rows) if i == c}
        if name == "substring_dedup":
            gone = {i: (n, k) for i, n, k, _ in windows(rows)}
            assert set(b) == {i for i, (n, k) in gone.items() if not k or k < n}
            assert all((len(b[i].text.split()) == gone[i][0] - gone[i][1]) and (gone[i][1] or b[i].text == a[i].text) for i in b)
            assert all(b[i][c] == a[i][c] for i in b for c in columns if c != "text")
        before = spark.createDataFrame(after.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert last.count() == before.count()
