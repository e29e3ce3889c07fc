"""Benchmark items under nine words are searched by the query and the pipeline."""

import math
from itertools import combinations

import pytest

import corpus_pipeline
from ebbflow.llm import queries
from ebbflow.llm.decontaminate import Slice


@pytest.mark.parametrize("n", range(1, 9))
def test_every_accepted_pattern_of_a_short_item(n):
    item = [f"v{k}" for k in range(n)]
    most = n - math.ceil(0.75 * n - 1e-9)
    s = Slice([(1, " ".join(item).encode())], 13, 0.75, 1)
    texts = []
    for m in range(most + 2):
        for lost in combinations(range(n), m):
            w = ["zz" if k in lost else x for k, x in enumerate(item)]
            texts += [(m, " ".join(["a", *w, "b"]).encode()), (m, " ".join(w).encode())]
    got = set(s.overlaps([t for _, t in texts])[0].tolist())
    assert got == {i for i, (m, _) in enumerate(texts) if m <= most}


def test_query_and_stage_find_short_items(spark, tmp_dir):
    docs = spark.createDataFrame([(1, "so: What is the capital of France? Paris."), (2, "nothing of the kind"), (3, None), (4, "forty-two!")],
                                 "doc_id long, text string")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(7, "what is the capital of france"), (8, "Forty-two"), (9, ""), (10, "??")], "item_id long, text string") \
        .write.parquet(f"{tmp_dir}/benchmark.parquet")
    got = queries.op4_decontamination(spark, tmp_dir).collect()
    assert {(r.doc_id, r.item_id, r.overlap_words, r.equal_words, r.doc_word) for r in got} == {(1, 7, 6, 6, 1), (4, 8, 1, 1, 0)}
    left = corpus_pipeline.decontamination(spark, docs, tmp_dir)
    assert sorted(r.doc_id for r in left.collect()) == [2, 3]
