"""nnPU toxicity: held-out accuracy on a planted signal, edge cases, folds."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from ebbflow.llm import toxicity


def planted(n=1500):
    r = random.Random(2)
    vocab = [f"word{chr(97 + i % 26)}{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.15
        w = r.choices(vocab, k=r.randint(5, 60))
        if toxic:
            w[r.randrange(len(w))] = r.choice(["Vileness", "vilenar", "VILENUM"]) + r.choice(["", "x", "ed"])
        rows.append((i, " ".join(w), toxic))
        if r.random() < 0.5:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_edge_cases(spark):
    rows, labels = planted()
    d = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "vileness"), (9000, None), (9001, ""), (3, rows[3][1])],
                              "doc_id long, text string").repartition(4).withColumn("score", F.lit("x"))
    lab = spark.createDataFrame([*labels, (None, 1), (5, None), labels[0]], "doc_id long, toxic int")
    model = toxicity.train(d, lab, train_on=~toxicity.held_out(F.col("doc_id"), 5, 0))
    got = toxicity.score(d, model).collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 for r in got)
    truth = {i: t for i, _, t in rows}
    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in held]) > 0.95
    kept = toxicity.reject_toxic(d, model)
    assert kept.columns == d.columns
    assert kept.count() == sum(r.score < 0.5 for r in got)


def test_without_positives_or_documents(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(d, lab)
    assert all(r.score < 1e-9 for r in toxicity.score(d, model).collect())
    assert toxicity.score(d.limit(0), toxicity.train(d.limit(0), lab)).collect() == []


def test_risk_correction_takes_hidden_positives_out():
    """With every positive feature also in the unlabelled texts at the prior's rate, positives still score high."""
    pos = [np.array([7], np.int32)] * 50
    unl = [np.array([7], np.int32)] * 20 + [np.array([9], np.int32)] * 180
    m = toxicity._fit(pos, unl, prior=0.1, least=3, seed=0)
    z = m.weights[7] + m.bias
    assert z > 0 > m.bias
