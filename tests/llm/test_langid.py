"""BiGRU language identification: gradients, held-out accuracy, edge cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from ebbflow.llm import langid, toxicity


def test_gradients_against_differences():
    net = langid.BiGru(3, hidden=4, seed=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x = rng.integers(97, 101, (5, 6))
    target, weight = rng.dirichlet(np.ones(3), 5), rng.random(5) + 0.5
    _, grad = net.gradients(x, target, weight)
    for name, at in (("fx", (98, 5)), ("fu", (1, 6)), ("fc", (2, 3)), ("bx", (99, 9)), ("bu", (0, 1)), ("bc", (3, 0)), ("o", (5, 1)), ("ob", (2,))):
        losses = []
        for e in (1e-3, -1e-3):
            net.p[name][at] += e
            losses.append(net.gradients(x, target, weight)[0])
            net.p[name][at] -= e
        assert abs((losses[0] - losses[1]) / 2e-3 - grad[name][at]) < 2e-4, name


def test_held_out_accuracy_and_edge_cases(spark):
    r = random.Random(4)
    parts = {"en": ["th", "ing", "er", "the", "wh"], "de": ["sch", "ung", "ß", "der", "ein"], "fr": ["eau", "ç", "ou", "le", "ment"]}
    rows = []
    for i in range(600):
        lang = r.choice(list(parts))
        rows.append((i, " ".join("".join(r.choices(parts[lang], k=r.randint(1, 4))) for _ in range(r.randint(3, 30))), lang))
    odd = [(9000, None, "en"), (9001, "", "de"), (9002, "123 !! —", "de"), (9003, "x" * 9000, None), (None, "thing thing", "en")]
    d = spark.createDataFrame(rows + odd + [rows[5]], "doc_id long, text string, lang string").repartition(3).withColumn("score", F.lit(1))
    model = langid.train(d, train_on=~toxicity.held_out(F.col("doc_id"), 5, 0), docs_per_language=100)
    got = langid.predict(d, model).collect()
    assert len(got) == len(rows) + len(odd) + 1
    truth = {i: x for i, _, x in rows}
    by = {x.doc_id: x for x in got}
    assert np.mean([x.lang_pred == truth[x.doc_id] for x in got if x.doc_id in truth]) > 0.97
    assert [by[i].lang_pred for i in (9000, 9001, 9002)] == ["und"] * 3
    assert by[9003].lang_pred in parts and by[None].lang_pred == "en"
    assert all(0 <= x.score <= 1 for x in got)
    empty = d.limit(0)
    assert langid.predict(empty, langid.train(empty)).collect() == []
    assert {x.lang_pred for x in langid.predict(d, langid.train(empty)).collect()} == {"und"}
