"""A language that is rare among the documents keeps its segments in training."""

import random

import numpy as np

from ebbflow.llm import langid


def test_quotas():
    assert langid.quotas([10, 3, 100], 60) == [10, 3, 47]
    assert langid.quotas([50, 50, 50], 60) == [20, 20, 20]
    assert langid.quotas([1, 2], 60) == [1, 2]
    assert langid.quotas([9_000] * 100, 30_000) == [5_000] * 100
    assert langid.quotas([], 60) == []


def test_rare_language_trains(spark, monkeypatch):
    r = random.Random(5)
    parts = {"en": ["th", "ing", "er", "the", "wh"], "de": ["sch", "ung", "der", "ein", "ch"], "es": ["ll", "ción", "qu", "ñ", "rr"]}

    def text(lang):
        return " ".join("".join(r.choices(parts[lang], k=r.randint(1, 4))) for _ in range(20))

    rows = [(i, text(lang), lang) for i, lang in enumerate(["en", "de"] * 300 + ["es"] * 5)]
    seen, fit = [], langid.BiGru.fit
    monkeypatch.setattr(langid.BiGru, "fit", lambda self, words, *a: (seen.extend(words), fit(self, words, *a))[1])
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.train(d, max_segments=300)
    own = {w.encode() for _, t, x in rows if x == "es" for w in t.lower().split()}
    assert own <= set(seen) and len(seen) <= 300
    new = spark.createDataFrame([(i, text(x), x) for i, x in enumerate(["en", "de", "es"] * 40)], "doc_id long, text string, lang string")
    truth = {x.doc_id: x.lang for x in new.collect()}
    got = {x.doc_id: x.lang_pred for x in langid.predict(new, model).collect()}
    for lang in parts:
        assert np.mean([got[i] == lang for i in truth if truth[i] == lang]) > 0.95, lang
