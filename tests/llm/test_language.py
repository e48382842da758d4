"""Language identification: held-out accuracy and awkward rows."""

import plain
from perigee.llm import language


def test_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.report(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.lang_pred == found.lang)[found.lang_pred != "und"].mean() > 0.97
    assert len(found) > 200 and found.score.between(0, 1).all()


def test_awkward_rows(spark):
    found = language.report(plain.awkward(spark, "score lang_pred label")).collect()
    assert len(found) == len(plain.AWKWARD) and all(0 <= r["score"] <= 1 for r in found)
    texts = {i: t for i, t, *_ in plain.AWKWARD if i not in (None, 1)}
    for r in found:
        if r["doc_id"] in texts:
            assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, texts[r["doc_id"]] or "")))
    assert {r["lang_pred"] for r in found} <= {"en", "de", "fr", "und"}


def test_empty(spark):
    assert language.report(plain.empty(spark)).collect() == []
    assert {r["lang_pred"] for r in language.predict(plain.awkward(spark), language.fit(plain.empty(spark))).collect()} == {"und"}


def test_scores_are_those_of_plain_bayes():
    import numpy as np

    model = language.Model(["a", "b"], np.zeros(2), np.log(np.random.default_rng(1).dirichlet(np.ones(1 << 14), 2).T))
    text = "Some words of a text. " * 5
    sums = sum(model.log_prob[f] for f in language.ngram_features(text))
    label, score = model.score(text)
    assert label == "ab"[int(sums.argmax())] and abs(score - 1 / np.exp(sums - sums.max()).sum()) < 1e-9


def test_a_batch_scores_as_its_texts_do(monkeypatch):
    import numpy as np

    model = language.Model(["a", "b", "c"], np.zeros(3), np.log(np.random.default_rng(2).dirichlet(np.ones(1 << 14), 3).T))
    texts = ["Some words.", None, "", " 12 ", "é", "A longer text of several words, and one more. " * 4, "x"]
    for cells in (1 << 20, 60):
        monkeypatch.setattr(language, "GATHER_CELLS", cells)
        monkeypatch.setattr(language, "GATHER", 100)
        found = model.scores(texts)
        for text, (label, score) in zip(texts, found, strict=True):
            if text is None or not any(map(str.isalpha, text)):
                assert (label, score) == ("und", 0.0)
                continue
            sums = sum(model.log_prob[f] for f in language.ngram_features(text))
            assert label == "abc"[int(sums.argmax())] and abs(score - 1 / np.exp(sums - sums.max()).sum()) < 1e-9
