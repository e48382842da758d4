"""Quality rules against plain counts, and Viterbi decoding against all sequences."""

import itertools
import random

import numpy as np
import plain
from perigee.llm import quality


def counted(text):
    text = text or ""
    words = plain.WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if plain.WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = plain.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def check(docs, labels):
    found = quality.report(docs, labels)
    want = plain.Counter((r["doc_id"], *counted(r["text"])) for r in docs.collect())
    assert plain.rows(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert found.filter("base_failed AND kept").count() == 0


def test_tables(spark):
    check(spark.read.parquet(f"{plain.SF}/documents.parquet"), spark.read.parquet(f"{plain.SF}/labels.parquet"))


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (11, 0), (11, 1), (8, None), (99, 1)], "doc_id bigint, quality int")
    check(plain.awkward(spark, "kept n_words quality rows"), labels)
    chain = quality.fit(plain.awkward(spark), labels)
    kept = quality.retained(plain.awkward(spark, "kept"), chain)
    assert kept.columns[-1] == "kept" and kept.filter("kept = 'own'").count() == kept.count() >= 2


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.report(plain.empty(spark), labels).collect() == []
    check(plain.awkward(spark), labels)


def test_viterbi_finds_the_best_of_all_sequences():
    draw = random.Random(2)
    for n in range(1, 9):
        weights = [draw.uniform(-2, 2) for _ in range(quality.FEATURES)]
        moves = [[draw.uniform(-1, 1) for _ in range(2)] for _ in range(2)]
        rows = [[draw.random() for _ in range(quality.FEATURES)] for _ in range(n)]
        unary = (np.array(rows) @ np.array(weights)).tolist()

        def score(labels):
            return sum(u for u, y in zip(unary, labels) if y) + sum(moves[a][b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert tuple(quality.Chain(weights, moves).decode(rows)) == best


def test_labels_are_learned(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    chain = quality.fit(docs, labels)
    found = quality.judged(docs, chain).join(labels, "doc_id").select("kept", "quality").toPandas()
    assert found.kept[found.quality == 1].mean() > 0.97
    assert found.kept[found.quality == 0].mean() < 0.5
