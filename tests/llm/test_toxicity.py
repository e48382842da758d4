"""Toxicity: segments against a recursive search, the fit on held-out rows, awkward rows."""

import random

import plain
import pytest
from perigee.llm import toxicity


def best(scores, lo, hi):
    """The maximal segments of a list, by taking the best segment and searching beside it."""
    found = max(((sum(scores[a:b]), -(b - a), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0.0, 0, 0, 0))
    total, _, a, b = found
    if total <= 0:
        return []
    return [*best(scores, lo, a), (a, b, total), *best(scores, b, hi)]


def test_segments_are_the_maximal_ones():
    draw = random.Random(6)
    for _ in range(150):
        n, floor = draw.randrange(1, 26), -0.4
        marked = [(i, draw.uniform(0.1, 2)) for i in range(n) if draw.random() < 0.3]
        scores = [floor] * n
        for i, s in marked:
            scores[i] = s
        found = toxicity.maximal_segments(marked, n, floor)
        want = best(scores, 0, n)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in found] == pytest.approx([s for *_, s in want])


@pytest.mark.parametrize("falling", [True, False])
def test_the_scan_is_linear(falling):
    """Scattered marked words, of which no two join; twice the words take about twice the steps."""

    class Counted(float):
        asked = 0

        def __ge__(self, other):
            Counted.asked += 1
            return float(self) >= other

        def __add__(self, other):
            return Counted(float(self) + other)

        __radd__ = __add__

    steps = []
    for n in (4_000, 8_000, 16_000, 32_000):
        marked = [(20 * i, Counted(1.0 if falling else 1.0 + (i % 7) / 2)) for i in range(n)]
        Counted.asked = 0
        found = toxicity.maximal_segments(marked, 20 * n, -0.4 if falling else -0.06)
        steps.append(Counted.asked)
        assert found and all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    assert all(b < 2.3 * a for a, b in zip(steps, steps[1:])) and steps[-1] < 6 * 32_000


def test_a_long_text_of_scattered_words_takes_no_time(spark):
    segments = toxicity.maximal_segments([(3 * i, 0.5) for i in range(300_000)], 900_000, -0.4)
    assert len(segments) == 300_000


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.report(docs, labels).filter("held_out").join(labels, "doc_id").toPandas()
    good, bad = found.score[found.toxic == 0].to_numpy(), found.score[found.toxic == 1].to_numpy()
    auc = ((bad[:, None] > good).mean() + (bad[:, None] == good).mean() / 2)
    hit, flagged = (found.predicted[found.toxic == 1] == 1).mean(), (found.predicted[found.toxic == 0] == 1).mean()
    print("auc", auc, "recall", hit, "false alarms", flagged, "rows", len(bad), len(good))
    assert auc > 0.85 and flagged < 0.1 and hit > 0.6


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (8, 0), (11, None), (7, 0), (99, 1)], "doc_id bigint, toxic int")
    found = toxicity.report(plain.awkward(spark, "score toxic predicted"), labels).collect()
    assert len(found) == len(plain.AWKWARD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    kept = toxicity.score(plain.awkward(spark, "score other"), toxicity.fit(plain.awkward(spark), labels))
    assert kept.filter("other = 'own'").count() == len(plain.AWKWARD)


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.report(plain.empty(spark), labels).collect() == []
    assert len({r["score"] for r in toxicity.report(plain.awkward(spark), labels).collect()}) == 1
