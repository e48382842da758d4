"""Toxicity by maximum-scoring segments of token log-odds.

Words, and beginnings of words for those not seen before, get log-odds of toxic against clean labelled
documents under an informative Dirichlet prior (the pooled frequencies). Only those whose log-odds
stand out (z-score) keep a score; all other words cost a constant, so a random clean text drifts
downward. A linear scan finds every maximal
segment; its tail under clean text follows an extreme-value law whose parameters are fitted to clean
documents. A document's significant segments add up, in units of surprise, and a logistic curve
fitted to labelled documents turns the sum into a score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import BATCH_SETTING, computed, held_out, learnable, pieces, sampled
from perigee.runtime import materialize

SAMPLE_ROWS = 20_000
PRIOR_SHARE = 0.1  # weight of the prior, as a share of all counts
MIN_Z = 3.0
MIN_ODDS = 1.5
STEMS = (8, 7, 6, 5, 4, 3)  # letters of the beginnings tried where a word is unknown, in this order
MEMO_WORDS = 300_000  # words whose score a task remembers before it starts anew
FLOOR = -0.15  # what a word without a score costs
MAX_WORD_SCORE = 8.0
MAX_P = 0.05  # a segment is significant below this chance per document
PREDICT_FROM = 0.3
TOKEN = re.compile(r"[^\W\d_]+")
# Entries of the score table sent to tasks; the training sample bounds them far below.
MAX_TABLE = 2_000_000


def tokens(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return TOKEN.findall((text or "").lower())


def features(word: str) -> list[str]:
    """The word and its beginnings; a trailing dash marks a beginning."""
    return [word, *[word[:n] + "-" for n in STEMS if n < len(word)]]


class Lexicon(dict):
    """Scores of words by the longest of their features that has one; None where none has."""

    def __init__(self, scores: dict[str, float]):
        super().__init__()
        self.scores = scores

    def __missing__(self, word: str) -> float | None:
        if len(self) > MEMO_WORDS:
            self.clear()
        found = self[word] = next((s for f in features(word) if (s := self.scores.get(f)) is not None), None)
        return found

    def marked(self, words: list[str]) -> list[tuple[int, float]]:
        return [(i, s) for i, s in enumerate(map(self.__getitem__, words)) if s is not None]


def maximal_segments(scores: list[tuple[int, float]], length: int, floor: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) of a text of `length` words, in order.

    `scores` are the words that don't cost `floor`, as (position, score). One pass in time proportional
    to the scored words, by Ruzzo and Tompa's method: each candidate knows the nearest one before it that
    starts from a lower total, so a search skips all between; where none does, the candidates so far
    can't grow any more and are done.
    """
    done: list[tuple[int, int, float]] = []
    stack: list[tuple[int, int, float, float, int]] = []  # begin, end, total before, total at end, the nearest lower start
    total, at = 0.0, 0
    for place, score in scores:
        total += floor * (place - at)
        at = place + 1
        if score <= 0:
            total += score
            continue
        begin, before = place, total
        total += score
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= before:
                k = stack[k][4]
            if k < 0:
                done += [(b, e, high - low) for b, e, low, high, _ in stack]
                stack.clear()
            if k < 0 or stack[k][3] >= total:
                stack.append((begin, place + 1, before, total, k))
                break
            begin, before = stack[k][0], stack[k][2]
            del stack[k:]
    return done + [(b, e, high - low) for b, e, low, high, _ in stack]


@dataclass(frozen=True)
class Model:
    """`scores` by feature; `rate`, `size`: the extreme-value law; `weight`, `bias`: the logistic curve."""

    lexicon: Lexicon
    floor: float
    rate: float
    size: float
    weight: float
    bias: float

    def segments(self, text: str | None) -> tuple[list[tuple[int, int, float, float]], int]:
        """Significant segments (begin word, end word, score, surprise) and the number of words."""
        found = tokens(text)
        marked = self.lexicon.marked(found)
        if not marked:
            return [], len(found)
        kept = []
        for begin, end, score in maximal_segments(marked, len(found), self.floor):
            surprise = self.surprise(score, len(found))
            if surprise > -math.log(MAX_P):
                kept.append((begin, end, score, surprise))
        return kept, len(found)

    def surprise(self, score: float, length: int) -> float:
        """-log of the chance that clean text of `length` words has a segment of this score."""
        expected = self.size * max(length, 1) * math.exp(-min(self.rate * score, 700.0))
        chance = -math.expm1(-expected)
        return -math.log(max(chance, 1e-300))

    def score(self, text: str | None) -> float:
        kept, _ = self.segments(text)
        return 1.0 / (1.0 + math.exp(-(self.bias + self.weight * math.log1p(sum(k[3] for k in kept)))))


def _count(batches):
    """Per task: (feature, toxic documents, clean documents) that have it."""
    sums: dict[str, list[int]] = {}
    for batch in batches:
        for piece in pieces(batch, "text"):
            for toxic, text in zip(piece.column("toxic").to_pylist(), piece.column("text").to_pylist()):
                side = 0 if toxic else 1
                for feature in {f for word in set(tokens(text)) for f in features(word)}:
                    entry = sums.get(feature)
                    if entry is None:
                        entry = sums[feature] = [0, 0]
                    entry[side] += 1
            if len(sums) > 200_000:
                yield _counted(sums)
                sums.clear()
    if sums:
        yield _counted(sums)


def _counted(sums):
    values = np.array(list(sums.values()), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(values[:, 0]), pa.array(values[:, 1])], names=["feature", "toxic", "clean"])


def feature_scores(labelled: DataFrame) -> dict[str, float]:
    """Log-odds of the features that stand out, from rows (text, toxic); a count is a document."""
    counts = labelled.mapInArrow(_count, "feature string, toxic bigint, clean bigint").groupBy("feature")
    counts = materialize(counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")), "feature-counts")
    total = counts.agg(F.sum("t").alias("toxic"), F.sum("c").alias("clean")).first()
    all_t, all_c = float(total["toxic"] or 0), float(total["clean"] or 0)
    weight = PRIOR_SHARE * (all_t + all_c)
    prior = F.lit(PRIOR_SHARE) * (F.col("t") + F.col("c"))
    t, c = F.col("t") + prior, F.col("c") + prior
    odds = F.log(t / (F.lit(all_t + weight) - t)) - F.log(c / (F.lit(all_c + weight) - c))
    scored = counts.select("feature", odds.alias("odds"), (odds / F.sqrt(1 / t + 1 / c)).alias("z"))
    rows = scored.filter((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_ODDS)).select("feature", "odds").limit(MAX_TABLE + 1).collect()
    if len(rows) > MAX_TABLE:
        raise ValueError("the score table is larger than its bound; fit on fewer rows")
    return {r["feature"]: min(MAX_WORD_SCORE, r["odds"]) for r in rows}


def _best(scores: dict[str, float], floor: float):
    """Per document: (toxic, number of words, scores of all its segments)."""

    def run(batches):
        lexicon = Lexicon(scores)
        for batch in batches:
            for piece in pieces(batch, "text"):
                lengths, found = [], []
                for text in piece.column("text").to_pylist():
                    split = tokens(text)
                    marked = lexicon.marked(split)
                    lengths.append(len(split))
                    found.append([s for _, _, s in maximal_segments(marked, len(split), floor)])
                yield pa.RecordBatch.from_arrays([piece.column("toxic"), pa.array(lengths, pa.int64()), pa.array(found, pa.list_(pa.float64()))], names=["toxic", "length", "scores"])

    return run


def extreme_value(scores: np.ndarray, words: float) -> tuple[float, float]:
    """Rate and size of the law for clean text: size * length * exp(-rate * x) segments of score x or
    more are expected, and the best one follows exp of minus that (Gumbel).

    The rate is the inverse mean excess over the least score, as segment scores have an exponential
    tail; the top twentieth is left to label noise. Without segments the law has rate 1 and expects
    half a segment.
    """
    if not len(scores):
        return 1.0, 0.5 / max(words, 1.0)
    kept = scores[scores <= np.quantile(scores, 0.95)]
    least = float(scores.min())
    rate = float(np.clip(1.0 / max((kept - least).mean(), 1e-6), 0.2, 5.0))
    return rate, len(scores) / max(words, 1.0) * math.exp(rate * least)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Weight and bias by Newton steps with a small penalty; one class alone gives a flat curve."""
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    beta = np.array([0.0, math.log(rate / (1 - rate))])
    if len(np.unique(y)) < 2:
        return 0.0, float(beta[1])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (y - p) - 0.01 * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on documents with a non-null label; of more than `sample_rows` a sample by hash of the key.

    Counts are summed by Spark; the driver gets the features that stand out and, for the sample's
    documents, their segment scores. Several labels of a key count as toxic if one is. No labelled
    rows give a model that scores everything alike.
    """
    docs.sparkSession.conf.set(*BATCH_SETTING)
    marks = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    marks = sampled(marks, F.col(key), sample_rows)
    rows = docs.select(key, F.coalesce(text, F.lit("")).alias("text")).join(marks, key)
    # Copies of a text say nothing new: one of them counts.
    rows = materialize(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "labelled")
    scores = feature_scores(rows)
    found = rows.mapInArrow(_best(scores, FLOOR), "toxic int, length bigint, scores array<double>").toPandas()
    toxic = found["toxic"].to_numpy(int) == 1
    lengths = found["length"].to_numpy(float)
    clean = [x for own, bad in zip(found["scores"], toxic) if not bad for x in own]
    rate, size = extreme_value(np.array(clean, float), float(lengths[~toxic].sum()))
    shape = Model(Lexicon(scores), FLOOR, rate, size, 1.0, 0.0)
    total = np.array([sum(u for u in (shape.surprise(s, int(n)) for s in own) if u > -math.log(MAX_P)) for own, n in zip(found["scores"], lengths)], float)
    weight, bias = logistic(np.log1p(total), toxic.astype(float))
    return Model(Lexicon(scores), FLOOR, rate, size, weight, bias)


def _task(shared):
    scores, *law = shared.value
    model = Model(Lexicon(scores), *law)

    def work(texts):
        scores, spans = [], []
        for text in texts:
            kept, _ = model.segments(text)
            scores.append(1.0 / (1.0 + math.exp(-(model.bias + model.weight * math.log1p(sum(k[3] for k in kept))))))
            spans.append([f"{b}:{e}" for b, e, _, _ in kept])
        return [scores, spans]

    return work


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1) and `toxic_spans` (begin:end in words of letters, end exclusive).

    Null and empty texts score like a text without any scored word. Rows stay as they are, repeated
    ones too.
    """
    state = (model.lexicon.scores, model.floor, model.rate, model.size, model.weight, model.bias)
    shared = docs.sparkSession.sparkContext.broadcast(state)
    return computed(docs, {"score": "double", "toxic_spans": "array<string>"}, partial(_task, shared), text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    model = fit(docs, labels.filter(learnable(F.col("doc_id"))))
    found = score(docs.select("doc_id", "text"), model)
    out = held_out(F.col("doc_id")).alias("held_out")
    return found.select("doc_id", out, "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"), F.array_join("toxic_spans", ",").alias("spans"))
