"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed 1- to 3-grams per language are summed by Spark over a bounded sample of labelled
rows; the smoothed log-probability matrix (classes x features, fixed size) is sent to the tasks, and
batches are scored as sparse count matrices in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import BATCH_SETTING, computed, held_out, learnable, pieces, sampled

FEATURE_BITS = 14
ORDERS = (1, 2, 3)
SMOOTHING = 0.1
SAMPLE_ROWS = 20_000
UNDETERMINED = "und"
# More classes than this are refused: the matrix has classes x 2^14 doubles.
MAX_CLASSES = 512
# Odd multipliers that spread code points over 32 bits, one for each place of an n-gram.
MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], np.uint64)
GATHER = 1 << 18
# Features times classes that are multiplied at once.
GATHER_CELLS = 1 << 20


def ngram_features(text: str, bits: int = FEATURE_BITS) -> np.ndarray:
    """Feature numbers of every character n-gram of the lower-cased text, repeats included."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found = []
    for order in ORDERS:
        if len(points) < order:
            break
        mixed = np.full(len(points) - order + 1, order, np.uint64)
        for k in range(order):
            mixed = (mixed * np.uint64(31) + points[k : len(points) - order + 1 + k]) * MULTIPLIERS[k]
            mixed ^= mixed >> np.uint64(29)
        found.append(((mixed * MULTIPLIERS[0]) >> np.uint64(20)) & np.uint64((1 << bits) - 1))
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)


@dataclass(frozen=True)
class Model:
    classes: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # features x classes

    def score(self, text: str | None) -> tuple[str, float]:
        """The likeliest class and its posterior; `und` and 0 if there is no letter or no class."""
        return self.scores([text])[0]

    def scores(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """`score` of each text; several are one sparse matrix of counts (row starts, features, counts)."""
        found = [(UNDETERMINED, 0.0)] * len(texts)
        if not self.classes:
            return found
        bits, most = int(len(self.log_prob)).bit_length() - 1, max(1, GATHER_CELLS // len(self.classes))
        totals = np.tile(self.log_prior, (len(texts), 1))
        told = [i for i, text in enumerate(texts) if text is not None and any(map(str.isalpha, text))]
        rows, held = [], 0
        for i in told:
            features = ngram_features(texts[i], bits)
            for at in range(0, len(features), GATHER):
                numbers, counts = np.unique(features[at : at + GATHER], return_counts=True)
                if rows and held + len(numbers) > most:
                    self._add(totals, rows)
                    rows, held = [], 0
                rows.append((i, numbers, counts))
                held += len(numbers)
        if rows:
            self._add(totals, rows)
        best = totals.argmax(axis=1)
        for i in told:
            found[i] = self.classes[best[i]], float(1.0 / np.exp(totals[i] - totals[i, best[i]]).sum())
        return found

    def _add(self, totals: np.ndarray, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        """Adds the product of the sparse rows (place in `totals`, features, counts) and `log_prob`."""
        starts = np.cumsum([0, *(len(numbers) for _, numbers, _ in rows[:-1])])
        cells = self.log_prob[np.concatenate([numbers for _, numbers, _ in rows])]
        cells *= np.concatenate([counts for _, _, counts in rows])[:, None]
        # A long text has several rows.
        np.add.at(totals, [i for i, _, _ in rows], np.add.reduceat(cells, starts, axis=0))


def _count(bits: int):
    """Per task: a row (class, feature, n) for every pair met."""

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                for label, text in zip(piece.column("label").to_pylist(), piece.column("text").to_pylist()):
                    sums = totals.setdefault(label, np.zeros(1 << bits, np.int64))
                    sums += np.bincount(ngram_features(text or "", bits), minlength=1 << bits)
        for label, sums in totals.items():
            hit = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(hit), pa.string()), pa.array(hit, pa.int64()), pa.array(sums[hit], pa.int64())], names=["label", "feature", "n"])

    return run


def fit(rows: DataFrame, label: str = "lang", key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS, bits: int = FEATURE_BITS) -> Model:
    """Fit on rows with a non-null label; of more than `sample_rows` a sample by hash of the key.

    What reaches the driver is the table of counts, at most classes x 2^bits rows. Classes have equal
    priors. No rows give a model without classes.
    """
    rows.sparkSession.conf.set(*BATCH_SETTING)
    labelled = sampled(rows.filter(F.col(label).isNotNull()), F.col(key), sample_rows)
    labelled = labelled.select(F.col(label).cast("string").alias("label"), F.coalesce(text, F.lit("")).alias("text"))
    classes = [r[0] for r in labelled.select("label").distinct().limit(MAX_CLASSES + 1).collect()]
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    classes = sorted(classes)
    counted = labelled.mapInArrow(_count(bits), "label string, feature bigint, n bigint").groupBy("label", "feature").agg(F.sum("n").alias("n")).toPandas()
    counts = np.full((1 << bits, len(classes)), SMOOTHING)
    place = {c: i for i, c in enumerate(classes)}
    np.add.at(counts, (counted["feature"].to_numpy(int), counted["label"].map(place).to_numpy(int)), counted["n"].to_numpy(float))
    return Model(classes, np.zeros(len(classes)), np.log(counts / counts.sum(axis=0)) if classes else counts)


def _task(shared):
    model = Model(*shared.value)

    def work(texts):
        found = model.scores(texts)
        return [[f[0] for f in found], [f[1] for f in found]]

    return work


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, the posterior of that class.

    Null texts, texts without a letter and a model without classes give `und` and 0. Ties go to the
    class first in alphabetical order.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.classes, model.log_prior, model.log_prob))
    return computed(docs, {"lang_pred": "string", "score": "double"}, partial(_task, shared), text)


def report(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    model = fit(docs.filter(learnable(F.col("doc_id"))))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
