"""Quality rules: counting rules, and line labels by a linear-chain conditional random field.

The field has two states, content and boilerplate. Its weights are fitted to the lines of documents
with a quality label (a bounded sample); Viterbi decoding marks every line of every document, and the
share of words in content lines decides retention, beside the counting rules.
"""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import BATCH_SETTING, computed, fresh_names, pieces, sampled

SAMPLE_ROWS = 4_000
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MIN_CONTENT = 0.5
# The characters counted as symbols, and the six blanks between words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MARKS = "!?"
STEPS = 300
PENALTY = 1e-3
MAX_TRANSITION = 0.7
FEATURES = 11
FIELDS = {
    "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint",
    "base_failed": "boolean", "kept": "boolean", "content_share": "double", "line_labels": "array<int>",
}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight found twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if len(numbers) == n:
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    key = np.zeros(n - WINDOW + 1, np.uint64)
    for k in range(WINDOW):
        key = key * np.uint64(0xD6E8FEB86659FD93) + mixed[k : n - WINDOW + 1 + k]
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order][1:] == key[order][:-1])
    left, right = order[same], order[same + 1]
    if not (windows[left] == windows[right]).all():  # two windows share a hash: compare the windows themselves
        _, inverse, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[inverse.ravel()] > 1)
    else:
        starts = np.union1d(left, right)
    edges = np.zeros(n + 1, np.int64)
    edges[starts] += 1
    np.subtract.at(edges, starts + WINDOW, 1)
    return int((np.cumsum(edges[:n]) > 0).sum())


def line_features(line: str, seen: bool) -> tuple[int, list[float]]:
    """Number of words of a line and its features, each between 0 and 1."""
    words = line.split()
    n = len(words)
    if not n:
        return 0, [1.0, 1.0, *[0.0] * (FEATURES - 2)]
    symbols = sum(map(line.count, SYMBOLS))
    return n, [
        1.0, 0.0, min(1.0, math.log1p(n) / 6), min(1.0, symbols / n), sum(map(str.isupper, words)) / n,
        sum(map(str.isdigit, words)) / n, sum(map(operator.eq, words, words[1:])) / n, 1.0 - len(set(words)) / n,
        min(1.0, sum(map(line.count, MARKS)) / n), float(words[-1][-1] in ".!?:;"), float(seen),
    ]


def document_features(text: str) -> tuple[list[int], list[list[float]]]:
    """Words and features of each line, split at line feeds."""
    counts, rows, seen = [], [], set()
    for line in text.split("\n"):
        n, row = line_features(line, line in seen)
        seen.add(line)
        counts.append(n)
        rows.append(row)
    return counts, rows


@dataclass(frozen=True)
class Chain:
    """Weights of the boilerplate state against content, and transition scores [from][to]."""

    weights: list[float]
    moves: list[list[float]]

    def decode(self, rows: list[list[float]]) -> list[int]:
        """The best label sequence (1 for boilerplate) by Viterbi; ties go to content."""
        if not rows:
            return []
        (cc, cb), (bc, bb) = self.moves
        unary = (np.asarray(rows) @ np.asarray(self.weights)).tolist()
        content, boiler, back = 0.0, unary[0], []
        for u in unary[1:]:
            to_c = (0, content + cc) if content + cc >= boiler + bc else (1, boiler + bc)
            to_b = (0, content + cb) if content + cb >= boiler + bb else (1, boiler + bb)
            back.append((to_c[0], to_b[0]))
            content, boiler = to_c[1], to_b[1] + u
        state = int(boiler > content)
        labels = [state]
        for step in reversed(back):
            state = step[state]
            labels.append(state)
        return labels[::-1]


def fit_chain(sequences: list[np.ndarray], labels: list[int]) -> Chain:
    """Maximum conditional likelihood by gradient steps (Adam); all lines of a sequence have its label.

    Sequences are walked step by step together, longest first. Transition scores are kept within
    +-`MAX_TRANSITION`, as document labels never show a change of state.
    """
    if not sequences:
        return Chain([0.0] * FEATURES, [[0.0, 0.0], [0.0, 0.0]])
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    lengths = np.array([len(sequences[i]) for i in order])
    flat = np.concatenate([sequences[i] for i in order])
    truth = np.repeat(np.array([labels[i] for i in order]), lengths)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    active = [starts[: int((lengths > t).sum())] + t for t in range(int(lengths[0]))]
    n = len(flat)
    theta, m, v = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
    same = truth[1:] == truth[:-1]
    inner = np.ones(n, bool)
    inner[starts] = False
    seen = np.zeros((2, 2))
    for a in (0, 1):
        seen[a, a] = (same & inner[1:] & (truth[1:] == a)).sum()
    for step in range(1, STEPS + 1):
        moves = theta[FEATURES:].reshape(2, 2)
        unary = np.stack([np.zeros(n), flat @ theta[:FEATURES]], axis=1)
        alpha, beta = unary.copy(), np.zeros((n, 2))
        for at in active[1:]:
            alpha[at] += np.logaddexp(alpha[at - 1, :1] + moves[0], alpha[at - 1, 1:] + moves[1])
        for at in reversed(active[1:]):
            ahead = unary[at] + beta[at]
            beta[at - 1] = np.logaddexp(ahead[:, :1] + moves[:, 0], ahead[:, 1:] + moves[:, 1])
        total = np.logaddexp(*(alpha + beta).T)
        chance = np.exp(alpha[:, 1] + beta[:, 1] - total)
        inside = np.flatnonzero(inner)
        pair = alpha[inside - 1][:, :, None] + moves + (unary[inside] + beta[inside])[:, None, :] - total[inside][:, None, None]
        slope = np.concatenate([flat.T @ (truth - chance), (seen - np.exp(pair).sum(axis=0)).ravel()]) / n - PENALTY * theta
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        theta[FEATURES:] = np.clip(theta[FEATURES:], -MAX_TRANSITION, MAX_TRANSITION)
    return Chain(theta[:FEATURES].tolist(), theta[FEATURES:].reshape(2, 2).tolist())


def _features(batches):
    for batch in batches:
        for piece in pieces(batch, "text"):
            rows = [np.asarray(document_features(t)[1], np.float32).tobytes() for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("quality"), pa.array(rows, pa.binary())], names=["quality", "rows"])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Chain:
    """Fit on documents with a non-null quality label, of more than `sample_rows` a sample by hash of the key.

    Only line features of the sample reach the driver. A key with several labels counts as its worst.
    No labelled rows give a chain that marks nothing as boilerplate.
    """
    docs.sparkSession.conf.set(*BATCH_SETTING)
    marks = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(F.col(label).cast("int")).alias("quality"))
    marks = sampled(marks, F.col(key), sample_rows)
    rows = docs.filter(F.length(text) > 0).select(key, F.col(text).alias("text")).join(marks, key).select("text", "quality")
    found = rows.mapInArrow(_features, "quality int, rows binary").collect()
    sequences = [np.frombuffer(r["rows"], np.float32).reshape(-1, FEATURES).astype(float) for r in found]
    return fit_chain(sequences, [1 - r["quality"] for r in found])


def judge(text: str | None, chain: Chain, min_content: float) -> tuple:
    """The values of `FIELDS` for one text."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    repeats = repeated_words(words)
    written = [line for line in text.split("\n") if line.strip(BLANKS)]
    counts, rows = document_features(text)
    labels = chain.decode(rows)
    total = sum(counts)
    share = sum(c for c, label in zip(counts, labels) if not label) / total if total else 0.0
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    return (
        n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(written) - len(set(written)), repeats,
        failed, not failed and share >= min_content, share, labels,
    )


def _task(weights, moves, min_content):
    chain = Chain(weights, moves)
    return lambda texts: list(map(list, zip(*[judge(t, chain, min_content) for t in texts])))


def judged(docs: DataFrame, chain: Chain, min_content: float = MIN_CONTENT, text: str = "text") -> DataFrame:
    """`docs` with the columns of `FIELDS`; `line_labels` has 1 for each boilerplate line.

    Null and empty texts have no words, fail the counting rules and have a share of 0. Rows stay, also
    repeated ones; an empty table gives an empty one.
    """
    return computed(docs, FIELDS, partial(_task, chain.weights, chain.moves, min_content), text)


def retained(docs: DataFrame, chain: Chain, min_content: float = MIN_CONTENT, text: str = "text") -> DataFrame:
    """The rows of `docs` that pass the counting rules and the share of content, with their own columns.

    Null, empty and short texts fail the counting rules. Very long texts are judged whole, one at a time.
    Repeated rows stay or go together; an empty table gives an empty one.
    """
    own = fresh_names(docs, "kept")[0]
    verdict = computed(docs, {own: "boolean"}, partial(_verdict, chain.weights, chain.moves, min_content), text)
    return verdict.filter(F.col(own)).drop(own)


def _verdict(weights, moves, min_content):
    place = list(FIELDS).index("kept")
    chain = Chain(weights, moves)
    return lambda texts: [[judge(t, chain, min_content)[place] for t in texts]]


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    found = judged(docs.select("doc_id", "text"), fit(docs, labels))
    return found.drop("text", "line_labels")
