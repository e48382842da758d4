"""Secret scans: patterns, and a log-likelihood ratio of two character Markov models.

One model describes random strings and one ordinary identifiers; both are first-order chains over a
fixed alphabet. They are trained from samples that the patterns label: what a pattern matched is
random, every other run of the same characters is ordinary. As one corpus may know few kinds of either,
the random model also counts expected transitions of the usual alphabets, and the ordinary one those of
identifiers: the words of the corpus and of sample identifiers joined in camel case, by underscores,
dashes and slashes, in upper case and with numbers, and dates and ruled lines. A run of `LEAST_RUN` characters or more beside the pattern
matches is a secret if random is likelier by more than the odds that runs are ordinary.
"""

from __future__ import annotations

import importlib
import math
import re
from bisect import bisect_left
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import BATCH_SETTING, computed, pieces

# The kinds in their order, patterns and least lengths.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# A run of 24 or more hexadecimal digits; the whole run is the leftmost match that HEX has there.
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

LEAST_RUN = 8
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-"
STATES = len(ALPHABET)
SMOOTHING = 0.5
PRIOR_ODDS = 1e4  # ordinary runs for one random run
ORDINARY = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
RANDOM_PART = re.compile(r"[A-Za-z0-9+/_=-]{6,}")
# Usual alphabets of random strings, as places in ALPHABET: capitals and digits, letters and digits, base
# 64, small letters, and hexadecimal digits in either case. Each weighs as much as this many characters
# at least, and all of them together as much as the corpus' own random strings.
USUAL = tuple(np.r_[part] for part in (np.s_[0:36], np.s_[0:62], np.s_[0:64], np.s_[36:62], np.s_[0:10, 36:42], np.s_[0:16]))
USUAL_CHARS = 5_000
# Shares of the ordinary model: identifiers made of words, and within them each shape's. A word of an
# identifier is shorter than the runs that are counted, so its joints weigh more.
IDENTIFIER_SHARE = 0.2
SHAPES = {"camel": 0.35, "_": 0.25, "upper": 0.2, "/": 0.1, "-": 0.1}
JOINTS = 1.6
SAMPLE_SHARE = 0.3  # of the words of identifiers, by weight
SAMPLE_FLOOR = 0.1  # transitions no sample has
NUMBER_SHARE = 0.04  # letters followed by a number, at each joint
DATE_SHARE = 0.02
RULE_SHARE = 0.01
# Modules of the standard library whose names are the sample identifiers.
SAMPLE_MODULES = (
    "builtins", "os", "string", "datetime", "decimal", "email", "functools", "http", "importlib", "itertools", "math", "operator", "random", "re",
    "shutil", "sqlite3", "statistics", "struct", "tempfile", "time", "types", "unittest", "urllib.parse", "zipfile", "token", "stat", "tarfile")
SAMPLE_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DIGITS, UPPER, LOWER = slice(0, 10), slice(10, 36), slice(36, 62)
PLACE = np.full(128, STATES, np.int64)  # blanks between runs stand for a start
PLACE[[ord(c) for c in ALPHABET]] = np.arange(STATES)
FIELDS = {"n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_spans": "array<string>", "spans": "array<string>"}

Span = tuple[int, int, int]  # start, kind's place, end


def base_spans(text: str) -> list[Span]:
    """Matches of the three patterns that are long enough, by start and kind; ends are exclusive."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def _codes(runs: str) -> np.ndarray:
    """Places in the alphabet of a run, or of several between blanks, after a start."""
    return PLACE[np.frombuffer(b" " + runs.encode(), np.uint8)]


def labelled_runs(text: str) -> tuple[list[str], list[str]]:
    """Training samples of one text: ordinary runs, and parts of what the patterns matched."""
    spans = base_spans(text)
    if not spans:
        return ORDINARY.findall(text), []
    values = [ASSIGN.match(text, start)[2] if kind == 0 else text[start:end] for start, kind, end in spans]
    taken = Taken(spans)
    ordinary = [m[0] for m in ORDINARY.finditer(text) if not taken.overlaps(*m.span())]
    return ordinary, [part for value in values for part in RANDOM_PART.findall(value)]


class Taken:
    """The union of some spans, to ask whether a stretch overlaps it."""

    def __init__(self, spans: list[Span]):
        self.starts, self.ends = [], []
        for start, _, end in spans:  # by start
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end) - 1
        return at >= 0 and start < self.ends[at]


def _count(batches):
    """Per task: (random, from, to, n); `from` is `STATES` at a run's start."""
    sums = np.zeros((2, (STATES + 1) ** 2), np.int64)
    for batch in batches:
        for piece in pieces(batch, "text"):
            samples = [labelled_runs(t) for t in piece.column("text").to_pylist() if t]
            for side in (0, 1):
                codes = _codes(" ".join(run for own in samples for run in own[side]))
                sums[side] += np.bincount(codes[:-1] * (STATES + 1) + codes[1:], minlength=sums.shape[1])
    label, pair = np.nonzero(sums)
    before, after = pair // (STATES + 1), pair % (STATES + 1)
    yield pa.RecordBatch.from_arrays([pa.array(label == 1), pa.array(before), pa.array(after), pa.array(sums[label, pair])], names=["random", "before", "after", "n"])


def fit(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratio of random against ordinary by (character before, character).

    Transition counts over all documents are summed by Spark; at most 2 x 68 x 68 sums reach the
    driver. Rare transitions lean on the characters' own frequencies.
    """
    docs.sparkSession.conf.set(*BATCH_SETTING)
    counted = docs.select(F.col(text).alias("text")).mapInArrow(_count, "random boolean, before bigint, after bigint, n bigint")
    sums = np.zeros((2, STATES + 1, STATES + 1))
    for row in counted.groupBy("random", "before", "after").agg(F.sum("n").alias("n")).collect():
        sums[int(row["random"]), row["before"], row["after"]] = row["n"]
    return log_ratios(sums[0], sums[1])


def sample_identifiers(modules: tuple[str, ...] = SAMPLE_MODULES) -> list[str]:
    """Names of the modules and of their classes: labelled samples of identifiers."""
    found: set[str] = set()
    for module in modules:
        own = importlib.import_module(module)
        for name in dir(own):
            found.add(name)
            if isinstance(value := getattr(own, name, None), type):
                found.update(dir(value))
    return sorted(found)


def _letters(words: list[str]) -> np.ndarray:
    """Transitions of lower-case words, from a start and to an end, by letter; 26 stands for both."""
    codes = np.concatenate([np.frombuffer(f"{{{w}{{".encode(), np.uint8) for w in words]).astype(np.int64) - ord("a")
    return np.bincount(codes[:-1] * 27 + codes[1:], minlength=27 * 27).reshape(27, 27).astype(float)


def identifiers(ordinary: np.ndarray, ends: np.ndarray, samples: list[str]) -> np.ndarray:
    """Expected transitions of identifiers made of the ordinary runs' letters and of the samples' words, as shares.

    `ends` counts the characters that runs end with.
    """
    both = lambda m: m[..., LOWER] + m[..., UPPER]
    known = _letters([w.lower() for name in samples for w in SAMPLE_WORD.findall(name)] or ["a"])
    own = both(ordinary[LOWER, :]) + both(ordinary[UPPER, :])
    size = max(USUAL_CHARS, own.sum())

    def mixed(corpus: np.ndarray, sample: np.ndarray) -> np.ndarray:
        return (1 - SAMPLE_SHARE) * (corpus + 0.05) / (corpus + 0.05).sum() + SAMPLE_SHARE * (sample + SAMPLE_FLOOR) / (sample + SAMPLE_FLOOR).sum()

    inner = size * mixed(own, known[:26, :26])
    first = size / 5 * mixed(both(ordinary[STATES]), known[26, :26])
    last = size / 5 * mixed(both(ends), known[:26, 26])
    follow = inner / inner.sum(axis=1, keepdims=True)
    joint, size = np.outer(last / last.sum(), first / first.sum()), inner.sum()
    # Each shape has the inside of words, and as many joints as there are words.
    words = JOINTS * first.sum() / size
    first, last, inner = first / first.sum(), last / last.sum(), inner / size
    found = np.zeros_like(ordinary)
    for shape, share in SHAPES.items():
        own = np.zeros_like(ordinary)
        letters = UPPER if shape == "upper" else LOWER
        own[letters, letters] += inner
        own[STATES, letters] += words * first / 3
        if shape == "camel":
            own[LOWER, UPPER] += words * joint
            own[UPPER, LOWER] += words * first[:, None] * follow
            own[STATES, UPPER] += words * first / 3
        else:
            mark = ALPHABET.index("_" if shape == "upper" else shape)
            own[letters, mark] += words * last
            own[mark, letters] += words * first
            own[STATES, mark] += words / 6
            own[mark, DIGITS] += words * NUMBER_SHARE / 10
        own[letters, DIGITS] += words * NUMBER_SHARE * last[:, None] / 10
        own[DIGITS, letters] += words * NUMBER_SHARE * first / 10
        found += share * own / own.sum()
    dates, dash = np.zeros_like(ordinary), ALPHABET.index("-")
    dates[DIGITS, DIGITS] += 0.7 / 100
    dates[DIGITS, dash] += 0.1 / 10
    dates[dash, DIGITS] += 0.1 / 10
    dates[STATES, DIGITS] += 0.08 / 10
    dates[DIGITS, ALPHABET.index("T")] += 0.01 / 10
    dates[ALPHABET.index("T"), DIGITS] += 0.01 / 10
    rules = np.zeros_like(ordinary)
    for mark in "=-_+/":
        at = ALPHABET.index(mark)
        rules[at, at] += 0.19
        rules[STATES, at] += 0.01
    return (1 - DATE_SHARE - RULE_SHARE) * found + DATE_SHARE * dates + RULE_SHARE * rules


def log_ratios(ordinary: np.ndarray, random: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio by (before, after) from transition counts; the last column, a run's end, is zero."""
    ends, ordinary, random = ordinary[:, STATES], ordinary[:, :STATES], random[:, :STATES]
    usual = np.zeros_like(random)
    each = max(USUAL_CHARS, random.sum() / len(USUAL))
    for part in USUAL:
        usual[np.ix_(part, part)] += each / len(part) ** 2
        usual[STATES, part] += each / len(part) / 32
    # Hexadecimal digits come in groups too, with dashes between.
    dash, grouped = ALPHABET.index("-"), USUAL[-2]
    usual[grouped, dash] += each / len(grouped) / 9
    usual[dash, grouped] += each / len(grouped) / 9
    made = identifiers(ordinary, ends, sample_identifiers())
    weight = max(USUAL_CHARS, ordinary.sum()) * IDENTIFIER_SHARE / (1 - IDENTIFIER_SHARE)
    logs = []
    for own in (ordinary + weight * made, random + usual):
        single = (own.sum(axis=0) + 1.0) / (own.sum() + STATES)
        lean = SMOOTHING * STATES
        logs.append(np.log((own + lean * single) / (own.sum(axis=1, keepdims=True) + lean)))
    return np.hstack([logs[1] - logs[0], np.zeros((STATES + 1, 1))])


def markov_spans(text: str, ratios: np.ndarray, base: list[Span]) -> list[Span]:
    """Runs beside the base spans whose ratio is above the prior odds; a run that holds a base span is
    scored in the parts around it."""
    # One byte for each code point; those outside the alphabet end a run.
    codes = PLACE[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
    for start, _, end in base:
        codes[start:end] = STATES
    inside = np.flatnonzero(np.diff(np.concatenate([[False], codes < STATES, [False]])))
    starts, ends = inside[::2], inside[1::2]
    long = ends - starts >= LEAST_RUN
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return []
    before = np.concatenate([[STATES], codes[:-1]])
    totals = np.concatenate([[0.0], np.cumsum(ratios.ravel()[before * (STATES + 1) + codes])])
    found = totals[ends] - totals[starts] > math.log(PRIOR_ODDS)
    return [(a, 3, b) for a, b in zip(starts[found].tolist(), ends[found].tolist())]


def scan(text: str | None, ratios: np.ndarray) -> tuple:
    """The values of `FIELDS` for one text."""
    text = text or ""
    base = base_spans(text)
    every = sorted(base + markov_spans(text, ratios, base))
    kinds = [k for _, k, _ in base]
    shown = [[f"{KINDS[k]}:{a}:{b}" for a, k, b in spans] for spans in (base, every)]
    return kinds.count(0), kinds.count(1), kinds.count(2), shown[0], shown[1]


def _task(ratios):
    return lambda texts: list(map(list, zip(*[scan(t, ratios) for t in texts])))


def scanned(docs: DataFrame, ratios: np.ndarray, text: str = "text") -> DataFrame:
    """`docs` with the columns of `FIELDS`: counts of base spans, base spans and all spans.

    A span is kind:start:end in code points, by start and kind. Null and empty texts have none. Very long
    texts are scanned whole, in memory that grows with the text alone. Rows stay as they are, repeated
    ones too; an empty table gives an empty one. Columns named like an added one are replaced.
    """
    return computed(docs, FIELDS, partial(_task, ratios), text)


def report(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    found = scanned(docs.select("doc_id", "text"), fit(docs))
    base = F.sha2(F.array_join("base_spans", ","), 256)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", base.alias("base_sha256"), F.array_join("spans", ",").alias("spans"))
