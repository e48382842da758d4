"""Token counts of every prefix by dynamic programming.

The last token of a prefix is the one token that ends there and stands next to the last token of the
rest, that is, whose pair with it is the encoding of the pair's own text. So a prefix has one token
more than the prefix before its last token, and one pass over a text yields the exact count of all its
prefixes. The counts are stored as steps, 16 bits for each code point; sums of steps then answer how
many tokens a prefix has and where a budget of tokens ends, without the tokenizer.

Tokens of the model reach neither over the start of a run of blanks nor from a letter to a sign that is
none, so the steps of a text are the steps of its parts (blanks with the letters, or with the other
signs, that follow) in a row, and frequent parts are remembered.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import partial
from operator import sub

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.llm.common import BATCH_SETTING, computed, without
from perigee.llm.pretrained import MAX_FILE_BYTES, RecentMemo, kept_in_worker

# The character that stands for a blank in the model's pieces.
BLANK = "▁"
# Letters of any script (raised digits count as signs), and every other sign but the blank.
LETTER = r"[^\W\d_²³¹]"
SIGN = rf"(?:[^\w{BLANK}]|[\d_²³¹])"
PARTS = re.compile(f"{BLANK}*(?:{LETTER}+|{SIGN}+)|{BLANK}+")
# What no piece may hold, so that parts are encoded on their own.
ACROSS = re.compile(f"[^{BLANK}]{BLANK}|{LETTER}{SIGN}|{SIGN}{LETTER}")
PAIR_ENTRIES = 1_000_000
# No token: what a prefix ends with after a character that has no piece of its own.
NONE = -1
STEP = np.dtype("<i2")


class PrefixCounter:
    """Counts of all prefixes for one SentencePiece BPE model."""

    def __init__(self, model: bytes):
        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        found = [i for i in range(own.get_piece_size()) if not (own.is_byte(i) or own.is_control(i) or own.is_unknown(i))]
        self.piece = {i: own.id_to_piece(i) for i in found}
        # Pieces of a higher score merge first, the leftmost of equal ones.
        self.score = {p: own.get_score(i) for i, p in self.piece.items()}
        if any(own.is_unused(i) for i in found) or own.encode("") or "".join(own.encode("  a ", out_type=str)) != BLANK * 3 + "a" + BLANK:
            raise ValueError("not a model that keeps every blank and adds one in front")
        if any(ACROSS.search(p) for p in self.score):
            raise ValueError("pieces reach over the start of a blank, or from letters to other signs")
        self.ends = ahocorasick.Automaton()
        for i, p in self.piece.items():
            self.ends.add_word(p, (i, len(p)))
        self.ends.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.memo = RecentMemo(self.part)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging its best neighbours."""
        parts = list(text)
        while len(parts) > 1:
            scores = [self.score.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            best = max(scores)
            if best == -np.inf:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stand(self, left: int, right: int) -> bool:
        """True if the two tokens are the encoding of their joined text."""
        a, b = self.piece[left], self.piece[right]
        found = self.merged(a + b) == [a, b]
        if len(self.pairs) >= PAIR_ENTRIES:
            self.pairs.clear()
        self.pairs[left << 32 | right] = found
        return found

    def part(self, text: str) -> bytes:
        """Steps of a part: how the count changes with each of its characters."""
        counts, last, pairs = [0], [NONE], self.pairs
        for end, (token, size) in self.ends.iter(text):
            while len(counts) <= end:
                # No piece ends here: the character is spelled as bytes.
                counts.append(counts[-1] + len(text[len(counts) - 1].encode()))
                last.append(NONE)
            if len(counts) > end + 1:
                continue
            start = end + 1 - size
            before = last[start]
            fits = before == NONE or pairs.get(before << 32 | token)
            if fits or fits is None and self.stand(before, token):
                counts.append(counts[start] + 1)
                last.append(token)
        while len(counts) <= len(text):
            counts.append(counts[-1] + len(text[len(counts) - 1].encode()))
        return array("h", map(sub, counts[1:], counts)).tobytes()

    def steps(self, text: str | None) -> bytes:
        """Steps of a whole text, one for each code point."""
        if not text:
            return b""
        found = bytearray().join(map(self.memo.__getitem__, PARTS.findall(BLANK + text.replace(" ", BLANK))))
        # The blank in front is no character of the text; its step belongs to the first one.
        own = np.frombuffer(found, STEP)[1:].copy()
        own[0] += np.frombuffer(found, STEP, 1)[0]
        return own.tobytes()


def model_file(spark: SparkSession, path: str):
    """A model file as a broadcast value; its size is checked."""
    with open(path, "rb") as f:
        model = f.read(MAX_FILE_BYTES + 1)
    if len(model) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    return spark.sparkContext.broadcast((path, model))


def _steps_task(shared):
    path, model = shared.value
    own = kept_in_worker(("prefix counts", path), lambda: PrefixCounter(model))
    return lambda texts: [pa.array([own.steps(t) for t in texts], pa.binary())]


def with_steps(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` with `steps`: for each code point of the text the change of the token count, 16 bits each.

    The sum of the first k steps is the number of tokens of the first k code points, as the SentencePiece
    model at `path` encodes them. Null and empty texts have no steps. A text is read once from start to
    end, so time and memory grow with its length alone. Repeated rows stay, an empty table gives an
    empty one, and a column `steps` of `docs` is replaced.
    """
    return computed(docs, {"steps": "binary"}, partial(_steps_task, model_file(docs.sparkSession, path)), text)


def n_tokens(steps: bytes | None) -> int:
    return int(np.frombuffer(steps or b"", STEP).sum(dtype=np.int64))


def tokens_at(steps: bytes | None, places: list[int]) -> list[int]:
    """Tokens of the prefixes of so many code points; places beyond either end count as that end."""
    totals = np.concatenate([[0], np.cumsum(np.frombuffer(steps or b"", STEP), dtype=np.int64)])
    return totals[np.clip(np.array(places, np.int64), 0, len(totals) - 1)].tolist()


def longest(steps: bytes | None, budget: int) -> tuple[int, int]:
    """Code points and tokens of the longest prefix of at most `budget` tokens.

    A longer prefix may have fewer tokens, so this may lie beyond the first place that is over budget.
    """
    totals = np.concatenate([[0], np.cumsum(np.frombuffer(steps or b"", STEP), dtype=np.int64)])
    fits = np.flatnonzero(totals <= max(budget, 0))[-1]
    return int(fits), int(totals[fits])


def _answered(docs: DataFrame, steps: str, fields: dict[str, T.DataType], answer) -> DataFrame:
    """`docs` with `fields`, what `answer` gives for the steps of each row and the row itself."""
    docs.sparkSession.conf.set(*BATCH_SETTING)
    kept = without(docs, fields)
    schema = T.StructType(kept.schema.fields + [T.StructField(k, v) for k, v in fields.items()])
    kinds = [pa.int64() if v == T.LongType() else pa.list_(pa.int64()) for v in fields.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = answer(batch)
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return kept.mapInArrow(run, schema)


def counted(docs: DataFrame, steps: str = "steps") -> DataFrame:
    """`docs` with `n_tokens`, the tokens of the whole text; null steps have none."""
    return _answered(docs, steps, {"n_tokens": T.LongType()}, lambda batch: [(n_tokens(s),) for s in batch.column(steps).to_pylist()])


def fitted(docs: DataFrame, budget: int, steps: str = "steps") -> DataFrame:
    """`docs` with `n_tokens`, and `fit_chars` and `fit_tokens` of the longest prefix within `budget` tokens.

    Null steps give zeros; columns of these names are replaced.
    """
    fields = dict.fromkeys(("n_tokens", "fit_chars", "fit_tokens"), T.LongType())
    return _answered(docs, steps, fields, lambda batch: [(n_tokens(s), *longest(s, budget)) for s in batch.column(steps).to_pylist()])


def counted_at(docs: DataFrame, places: str, steps: str = "steps") -> DataFrame:
    """`docs` with `tokens_at`, the counts of the prefixes that the array column `places` asks for; null gives none."""
    fields = {"tokens_at": T.ArrayType(T.LongType())}
    return _answered(docs, steps, fields, lambda batch: [(tokens_at(s, p or []),) for s, p in zip(batch.column(steps).to_pylist(), batch.column(places).to_pylist())])


def cut(text: Column, chars: Column) -> Column:
    """The first `chars` code points of a text."""
    return F.substring(text, F.lit(1), chars.cast("int"))


LIMIT = 4_096


def report(docs: DataFrame, path: str) -> DataFrame:
    """The columns of the registered query; `fit_chars` is where a text is to be cut to the limit."""
    stored = with_steps(docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")), path).drop("text")
    found = fitted(stored, LIMIT)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fit_chars", "fit_tokens")
