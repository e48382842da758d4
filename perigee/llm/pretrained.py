"""Tokenizer files on the tasks' side: loaded once in a worker, with bounded memories of pieces."""

from __future__ import annotations

import re
import sys
import types

from pyspark.sql import SparkSession
from tokenizers import Tokenizer

MAX_FILE_BYTES = 64 << 20
MEMO_ENTRIES = 600_000
MEMO_CHARS = 40
# Letters, digits and marks for which the classes of every regular-expression engine agree.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SIMPLE = re.compile(f"[\\t\\n\\r\\x20-\\x7e{LETTERS}]*")


def file_text(spark: SparkSession, path: str):
    """A tokenizer file as a broadcast value; its size is checked."""
    with open(path, encoding="utf-8") as f:
        text = f.read(MAX_FILE_BYTES + 1)
    if len(text) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    return spark.sparkContext.broadcast((path, text))


def kept_in_worker(key: tuple, make):
    """An object that a Python worker makes once and keeps between its tasks."""
    store = sys.modules.setdefault("perigee_worker_store", types.ModuleType("perigee_worker_store")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes take the code points from 256 on,
    in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Memo(dict):
    """Ids of pieces of text as little-endian 32-bit integers; long pieces aren't kept.

    When it is full it starts anew, so its memory is bounded and no result depends on it.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        found = self.encode(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = found
        return found


class RecentMemo(Memo):
    """A memo in two halves: when the newer one is full, it takes the older one's place.

    What is asked for again moves back to the newer half, so frequent pieces are never forgotten, and a
    full memory loses the rare ones only.
    """

    def __init__(self, encode, entries: int = MEMO_ENTRIES):
        super().__init__(encode)
        self.half = entries // 2
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self.encode(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


def unlimited(text: str) -> Tokenizer:
    """The tokenizer of a file, without truncation and padding."""
    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer
