"""BPE encoding by tree concatenation, and decoding.

A text is cut into halves down to leaves without regard to words. Leaves are encoded on their own;
then neighbours are joined: the pieces in a growing window around the seam are split and merged anew
until the window's ends agree with what either side had there. From a boundary between pieces on, the
splitting pattern depends on nothing before it, and within a piece a sequence of tokens is the
encoding if each adjacent pair is the encoding of its own text; so a window that agrees at both ends
makes the joined result exactly that of the whole text. Parts of long texts are encoded in different
tasks and joined afterwards; leaves of other texts in one.
"""

from __future__ import annotations

import json
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import BATCH_SETTING, computed, digests, fresh_names, pieces, without
from perigee.llm.pretrained import LETTERS, SIMPLE, Memo, byte_letters, file_text, kept_in_worker, unlimited
from perigee.runtime import materialize

LEAF_CHARS = 2_048
PART_CHARS = 65_536
WINDOW_PIECES = 2
WINDOW_TOKENS = 8
# The pieces of byte-level BPE: contractions, words, numbers and marks with a blank before them, blanks.
PIECES = re.compile(
    rf" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s0-9{LETTERS}]+|\s+(?!\S)|\s+"
)

Encoded = tuple[list[str], list[bytes]]  # pieces and their ids


class Encoder:
    """Tree concatenation for one tokenizer file of byte-level BPE."""

    def __init__(self, text: str, leaf: int = LEAF_CHARS):
        self.tokenizer = unlimited(text)
        self.leaf = leaf
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.table = {b: c for b, c in self.letters.items() if chr(b) != c}
        self.memo = Memo(self.merge)
        config = json.loads(text)
        if config["normalizer"] is not None or config["pre_tokenizer"].get("type") != "ByteLevel" or config["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a byte-level tokenizer without normalizer")
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in config["added_tokens"]):
            raise ValueError("added tokens must be plain strings")
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        back = {c: b for b, c in self.letters.items()}
        words = config["model"]["vocab"] | self.special
        self.bytes = np.empty(max(words.values()) + 1, object)
        self.bytes[:] = b""
        for word, number in words.items():
            self.bytes[number] = word.encode() if word in self.special else bytes(back[c] for c in word)

    def merge_bytes(self, raw: bytes) -> bytes:
        """Ids of the bytes of one piece, by the merges alone."""
        return np.array([t.id for t in self.tokenize(raw.decode("latin-1").translate(self.table))], "<i4").tobytes()

    def merge(self, piece: str) -> bytes:
        return self.merge_bytes(piece.encode())

    def split(self, text: str) -> list[str]:
        """Pieces of a text, by the tokenizer's own splitter where engines might differ."""
        if SIMPLE.fullmatch(text):
            return PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def tree(self, text: str) -> Encoded:
        if len(text) <= self.leaf:
            found = self.split(text)
            return found, list(map(self.memo.__getitem__, found))
        middle = len(text) // 2
        return self.join(self.tree(text[:middle]), self.tree(text[middle:]))

    def join(self, left: Encoded, right: Encoded) -> Encoded:
        """The encoding of two neighbours' text; `left` is reused."""
        if not left[0] or not right[0]:
            return left if left[0] else right
        k = WINDOW_PIECES
        while True:
            a, b = left[0][-k:], right[0][:k]
            found = self.split("".join(a) + "".join(b))
            starts = k >= len(left[0]) or found[:2] == a[:2]
            ends = k >= len(right[0]) or found[-2:] == b[-2:]
            if starts and ends:
                break
            k *= 2
        over = None
        if left[0][-1] + right[0][0] in found and len(left[0][-1]) + len(right[0][0]) > self.leaf:
            # A long piece lies across the seam: its halves have ids already.
            over = left[0][-1] + right[0][0], self.join_ids(left[1][-1], right[1][0])
        ids = [over[1] if over and p == over[0] else self.memo[p] for p in found]
        left[0][-k:], left[1][-k:] = found, ids
        left[0].extend(right[0][k:])
        left[1].extend(right[1][k:])
        return left

    def join_ids(self, left: bytes, right: bytes) -> bytes:
        """Ids of one piece from the ids of its halves."""
        a, b = np.frombuffer(left, "<i4"), np.frombuffer(right, "<i4")
        k = WINDOW_TOKENS
        while True:
            raw = b"".join(self.bytes[np.concatenate([a[-k:], b[:k]])])
            found = np.frombuffer(self.merge_bytes(raw), "<i4")
            starts = k >= len(a) or (len(found) > 1 and found[0] == a[-k])
            ends = k >= len(b) or (len(found) > 1 and found[-1] == b[k - 1])
            if starts and ends:
                return np.concatenate([a[:-k], found, b[k:]]).astype("<i4").tobytes()
            k *= 2

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; strings of added tokens become their ids."""
        if not text:
            return b""
        parts = self.cut.split(text) if self.cut and self.cut.search(text) else [text]
        return b"".join(
            np.array([self.special[p]], "<i4").tobytes() if i % 2 else b"".join(self.tree(p)[1]) for i, p in enumerate(parts))

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; bytes that aren't UTF-8 become replacement characters, unknown ids nothing."""
        known = ids[(ids >= 0) & (ids < len(self.bytes))]
        return b"".join(self.bytes[known]).decode("utf-8", "replace")


def encoder(shared, leaf: int = LEAF_CHARS) -> Encoder:
    path, text = shared.value
    return kept_in_worker(("bpe", path, leaf), lambda: Encoder(text, leaf))


def _id_lists(found: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(f) // 4 for f in found])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))


def _encode_task(shared, leaf):
    own = encoder(shared, leaf)
    return lambda texts: [_id_lists([own.encode(t) for t in texts])]


def _parts_task(shared, leaf):
    """(text id, segment, part, special or text) -> the pieces of a part, joined by a character no text has."""

    def run(batches):
        own = encoder(shared, leaf)
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = [own.tree(t) for t in piece.column("text").to_pylist()]
                sizes = [pa.array([[len(p) for p in f[0]] for f in found], pa.list_(pa.int32())), pa.array([[len(i) // 4 for i in f[1]] for f in found], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*piece.columns, *sizes, _id_lists([b"".join(f[1]) for f in found])], names=[*piece.schema.names, "chars", "tokens", "ids"])

    return run


def _join_task(shared, leaf):
    """Joins the parts of each text, neighbours first, as a balanced tree."""

    def run(batches):
        own = encoder(shared, leaf)
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for segment in sorted({p["segment"] for p in row["parts"]}):
                    if segment:
                        out.append(np.array([own.special[row["marks"][segment - 1]]], "<i4").tobytes())
                    level = [_opened(p) for p in sorted((p for p in row["parts"] if p["segment"] == segment), key=lambda p: p["part"])]
                    while len(level) > 1:
                        level = [own.join(level[i], level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
                    out += level[0][1]
                ids = pa.array([row["row_1"]], pa.int64()), pa.array([row["row_2"]], pa.int64())
                yield pa.RecordBatch.from_arrays([*ids, _id_lists([b"".join(out)])], names=["row_1", "row_2", "ids"])

    return run


def _opened(part: dict) -> Encoded:
    raw = np.array(part["ids"], "<i4")
    at, to = np.cumsum([0] + part["chars"]), np.cumsum([0] + part["tokens"])
    return [part["text"][a:b] for a, b in zip(at, at[1:])], [raw[a:b].tobytes() for a, b in zip(to, to[1:])]


def encoded(docs: DataFrame, path: str, text: str = "text", leaf: int = LEAF_CHARS, part: int = PART_CHARS) -> DataFrame:
    """`docs` with `ids`, the token ids of the whole text as the tokenizer file at `path` encodes it.

    Null and empty texts have no ids. Texts of over `part` code points are cut into parts that different
    tasks encode, each distinct text once, and joined again; the other texts are encoded where they
    are. Rows stay as they are, repeated ones too; an empty table gives an empty one. A column `ids` of
    `docs` is replaced, all others stay.
    """
    spark = docs.sparkSession
    spark.conf.set(*BATCH_SETTING)
    shared = file_text(spark, path)
    kept = without(docs, ["ids"])
    is_long = F.coalesce(F.length(text) > part, F.lit(False))
    short = computed(kept.filter(~is_long), {"ids": "array<int>"}, partial(_encode_task, shared, leaf), text)
    names = [t["content"] for t in json.loads(shared.value[1])["added_tokens"]]
    cut = "|".join("\\Q" + n + "\\E" for n in names) or r"(?!)"
    hashes = digests(F.col(text))
    keys, own = ["row_1", "row_2"], fresh_names(kept, "row_1", "row_2", "ids")[:2]
    marked = kept.filter(is_long).withColumns(dict(zip(own, hashes)))
    texts = kept.filter(is_long).select(hashes[0].alias("row_1"), hashes[1].alias("row_2"), F.col(text).alias("whole"))
    # Cut first, so that copies meet part by part and no task gathers whole long texts.
    segments = texts.select(*keys, F.regexp_extract_all("whole", F.lit(f"({cut})"), 1).alias("marks"), F.posexplode(F.split("whole", cut, -1)).alias("segment", "body"))
    places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.length("body") / part) - 1).cast("int"))
    parts = segments.select(*keys, F.when(F.col("segment") == 0, F.col("marks")).alias("marks"), "segment", "body", F.explode(places).alias("part"))
    parts = parts.select(*keys, "marks", "segment", "part", F.col("body").substr(F.col("part") * part + 1, F.lit(part)).alias("text"))
    # One of the copies of a part; the row hash and place spread parts over tasks.
    unique = parts.groupBy(*keys, "segment", "part").agg(F.first("marks").alias("marks"), F.first("text").alias("text"))
    done = unique.mapInArrow(_parts_task(shared, leaf), "row_1 bigint, row_2 bigint, segment int, part int, marks array<string>, text string, chars array<int>, tokens array<int>, ids array<int>")
    rows = done.groupBy(*keys).agg(F.first("marks", ignorenulls=True).alias("marks"), F.collect_list(F.struct("segment", "part", "text", "chars", "tokens", "ids")).alias("parts"))
    joined = materialize(rows.mapInArrow(_join_task(shared, leaf), "row_1 bigint, row_2 bigint, ids array<int>"), "long-texts")
    long = marked.join(joined.withColumnsRenamed(dict(zip(keys, own))), own, "left").select(*kept.columns, "ids")
    return short.unionByName(long)


def decoded(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`docs` with `into`, the text of the ids; null ids give null."""
    docs.sparkSession.conf.set(*BATCH_SETTING)
    shared = file_text(docs.sparkSession, path)
    kept = without(docs, [into])
    schema = kept.select("*", F.lit(None).cast("string").alias(into)).schema

    def run(batches):
        own = encoder(shared)
        for batch in batches:
            column = batch.column(ids)
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum([0] + pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_pylist())
            valid = column.is_valid().to_pylist()
            found = [own.decode(flat[a:b]) if ok else None for a, b, ok in zip(ends, ends[1:], valid)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, into])

    return kept.mapInArrow(run, schema)


def report(docs: DataFrame, path: str) -> DataFrame:
    """The digest columns of the registered query."""
    found = decoded(encoded(docs.select("doc_id", "text"), path).drop("text"), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
