"""Token ids in Simple-8b blocks.

A 64-bit word has a selector in its top four bits and as many ids as fit in the other 60, all of one
width. Larger values than 60 bits escape to a list beside the words. A block holds whole documents; its
ids are packed in stretches of 1,024, and the word at which each stretch starts is stored, so stretches
decode independently and every selector's words decode as one array operation. Blocks are rows of
Parquet files, written by Spark in ascending document order.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import BATCH_SETTING, pieces
from perigee.llm.pretrained import LETTERS, SIMPLE, RecentMemo, byte_letters, file_text, kept_in_worker, unlimited
from perigee.llm.shards import bucket_offsets
from perigee.runtime import fresh_path, materialize

END_ID = 1
# Fixed values of the format: (ids in a word, bits of each) by selector, from selector 1 on; 0 escapes.
LAYOUTS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
# How a maximum over `count` ids follows from two shorter ones.
SUMS = {2: (1, 1), 3: (2, 1), 4: (2, 2), 5: (4, 1), 6: (4, 2), 7: (4, 3), 8: (4, 4), 10: (8, 2), 12: (8, 4), 15: (8, 7), 20: (12, 8), 30: (20, 10), 60: (30, 30)}
STRETCH = 1_024
BLOCK_IDS = 1 << 16
# Pieces a task remembers: words of some hundred MB of text.
MEMO_PIECES = 1_500_000
BLOCKS = (
    "chunk int, first bigint, n_ids bigint, words binary, stretches binary, escapes binary, "
    "doc_ids array<bigint>, ends array<bigint>"
)
PIECES = re.compile(f"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[0-9]|[^\\s0-9{LETTERS}]+")


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each value, 0 for zero."""
    if int(ids.max()) < 1 << 53:
        return np.frexp(ids.astype(np.float64))[1]
    widths = np.zeros(len(ids), np.int32)
    for bits in range(64):
        widths += ids >= np.uint64(1 << bits)
    return widths


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unsigned ids -> (words, first word of each stretch, escaped values)."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.empty(0, "<u8"), np.empty(0, "<u4"), np.empty(0, "<u8")
    # Widest id among the next `count` ones, per place, for every count of a layout; a stretch ends in
    # zeros, so its last word may be short.
    stretches = -(-n // STRETCH)
    tail = LAYOUTS[0][0]
    rows = np.zeros((stretches, STRETCH + tail), np.uint8)
    flat = np.zeros(stretches * STRETCH, np.uint8)
    flat[:n] = _widths(ids)
    rows[:, :STRETCH] = flat.reshape(stretches, STRETCH)
    widest = {1: rows}
    for count, (a, b) in SUMS.items():
        widest[count] = rows.copy()
        np.maximum(widest[a][:, : STRETCH + tail - a], widest[b][:, a:], out=widest[count][:, : STRETCH + tail - a])
    choice = np.zeros((stretches, STRETCH), np.uint8)  # layout + 1; 0 escapes
    for layout in range(len(LAYOUTS) - 1, -1, -1):
        count, width = LAYOUTS[layout]
        np.putmask(choice, widest[count][:, :STRETCH] <= width, layout + 1)
    choice = choice.reshape(-1)[:n]
    counts = np.array([1, *[c for c, _ in LAYOUTS]])
    taken = counts[choice].tolist()
    starts = []
    for begin in range(0, n, STRETCH):
        at, end = begin, min(begin + STRETCH, n)
        while at < end:
            starts.append(at)
            at += taken[at]
    starts = np.array(starts)
    selectors = choice[starts].astype(np.int64)
    words = selectors.astype(np.uint64) << np.uint64(60)
    sizes = np.append(starts[1:], n) - starts
    for selector in np.unique(selectors):
        own = np.flatnonzero(selectors == selector)
        if not selector:
            words[own] |= np.arange(len(own), dtype=np.uint64)
            continue
        count, width = LAYOUTS[selector - 1]
        for k in range(count):
            some = own if k == 0 else own[sizes[own] > k]
            words[some] |= ids[starts[some] + k] << np.uint64(k * width)
    escapes = ids[starts[selectors == 0]]
    return words.astype("<u8"), np.flatnonzero(starts % STRETCH == 0).astype("<u4"), escapes.astype("<u8")


def unpack(words: np.ndarray, stretches: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The `n` ids that `pack` was given."""
    if not n:
        return np.empty(0, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([1, *[c for c, _ in LAYOUTS]])[selectors]
    # Places within a stretch follow from the words before; a stretch's place is known.
    before = np.cumsum(counts) - counts
    stretch = np.zeros(len(words), np.int64)
    stretch[stretches[1:]] = 1
    stretch = np.cumsum(stretch)
    begins = stretch * STRETCH + before - before[stretches][stretch]
    ends = np.minimum((stretch + 1) * STRETCH, n)
    out = np.zeros(n + LAYOUTS[0][0], np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for selector in np.unique(selectors):
        own = np.flatnonzero(selectors == selector)
        if not selector:
            out[begins[own]] = escapes[payload[own].astype(np.int64)]
            continue
        count, width = LAYOUTS[selector - 1]
        mask = np.uint64((1 << width) - 1)
        for k in range(count):
            some = own if k == 0 else own[begins[own] + k < ends[own]]
            out[begins[some] + k] = (payload[some] >> np.uint64(k * width)) & mask
    return out[:n]


class WordEncoder:
    """Ids of whole texts for a tokenizer file that drops white space, by way of their pieces.

    The file's normalizer and pieces never reach over a blank. A text of characters that all engines
    class alike is cut into pieces at once; other texts are taken word by word, and words with other
    characters go through the whole library pipeline. Pieces and such words are remembered.
    """

    def __init__(self, text: str):
        self.tokenizer = unlimited(text)
        self.tokenize = self.tokenizer.model.tokenize
        self.table = {b: c for b, c in byte_letters().items() if chr(b) != c}
        config = json.loads(text)
        steps = [s["type"] for s in config["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a tokenizer that lower-cases and drops white space")
        if any(re.search(r"\s", t["content"]) or t["normalized"] for t in config["added_tokens"]):
            raise ValueError("added tokens must be strings without blanks")
        self.special = tuple(t["content"] for t in config["added_tokens"])
        # Words differ more than their pieces, mostly by marks at their ends, so no plain word is remembered.
        self.pieces = RecentMemo(self.piece, MEMO_PIECES)
        self.words = RecentMemo(self.word)

    def plain(self, text: str) -> bool:
        return SIMPLE.fullmatch(text) is not None and not any(s in text for s in self.special)

    def cut(self, text: str) -> bytes:
        """Ids of a plain text; its letters are composed already, so lower case is all the normalizer does."""
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(text.lower())))

    def word(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.table)
        return array("I", [t.id for t in self.tokenize(letters)]).tobytes()

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if self.plain(text):
            return self.cut(text)
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(self.cut(w) if self.plain(w) else self.words[w] for w in words)


def _block(chunk: int, first: int, docs: list[int | None], found: list[np.ndarray]) -> pa.RecordBatch:
    ids = np.concatenate(found)
    parts = [p.tobytes() for p in pack(ids)]
    values = [chunk, first, len(ids), *parts, docs, np.cumsum([len(f) for f in found]).tolist()]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = ["chunk", "first", "n_ids", "words", "stretches", "escapes", "doc_ids", "ends"]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


def _write_task(shared, end_id: int):
    def run(batches):
        path, text = shared.value
        own = kept_in_worker(("words", path), lambda: WordEncoder(text))
        end = np.array([end_id], "<u4").tobytes()
        chunk, first, docs, found, held = -1, 0, [], [], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                for chunk, doc, body in zip(piece.column("chunk").to_pylist(), piece.column("key").to_pylist(), piece.column("text").to_pylist()):
                    docs.append(doc)
                    found.append(np.frombuffer(own.encode(body) + end, "<u4"))
                    held += len(found[-1])
                    if held >= BLOCK_IDS:
                        yield _block(chunk, first, docs, found)
                        first, docs, found, held = first + held, [], [], 0
        if docs:
            yield _block(chunk, first, docs, found)

    return run


def write_tokens(
    docs: DataFrame, path: str, out: str | None = None, key: str = "doc_id", text: str = "text", end_id: int = END_ID, ties: list[Column] | None = None,
    ranges: int | None = None,
) -> str:
    """Write the ids of all documents, each ended by `end_id`, in ascending order of `key`; return the folder.

    Null keys come first; rows with equal keys follow `ties` (by default the hash of the text), which
    also lets a hot key spread over ranges. Null and empty texts have the end id alone; a very long text
    is a block of its own, and an empty table gives files without rows. A chunk is one range of keys;
    `first` counts the ids of a chunk before the block. There are `ranges` of them, or as many as the
    session's shuffle partitions and the size of the text give; a range is sorted by Spark's external
    sort and written block by block, so its length costs no memory.
    """
    spark = docs.sparkSession
    spark.conf.set(*BATCH_SETTING)
    out = out or fresh_path(spark, "tokens")
    tie = F.xxhash64(*ties) if ties else F.xxhash64(F.col(text))
    rows = docs.select(F.col(key).cast("bigint").alias("key"), tie.alias("tie"), F.col(text).alias("text"))
    by = [F.asc_nulls_first("key"), F.col("tie")]
    dealt = rows.repartitionByRange(ranges, *by) if ranges else rows.repartitionByRange(*by)
    ranged = dealt.sortWithinPartitions(*by)
    chunked = ranged.select(F.spark_partition_id().alias("chunk"), "key", "text")
    chunked.mapInArrow(_write_task(file_text(spark, path), end_id), BLOCKS).write.parquet(out)
    return out


def _read_task(batches):
    """One row (chunk, doc_id, begin, ids) per document, `begin` counted in its chunk."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["stretches"], "<u4"), np.frombuffer(row["escapes"], "<u8"), row["n_ids"])
            ends = np.array(row["ends"], np.int64)
            begins = np.append(0, ends[:-1])
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int64)))
            n = len(ends)
            yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["first"]), lists], names=["chunk", "doc_id", "begin", "ids"])


def _digest_task(batches):
    """Like `_read_task`, with the number and checksum of each document's ids in place of the ids."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["stretches"], "<u4"), np.frombuffer(row["escapes"], "<u8"), row["n_ids"])
            raw, ends = memoryview(ids.astype("<u4").tobytes()), row["ends"]
            begins = [0, *ends[:-1]]
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins, ends)]
            yield pa.RecordBatch.from_arrays([
                pa.array([row["chunk"]] * len(ends), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(np.array(begins, np.int64) + row["first"]),
                pa.array(np.array(ends, np.int64) - np.array(begins, np.int64)), pa.array(crcs, pa.int64())], names=["chunk", "doc_id", "begin", "n_tokens", "ids_crc32"])


def _blocks(spark, path: str) -> DataFrame:
    """Stored blocks, few to a batch as each is large."""
    spark.conf.set(*BATCH_SETTING)
    return spark.read.schema(BLOCKS).parquet(path)


def _placed(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """`start`: ids of all documents before, from the sizes of the chunks (one row per range)."""
    sizes = blocks.groupBy(F.col("chunk").alias("bucket")).agg(F.sum("n_ids").alias("n"))
    bases = materialize(bucket_offsets(sizes), "chunk-offsets").withColumnRenamed("bucket", "chunk")
    return found.join(bases, "chunk").withColumn("start", F.col("offset") + F.col("begin")).drop("chunk", "begin", "offset")


def read_tokens(spark, path: str) -> DataFrame:
    """(doc_id, ids, start) of every document in a folder that `write_tokens` made."""
    blocks = _blocks(spark, path)
    return _placed(blocks.mapInArrow(_read_task, "chunk int, doc_id bigint, begin bigint, ids array<bigint>"), blocks)


def report(docs: DataFrame, path: str, ties: list[Column] | None = None) -> DataFrame:
    """The digest columns of the registered query, from the written files."""
    blocks = _blocks(docs.sparkSession, write_tokens(docs, path, ties=ties))
    found = blocks.mapInArrow(_digest_task, "chunk int, doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint")
    return _placed(found, blocks).select("doc_id", "start", "n_tokens", "ids_crc32")
