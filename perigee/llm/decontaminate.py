"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by their number of five-word shingles into classes (u/2, u]. A short item is a
tiny part of a long document, so a document is looked at in windows of 2u shingles that overlap by
half; whatever the item's place, some window holds it, and there containment 0.8 means a Jaccard
similarity of about 0.19 or more. Windows and items with one of 64 equal MinHash values are candidates
(a miss has a chance of about 1 in a million), and candidates are verified by the exact containment of
the item's shingles in the document. Documents stay where they are; only items travel, in blocks of
bounded size.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import WORD_PATTERN, computed, digests, fresh_names, without
from perigee.runtime import materialize

SHINGLE_WORDS = 5
MIN_CONTAINMENT = 0.8
HASHES = 64
BASE = 8  # shingles in the smallest block; classes are BASE times powers of two
TINY = 4  # items of so few shingles are looked up shingle by shingle
BLOCK_ITEMS = 5_000
BLOCK_BYTES = 16 << 20
FILTER_BITS = 22
STRETCH = 1 << 15  # shingles hashed at once
MULTIPLIERS = (np.random.default_rng(5).integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
ADDENDS = np.random.default_rng(6).integers(0, 1 << 32, HASHES, dtype=np.uint32)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, with A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes], width: int = SHINGLE_WORDS) -> np.ndarray:
    """A 32-bit hash of each run of `width` words; equal runs have equal hashes."""
    n = len(words) - width + 1
    if n < 1:
        return np.empty(0, np.uint32)
    codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    mixed = codes * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * np.uint64(0xD6E8FEB86659FD93) + mixed[k : n + k]
    total ^= total >> np.uint64(29)
    return ((total * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32)


def block_minima(hashes: np.ndarray) -> np.ndarray:
    """MinHash values of each block of `BASE` shingles: blocks x `HASHES`."""
    blocks = -(-len(hashes) // BASE)
    out = np.empty((blocks, HASHES), np.uint32)
    step = STRETCH // BASE
    for at in range(0, blocks, step):
        part = hashes[at * BASE : (at + step) * BASE]
        some = -(-len(part) // BASE)
        # The last block is filled up with its own last shingle, which changes no minimum.
        part = np.pad(part, (0, some * BASE - len(part)), mode="edge")
        for j in range(HASHES):
            out[at : at + some, j] = (part * MULTIPLIERS[j] + ADDENDS[j]).reshape(some, BASE).min(axis=1)
    return out


def _pairs_minima(minima: np.ndarray) -> np.ndarray:
    """Minima of neighbours 2k and 2k + 1; a last block alone stays."""
    if len(minima) % 2:
        minima = np.concatenate([minima, minima[-1:]])
    return np.minimum(minima[::2], minima[1::2])


def _windows(minima: np.ndarray) -> np.ndarray:
    return np.minimum(minima[:-1], minima[1:]) if len(minima) > 1 else minima


def _keys(minima: np.ndarray) -> np.ndarray:
    """MinHash values with the number of their function, as one integer."""
    return minima.astype(np.uint64) | (np.arange(HASHES, dtype=np.uint64) << np.uint64(32))


def _bits(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def shingles(words: list[bytes], width: int) -> set[bytes]:
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


@dataclass
class SizeClass:
    """Items of one size class; `keys` are sorted, `items` their positions."""

    doublings: int
    keys: np.ndarray
    items: np.ndarray
    filter: np.ndarray


class Index:
    """A block of items, searched in whole documents."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = MIN_CONTAINMENT):
        self.threshold = threshold
        self.ids, self.sets, self.widths = [], [], []
        sizes: dict[int, list[tuple[int, np.ndarray]]] = {}
        self.tiny: dict[int, dict[int, list[int]]] = {}
        for number, text in items:
            words = words_of(text)
            if not words:
                continue
            width = min(SHINGLE_WORDS, len(words))
            place, own = len(self.ids), shingles(words, width)
            self.ids.append(number)
            self.sets.append(own)
            self.widths.append(width)
            if len(own) <= TINY:
                table = self.tiny.setdefault(width, {})
                for h in set(shingle_hashes(words, width).tolist()):
                    table.setdefault(h, []).append(place)
            else:
                doublings = max(0, (len(own) - 1).bit_length() - BASE.bit_length() + 1)
                sizes.setdefault(doublings, []).append((place, block_minima(shingle_hashes(words)).min(axis=0)))
        self.classes = []
        for doublings, own in sorted(sizes.items()):
            keys, owners = _keys(np.stack([m for _, m in own])).ravel(), np.repeat([p for p, _ in own], HASHES)
            order = np.argsort(keys, kind="stable")
            bitmap = np.zeros(1 << FILTER_BITS, bool)
            bitmap[_bits(keys)] = True
            self.classes.append(SizeClass(doublings, keys[order], owners[order], bitmap))

    def candidates(self, words: list[bytes]) -> set[int]:
        found: set[int] = set()
        for width, table in self.tiny.items():
            hashes = shingle_hashes(words, width)
            for h in set(hashes[np.isin(hashes, np.fromiter(table, np.uint32, len(table)))].tolist()):
                found.update(table[h])
        if not self.classes:
            return found
        hashes = shingle_hashes(words)
        if not len(hashes):
            return found
        minima, doublings = block_minima(hashes), 0
        for group in self.classes:
            while doublings < group.doublings:
                minima, doublings = _pairs_minima(minima), doublings + 1
            keys = _keys(_windows(minima)).ravel()
            keys = np.unique(keys[group.filter[_bits(keys)]])
            low, high = np.searchsorted(group.keys, keys, "left"), np.searchsorted(group.keys, keys, "right")
            for a, b in zip(low.tolist(), high.tolist()):
                found.update(group.items[a:b].tolist())
        return found

    def search(self, text: str | None) -> dict[int, tuple[int, int]]:
        """Item id -> (its shingles in the text, its shingles), for items contained to the threshold."""
        words = words_of(text)
        found: dict[int, tuple[int, int]] = {}
        sets: dict[int, set[bytes]] = {}
        for place in self.candidates(words):
            width = self.widths[place]
            if width not in sets:
                sets[width] = shingles(words, width)
            shared, size = len(self.sets[place] & sets[width]), len(self.sets[place])
            number = self.ids[place]
            if shared >= self.threshold * size and (number not in found or shared * found[number][1] > found[number][0] * size):
                found[number] = (shared, size)
        return found


def _task(shared, threshold: float):
    index = Index(shared.value, threshold)

    def work(texts):
        out = []
        for text in texts:
            hits = sorted(index.search(text).items())
            out.append([v for number, (shared_count, size) in hits for v in (number, shared_count, size)])
        return [out]

    return work


def _sent(block: DataFrame):
    return block.sparkSession.sparkContext.broadcast([(r["id"], r["text"]) for r in block.collect()])


def item_blocks(items: DataFrame, key: str, text: str) -> list[DataFrame]:
    """Items (id, text) with a non-null id and text, in blocks of at most about `BLOCK_ITEMS` and `BLOCK_BYTES`."""
    rows = items.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-size["n"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    bucket = F.pmod(F.xxhash64("id"), F.lit(max(1, blocks)))
    return [rows.filter(bucket == b).orderBy("id", "text") for b in range(blocks)]


def marked(
    docs: DataFrame, items: DataFrame, threshold: float = MIN_CONTAINMENT, text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """`docs` with `leaks`: an array of (item_id, n_shared, n_shingles), by item id.

    An item of fewer than five words counts as one shingle of all its words. Items without an id or a
    word match nothing; of rows with equal item ids the best counts. Null and empty texts contain
    nothing. Rows stay as they are, repeated ones too; each block of items is one pass over the texts.
    Of several blocks the driver holds one at a time: what the texts contain of it is written before the next.
    """
    kept, blocks = without(docs, ["leaks"]), item_blocks(items, item_key, item_text)
    own, row_1, row_2 = fresh_names(kept, "found_leaks", "row_1", "row_2")
    names, ids = [own] if blocks else [], digests(F.col(text))
    if len(blocks) == 1:
        kept = computed(kept, {own: "array<bigint>"}, partial(_task, _sent(blocks[0]), threshold), text)
    elif blocks:
        texts = kept.select(ids[0].alias(row_1), ids[1].alias(row_2), F.col(text).alias("whole"))
        written = []
        for block in blocks:
            shared = _sent(block)
            hits = computed(texts, {own: "array<bigint>"}, partial(_task, shared, threshold), "whole").filter(F.size(own) > 0)
            written.append(materialize(hits.groupBy(row_1, row_2).agg(F.max(own).alias(own)), "leaks"))
            shared.destroy()
        found = reduce(DataFrame.unionByName, written).groupBy(row_1, row_2).agg(F.flatten(F.collect_list(own)).alias(own))
        # Written, so that its size is known; few texts contain items.
        kept = kept.withColumns({row_1: ids[0], row_2: ids[1]}).join(materialize(found, "leaks"), [row_1, row_2], "left").drop(row_1, row_2)
    every = F.coalesce(own, F.array().cast("array<bigint>")) if names else F.array().cast("array<bigint>")
    places = F.when(F.size(every) > 0, F.sequence(F.lit(0), F.size(every) - 1, F.lit(3))).otherwise(F.array().cast("array<int>"))
    leaks = F.transform(places, lambda i: F.struct(
        F.get(every, i).alias("item_id"), F.get(every, i + 1).alias("n_shared"), F.get(every, i + 2).alias("n_shingles")))
    return kept.withColumn("leaks", F.array_sort(leaks)).drop(*names)


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = MIN_CONTAINMENT, text: str = "text") -> DataFrame:
    """The rows of `docs` that contain no item; their columns stay as they are."""
    found = marked(docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("whole")), items, threshold, "whole")
    return found.filter(F.size("leaks") == 0).select("row.*")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of the registered query: one for each document and item that it contains."""
    found = marked(docs.select("doc_id", "text"), items).filter(F.size("leaks") > 0)
    rows = found.select("doc_id", F.inline("leaks"))
    return rows.select("doc_id", "item_id", "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# The benchmark's items have five words or more.
REPORT_SQL = rf"""
WITH doc_words AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all({_LOWER.format("text")}, '{WORD_PATTERN}') AS w FROM documents
), doc_shingles AS (
  SELECT DISTINCT row_no, doc_id, array_to_string(list_slice(w, i, i + {SHINGLE_WORDS - 1}), ' ') AS shingle
  FROM (SELECT row_no, doc_id, w, unnest(range(1, len(w) - {SHINGLE_WORDS - 2})) AS i FROM doc_words)
), item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '{WORD_PATTERN}') AS w FROM benchmark
), item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + {SHINGLE_WORDS - 1}), ' ') AS shingle
  FROM (SELECT item_id, w, unnest(range(1, len(w) - {SHINGLE_WORDS - 2})) AS i FROM item_words)
), sizes AS (
  SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id
), shared AS (
  SELECT row_no, doc_id, item_id, count(*) AS n_shared FROM doc_shingles JOIN item_shingles USING (shingle) GROUP BY ALL
)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_shared >= {MIN_CONTAINMENT} * n_shingles
"""
