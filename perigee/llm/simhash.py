"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; a bit is 1 if it is set in over half of the shingles' hashes. Two
fingerprints that differ in at most three bits differ in at most one bit in one of their 32-bit
halves, so every half is looked up with its Hamming ball of radius one (33 values) in the table of
halves, and the matches are verified by the complete distance. Classes are the connected components
of the verified links between different fingerprints; equal fingerprints are one node, so a group of
copies of any size costs one row after the map-side step.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import computed, digests, fresh_names, without
from perigee.runtime import materialize

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
SEGMENT_BITS = 32
SLICE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text; null, empty and blank texts have fingerprint zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths) + np.arange(len(words))
    width = min(shingle, len(words))
    begins = (ends - lengths)[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(begins), SLICE):
        raw = b"".join([digest(joined[a:b], HASH_SEED) for a, b in zip(begins[at : at + SLICE], ends[at : at + SLICE])])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(begins)).tobytes(), "big", signed=True)


def _task(shingle: int):
    return lambda texts: [[fingerprint(t, shingle) for t in texts]]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, text: str = "text") -> DataFrame:
    """`docs` with `simhash`, a signed 64-bit integer."""
    return computed(docs, {"simhash": "bigint"}, partial(_task, shingle), text)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints in `prints(simhash)` at most `max_bits` apart.

    The radius of the balls is `max_bits // 2`, which finds every pair for two halves.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two 32-bit halves with balls of radius one find distances up to 3")
    mask = (1 << SEGMENT_BITS) - 1
    low, high = F.col("simhash").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("simhash", SEGMENT_BITS)
    halves = F.array(*[F.struct(F.lit(i).alias("half"), v.alias("value")) for i, v in enumerate((low, high))])
    table = prints.select(F.col("simhash").alias("b"), F.inline(halves))
    steps = [0] + [1 << i for i in range(SEGMENT_BITS)] if max_bits >= 2 else [0]
    ball = F.explode(F.array(*[F.lit(s).cast("bigint") for s in steps]))
    probes = prints.select(F.col("simhash").alias("a"), F.inline(halves)).select("a", "half", "value", ball.alias("flip"))
    probes = probes.select("a", "half", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    # Estimates of a generated table's size don't see the 66 rows per fingerprint; without the hint it may be broadcast.
    return probes.hint("merge").join(table, ["half", "value"]).filter(near).select("a", "b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, root) per linked node, root the smallest.

    Alternates large-star and small-star steps: every node is linked to the least of its neighbours,
    which shortens paths by half a round. Only the least neighbour of a node travels back to its rows,
    so a node of any degree is never gathered. Each round is a written table, which cuts the lineage.
    """
    edges = materialize(pairs.filter("a <> b"), "links")
    while True:
        ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = ends.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        down = large.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        floor = down.groupBy("u").agg(F.min("v").alias("least"))
        moved = down.join(floor, "u").select(F.explode(F.array(F.struct("u", F.col("least").alias("w")), F.struct(F.col("v").alias("u"), F.col("least").alias("w")))).alias("e"))
        after = moved.select(F.col("e.w").alias("a"), F.col("e.u").alias("b")).filter("a <> b").distinct()
        after = materialize(after, "star")
        # At the fixed point every node hangs on one root, and roots hang on nothing.
        several = after.groupBy("b").count().filter("count > 1").limit(1)
        chained = after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1)
        edges = after
        if several.isEmpty() and chained.isEmpty():
            break
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def classes(docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, text: str = "text") -> DataFrame:
    """One row per document: `key`, `simhash`, `class_print` and `component_id`, for every row of `docs`.

    `class_print` names the class (its least fingerprint) and `component_id` is the smallest non-null
    key in it, null if the class has none. Null and blank texts have fingerprint zero and link like any
    other. Repeated rows stay repeated. An empty table gives an empty one. `row_1` and `row_2` identify
    (key, text).
    """
    marked = docs.select(F.col(key).alias("own_key"), F.col(text).alias("whole"))
    ids = digests(F.col("own_key"), F.col("whole"))
    prints = fingerprints(marked.withColumns({"row_1": ids[0], "row_2": ids[1]}), shingle, "whole")
    rows = materialize(prints.select(F.col("own_key").alias(key), "row_1", "row_2", "simhash"), "prints")
    distinct = materialize(rows.groupBy("simhash").agg(F.min(key).alias("first_key")), "distinct")
    found = materialize(components(links(distinct.select("simhash"), max_bits)), "classes")
    named = distinct.join(found, distinct.simhash == found.node, "left")
    named = named.select("simhash", "first_key", F.coalesce("root", "simhash").alias("class_print"))
    firsts = named.groupBy("class_print").agg(F.min("first_key").alias("component_id"))
    return rows.join(named.select("simhash", "class_print").join(firsts, "class_print"), "simhash")


def one_of_each(docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, text: str = "text") -> DataFrame:
    """The rows of `docs` with one document of each class: the smallest key, then the smallest row hash.

    Rows equal in key and text are one document; of these the least row by its other columns stays. Null,
    blank and very long texts are documents like any others; an empty table gives an empty one. All
    columns stay as they are.
    """
    row_1, row_2 = fresh_names(docs, "row_1", "row_2")
    kept = classes(docs, key, shingle, max_bits, text).groupBy("class_print").agg(
        F.min(F.struct(F.col(key).isNull(), F.col(key), "row_1", "row_2")).alias("first"))
    kept = materialize(kept.select(F.col("first.row_1").alias(row_1), F.col("first.row_2").alias(row_2)), "kept")
    ids = digests(F.col(key), F.col(text))
    tagged = docs.withColumns({row_1: ids[0], row_2: ids[1]}).join(kept, [row_1, row_2], "left_semi")
    # Maps and variants have no order; they are compared as text.
    unordered = [name for name, kind in docs.dtypes if "map<" in kind or "variant" in kind]
    whole = F.struct(*docs.columns)
    order = F.struct(*[F.col(c).cast("string") if c in unordered else F.col(c) for c in docs.columns])
    least = tagged.groupBy(row_1, row_2).agg((F.min_by(whole, order) if unordered else F.min(whole)).alias("row"))
    return least.select("row.*")


def report(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    found = classes(without(docs, ["simhash"]))
    shown = F.lpad(F.lower(F.hex("simhash")), 16, "0")
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")
