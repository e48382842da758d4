"""Alignment of two tokenizers' tokens, on Arrow columns.

Lists of token ids are flattened, with the index of the text each comes from; the bytes of the tokens,
summed up within a text, are the places where tokens end. An inner hash join of both sides on (text,
end) finds the ends they share, which cut the tokens into groups. An outer hash join puts all ends in
one order: between two of them lies exactly one overlap of a token of A and a token of B, a link. Links
are counted by pair of ids in each batch, and Spark merges these partial counts. The counts return to
the texts block by block, as a block holds few distinct pairs, and are joined there to its links.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.llm.bpe import Encoder
from perigee.llm.common import BATCH_SETTING, fresh_names, pieces, without
from perigee.llm.prefix_counts import BLANK, model_file
from perigee.llm.pretrained import file_text, kept_in_worker
from perigee.runtime import materialize

# Longer texts are encoded and joined in windows, cut before a single blank between a letter and a letter.
WINDOW_CHARS = 1 << 20
CUT = re.compile("[A-Za-z](?= [A-Za-z])")
IDS = pa.list_(pa.int32())
# A pair of ids as one number: the id of A in the upper half.
SHIFT = 32
ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256")


class Sides:
    """Both tokenizers, the bytes of their tokens, and the tokens as text."""

    def __init__(self, text_a: str, model_b: bytes):
        self.a = Encoder(text_a)
        self.a.cut = None  # strings of special tokens are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        n = self.b.get_piece_size()
        own = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in range(n))]
        # One table of bytes: A's tokens, then B's.
        self.first_b = len(self.a.bytes)
        self.bytes = pa.array([*self.a.bytes, *own], pa.binary())
        self.sizes = pc.binary_length(self.bytes).to_numpy().astype(np.int64)
        numbers = [*map(str, range(self.first_b)), *map(str, range(n))]
        # Each token as it is written inside its group, and as it is written where the group ends.
        last = ["|"] * self.first_b + [";"] * n
        self.written = pa.array([s + "," for s in numbers] + [s + m for s, m in zip(numbers, last)], pa.string())

    def encode(self, windows: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of A and B for each window; a window after a text's first starts with its own blank.

        A has a blank before a text, so the windows come with it; B adds that blank itself.
        """
        found = [self.a.encode(w) for w in windows]
        ends = np.cumsum([0] + [len(f) // 4 for f in found])
        ids_a = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
        return ids_a, pa.array(self.b.encode([w[1:] for w in windows], num_threads=1), IDS)


def windows(text: str, size: int = WINDOW_CHARS) -> list[str]:
    """A blank and the text, cut where both tokenizers start anew: each part is encoded as in the whole."""
    text, out, start = " " + text, [], 0
    while len(text) - start > size:
        found = CUT.search(text, start + size)
        if not found:
            break
        out.append(text[start : found.end()])
        start = found.end()
    return [*out, text[start:]]


def lots(texts: list[tuple[int, str]], size: int) -> Iterator[list[tuple[int, str]]]:
    """(row, window) in lots of bounded text; only a window that can't be cut is longer."""
    lot, total = [], 0
    for row, text in texts:
        for window in windows(text, size):
            if lot and total + len(window) > 4 * size:
                yield lot
                lot, total = [], 0
            lot.append((row, window))
            total += len(window)
    if lot:
        yield lot


def token_ends(ids: pa.ListArray, sizes: np.ndarray, first: int) -> pa.Table:
    """(doc, end, id) of a list of ids per text: flattened, with sums of bytes that start anew in each text."""
    flat = ids.flatten()
    doc = pc.list_parent_indices(ids)
    totals = np.cumsum(sizes[flat.to_numpy() + first])
    starts = ids.offsets.to_numpy()[:-1]
    before = np.concatenate([[0], totals])[starts]
    return pa.table({"doc": pc.cast(doc, pa.int64()), "end": totals - before[doc.to_numpy()], "id": pc.cast(flat, pa.int64())})


def same_bytes(sides: Sides, ids: pa.ListArray, first: int, expected: pa.Array) -> np.ndarray:
    """Whether the bytes of each text's tokens are the bytes of the text."""
    taken = sides.bytes.take(pc.add(ids.flatten(), first))
    joined = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, taken), b"")
    return pc.equal(joined, expected).to_numpy(zero_copy_only=False)


def links_of(a: pa.Table, b: pa.Table) -> pa.Table:
    """(doc, end, a, b), one row per overlap of two tokens, in order.

    Every overlap ends where one of both tokens ends, and no other overlap ends there. The token of the
    other side is the next one that ends, in the same text as both sides end with the text.
    """
    ends = a.rename_columns(["doc", "end", "a"]).join(b.rename_columns(["doc", "end", "b"]), ["doc", "end"], join_type="full outer", use_threads=False)
    ends = ends.sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks()
    return ends.set_column(2, "a", pc.fill_null_backward(ends["a"])).set_column(3, "b", pc.fill_null_backward(ends["b"]))


def group_ends(a: pa.Table, b: pa.Table) -> pa.Table:
    """(doc, end), in order, where tokens of both sides end."""
    return a.join(b, ["doc", "end"], join_type="left semi", use_threads=False).select(["doc", "end"]).sort_by([("doc", "ascending"), ("end", "ascending")])


def groups_text(sides: Sides, a: pa.Table, b: pa.Table, shared: pa.Table, n_docs: int) -> pa.Array:
    """The groups of each text, written `a1,a2|b1;a3|b2,b3;`."""
    # One number for a place in any text: the texts' bytes one after the other.
    ends = np.zeros(n_docs + 1, np.int64)
    np.maximum.at(ends, a["doc"].to_numpy() + 1, a["end"].to_numpy())
    starts = np.cumsum(ends)
    place = [starts[t["doc"].to_numpy()] + t["end"].to_numpy() for t in (shared, a, b)]
    group = [np.searchsorted(place[0], p, "left") for p in place[1:]]
    last = [place[0][g] == p for g, p in zip(group, place[1:])]
    size = [np.bincount(g, minlength=len(place[0])) for g in group]
    before = [np.concatenate([[0], np.cumsum(s)]) for s in size]
    # A's tokens come after B's of the groups before, B's after A's of its own group too.
    at = np.arange(len(a)) + before[1][group[0]], np.arange(len(b)) + before[0][group[1] + 1]
    codes = np.empty(len(a) + len(b), np.int64)
    half = len(sides.bytes)
    codes[at[0]] = a["id"].to_numpy() + half * last[0]
    codes[at[1]] = b["id"].to_numpy() + sides.first_b + half * last[1]
    tokens = np.bincount(a["doc"].to_numpy(), minlength=n_docs) + np.bincount(b["doc"].to_numpy(), minlength=n_docs)
    offsets = pa.array(np.concatenate([[0], np.cumsum(tokens)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, sides.written.take(pa.array(codes))), "")


def pair_sums(links: pa.Table, keys: list[str]) -> pa.Table:
    """Links by `keys`, with the sum of their `n`."""
    return links.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])


def align_texts(sides: Sides, texts: list[str | None], as_text: bool, size: int) -> tuple[list[list], pa.Table]:
    """For each text [n_a, n_b, n_groups, n_links, groups], and (doc, pair, n) of all."""
    found = [[0, 0, 0, 0, "" if as_text else None] for _ in texts]
    same = np.ones(len(texts), bool)
    tables = []
    for lot in lots([(i, t) for i, t in enumerate(texts) if t], size):
        rows = np.array([i for i, _ in lot])
        ids_a, ids_b = sides.encode([w for _, w in lot])
        expected = pa.array([w.encode() for _, w in lot], pa.binary())
        fine = same_bytes(sides, ids_a, 0, expected) & same_bytes(sides, ids_b, sides.first_b, expected)
        same[rows[~fine]] = False
        keep = pa.array(fine & same[rows])
        rows, ids_a, ids_b = rows[keep.to_numpy(zero_copy_only=False)], ids_a.filter(keep), ids_b.filter(keep)
        a, b = token_ends(ids_a, sides.sizes, 0), token_ends(ids_b, sides.sizes, sides.first_b)
        shared, links = group_ends(a, b), links_of(a, b)
        numbers = [np.bincount(t["doc"].to_numpy(), minlength=len(rows)) for t in (a, b, shared, links)]
        for i, row, written in zip(range(len(rows)), rows, groups_text(sides, a, b, shared, len(rows)).to_pylist()):
            for k, number in enumerate(numbers):
                found[row][k] += int(number[i])
            if as_text:
                found[row][4] += written
            else:
                # The mark at the end is held back: it counts only if another window follows.
                if found[row][4] is None:
                    found[row][4] = hashlib.sha256()
                else:
                    found[row][4].update(b";")
                found[row][4].update(written[:-1].encode())
        pair = pc.add(pc.shift_left(links["a"], SHIFT), links["b"])
        doc = pa.array(rows).take(links["doc"])
        tables.append(pair_sums(pa.table({"doc": doc, "pair": pair, "n": pa.repeat(pa.scalar(1, pa.int64()), len(links))}), ["doc", "pair"]))
    for i in np.flatnonzero(~same):
        found[i] = [0, 0, 0, 0, "" if as_text else None]
    for row in found:
        row[4] = row[4].rstrip(";") if as_text else row[4].hexdigest() if row[4] else ""
    empty = pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    pairs = pa.concat_tables([empty, *tables]).filter(pc.is_in(pc.field("doc"), pa.array(np.flatnonzero(same))))
    if len(tables) > 1:
        pairs = pair_sums(pairs, ["doc", "pair"])
    return found, pairs.sort_by([("doc", "ascending"), ("pair", "ascending")])


def linked(docs: DataFrame, path_a: str, path_b: str, names: list[str], text: str, groups: str, size: int = WINDOW_CHARS) -> DataFrame:
    """`docs` without the text, with counts and groups, and as `names` (block, pairs, numbers) the links of each text.

    A block is a run of rows of one task with a bounded amount of text; its rows share the number.
    """
    spark = docs.sparkSession
    spark.conf.set(*BATCH_SETTING)
    shared_a, shared_b = file_text(spark, path_a), model_file(spark, path_b)
    kept = docs.drop(text)
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    block, pairs, numbers = names
    schema = T.StructType(
        kept.schema.fields + [T.StructField(c, T.LongType()) for c in counts] + [T.StructField(groups, T.StringType()), T.StructField(block, T.LongType())]
        + [T.StructField(c, T.ArrayType(T.LongType())) for c in (pairs, numbers)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = kept_in_worker(("alignment", path_a, path_b), lambda: Sides(shared_a.value[1], shared_b.value[1]))
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in pieces(batch, text):
                found, sums = align_texts(sides, piece.column(text).to_pylist(), groups == "groups", size)
                offsets = pa.array(np.searchsorted(sums["doc"].to_numpy(), np.arange(len(found) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, sums[c].combine_chunks()) for c in ("pair", "n")]
                values = [pa.array([f[i] for f in found], pa.int64()) for i in range(4)] + [pa.array([f[4] for f in found], pa.string())]
                own = [c for c, n in zip(piece.columns, piece.schema.names) if n != text]
                yield pa.RecordBatch.from_arrays([*own, *values, pa.repeat(pa.scalar(number, pa.int64()), len(found)), *lists], names=schema.names)
                number += 1

    return docs.select(*kept.columns, text).mapInArrow(run, schema)


def block_counts(found: DataFrame, names: list[str]) -> DataFrame:
    """Partial counts (block, pair, n) of the batches of `linked`."""
    block, pairs, numbers = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = batch.column(pairs)
            parents = pc.list_parent_indices(pair)
            sums = pair_sums(pa.table({"block": batch.column(block).take(parents), "pair": pair.flatten(), "n": batch.column(numbers).flatten()}), ["block", "pair"])
            yield from sums.combine_chunks().to_batches()

    return found.select(*names).mapInArrow(run, "block long, pair long, n long")


def pair_counts(partial: DataFrame) -> DataFrame:
    """(pair, a, b, n_links, best) for all pairs of ids: `best` where no pair with the same B id has more links."""
    sums = partial.groupBy("pair").agg(F.sum("n").alias("n_links"))
    sums = materialize(sums, "pair-counts")
    split = sums.select("pair", F.shiftright("pair", SHIFT).alias("a"), F.col("pair").bitwiseAND((1 << SHIFT) - 1).alias("b"), "n_links")
    most = split.groupBy("b").agg(F.max("n_links").alias("most"))
    return split.join(most, "b").select("pair", "a", "b", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def scored(found: DataFrame, partial: DataFrame, counts: DataFrame, names: list[str]) -> DataFrame:
    """`linked` with `n_best` and `count_sum`: each block meets the counts of its own pairs."""
    block, pairs, numbers = names
    wanted = partial.select("block", "pair").join(counts.select("pair", "n_links", "best"), "pair")
    schema = T.StructType(found.drop(*names).schema.fields + [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")])
    own_columns = schema.names[:-2]

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        pair = rows[pairs].combine_chunks()
        flat = pa.table({"doc": pc.cast(pc.list_parent_indices(pair), pa.int64()), "pair": pair.flatten(), "n": rows[numbers].combine_chunks().flatten()})
        known = known.group_by(["pair"], use_threads=False).aggregate([("n_links", "max"), ("best", "max")]).rename_columns(["pair", "n_links", "best"])
        met = flat.join(known, "pair", join_type="inner", use_threads=False)
        met = met.append_column("at_best", pc.multiply(met["n"], pc.cast(met["best"], pa.int64()))).append_column("weighed", pc.multiply(met["n"], met["n_links"]))
        sums = met.group_by("doc", use_threads=False).aggregate([("at_best", "sum"), ("weighed", "sum")])
        totals = np.zeros((2, len(rows)), np.int64)
        totals[:, sums["doc"].to_numpy()] = sums["at_best_sum"].to_numpy(), sums["weighed_sum"].to_numpy()
        return pa.Table.from_arrays([*(rows[c] for c in own_columns), pa.array(totals[0]), pa.array(totals[1])], names=schema.names)

    return found.groupBy(block).cogroup(wanted.groupBy("block")).applyInArrow(run, schema)


def aligned(docs: DataFrame, path_a: str, path_b: str, text: str = "text", groups: str = "groups", size: int = WINDOW_CHARS) -> tuple[DataFrame, DataFrame]:
    """`docs` without their text but with the alignment of each, and the table of pairs of ids.

    A is the byte-level BPE of the file at `path_a` on a blank and the text, B the SentencePiece model at
    `path_b` on the text. Added are `n_a`, `n_b` (tokens), `n_groups`, `n_links` (pairs of tokens that
    share bytes), `n_best` (links whose pair is the most frequent of its B id), `count_sum` (links of the
    corpus with the same pair, summed over the links) and `groups`, the groups as text, or for
    `groups="groups_sha256"` the digest of that text. The second table is (pair, a, b, n_links, best).

    Null and empty texts, and texts whose bytes the tokens don't give back, have zeros and empty groups.
    Texts of over `size` code points are worked on in windows, so the memory is bounded; a stretch without
    any blank stays whole. Repeated rows stay and count as often as they stand. An empty table gives
    empty tables. Columns of `docs` named like an added one are replaced, all others are kept.
    """
    docs = without(docs, ADDED)
    names = fresh_names(docs, "block", "pairs", "numbers")
    found = materialize(linked(docs, path_a, path_b, names, text, groups, size), "links")
    partial = materialize(block_counts(found, names), "block-counts")
    counts = materialize(pair_counts(partial), "pairs")
    return scored(found, partial, counts, names), counts


def report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The digest columns of the registered query."""
    found, _ = aligned(docs.select("doc_id", "text"), path_a, path_b, groups="groups_sha256")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
