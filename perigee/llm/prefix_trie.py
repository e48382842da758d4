"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A turn's place is its rank among the sorted turns, found from ranges of the sorted table, so a
conversation of any length is spread over tasks. The key of a prefix is a sum of hashes of its turns and
their places, so prefixes are sums over runs of places and the totals of the runs before.

Totals of subtrees come from contracting the trie. A round rakes the leaves (their totals are final and
go to their parents), then compresses chains: of the nodes with one child left, those whose coin shows
heads while their child's doesn't are spliced out, their own share goes to the parent, and the child
moves up. Rounds join nodes and what their neighbours tell them by node id; their number grows with the
logarithm of the trie, however deep it is. Last, the spliced nodes return in reverse order: each is its
own share and the total of the child it had.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from perigee.llm.common import BATCH_SETTING, WORD_PATTERN
from perigee.runtime import materialize

# A conversation takes the opening of the first one of its family, of at most HEADS - 1 turns.
FAMILY = 20
HEADS = 4
RUN = 1_024
# Sums of hashes cut to 31 bits stay exact for 2^32 turns; four of them tell prefixes apart.
PARTS = 4
KEY = ["k1", "k2"]
ENDS_IN_CHUNK = 4_096
COPIES_IN_STEP = 65_536


def written(df: DataFrame, name: str) -> DataFrame:
    """A table of a round that the expansion reads again, in files by size: rounds leave ever fewer rows."""
    return materialize(df.hint("rebalance"), name)


def head_turns(conv_id: Column) -> Column:
    """How many turns of the family's first conversation a conversation opens with."""
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("bigint")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, t1, t2, words, copies): distinct turns by hash of role and text, and how often each stands."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(7), role, text).alias("t2"), F.regexp_count(text, F.lit(WORD_PATTERN)).cast("bigint").alias("words"))
    return rows.groupBy("conv_id", "turn", "t1", "t2").agg(F.first("words").alias("words"), F.count("*").alias("copies"))


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as (conv_id, place, opening, t1, t2, words), and (conv_id, n, heads, opening).

    Places count from 1 in the order of `turn`, null first, then of the hashes. `opening` is the number
    of turns taken over from the family's first conversation.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")]
    # The number of a row holds its range above bit 33 and its place in the range below.
    ranged = turns(conversations).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    ranged = materialize(ranged, "turns").withColumn("range", F.shiftright("row", 33))
    spans = ranged.groupBy("conv_id", "range").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv_id", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(Window.partitionBy("conv_id")).alias("n"))
    convs = spans.filter("base = 0").select("conv_id", "n", head_turns(F.col("conv_id")).alias("heads"))
    firsts = convs.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("family"), F.col("n").alias("n_family"))
    joined = convs.join(firsts, convs["conv_id"] - convs["conv_id"] % FAMILY == firsts["family"], "left")
    convs = materialize(joined.select(*convs.columns, F.least("heads", F.coalesce("n_family", F.lit(0))).alias("opening")), "conversations")
    spans = spans.select("conv_id", "range", "base").join(convs.select("conv_id", "opening"), "conv_id")
    inside = Window.partitionBy("conv_id", "range").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(spans, ["conv_id", "range"])
    # Copies of a turn in two steps, so that no list of them is long.
    steps = counted.withColumn("step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES_IN_STEP).cast("bigint"))))
    last = F.least(F.col("step") + COPIES_IN_STEP, F.col("copies")) - 1
    copies = steps.withColumn("copy", F.explode(F.sequence("step", last)))
    placed = copies.select("conv_id", (F.col("base") + F.col("inside") + F.col("copy") + 1).alias("place"), "opening", "t1", "t2", "words")
    return placed, convs


def rebuilt(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, t1, t2, words): the opening of the family's first conversation, then the own turns after it."""
    own = placed.filter(F.col("place") > head_turns(F.col("conv_id")))
    own = own.select("conv_id", (F.col("place") - head_turns(F.col("conv_id")) + F.col("opening")).alias("depth"), "t1", "t2", "words")
    firsts = placed.filter((F.col("place") < HEADS) & (F.col("conv_id") % FAMILY == 0)).select(F.col("conv_id").alias("family"), F.col("place").alias("depth"), "t1", "t2", "words")
    wanted = convs.filter("opening > 0").select("conv_id", "opening", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"))
    heads = wanted.join(firsts, "family").filter("depth <= opening")
    return own.unionByName(heads.select(own.columns))


def prefixes(rows: DataFrame) -> DataFrame:
    """`rows` with `k1` and `k2`, the key of the prefix that ends with the turn, and `p1` and `p2`, that of the one before."""
    hashes = [F.shiftrightunsigned(F.xxhash64(F.lit(i), "depth", "t1", "t2"), 33).alias(f"s{i}") for i in range(PARTS)]
    hashed = rows.select("conv_id", "depth", "words", F.floor(F.col("depth") / RUN).alias("run"), *hashes)
    sums = [f"s{i}" for i in range(PARTS)]
    inside = Window.partitionBy("conv_id", "run").orderBy("depth")
    totals = hashed.groupBy("conv_id", "run").agg(*[F.sum(s).alias(s) for s in sums])
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("conv_id", "run", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"b{s}") for s in sums])
    inner = hashed.select("*", *[F.sum(s).over(inside).alias(f"i{s}") for s in sums]).join(bases, ["conv_id", "run"])
    here = [F.col(f"b{s}") + F.col(f"i{s}") for s in sums]
    above = [a - F.col(s) for a, s in zip(here, sums)]

    def key(seed: int, depth: Column, parts: list[Column]) -> Column:
        return F.when(depth > 0, F.xxhash64(F.lit(seed), depth, *parts)).otherwise(F.lit(0))

    depth = F.col("depth")
    return inner.select("conv_id", "depth", "words", key(1, depth, here).alias("k1"), key(2, depth, here).alias("k2"), key(1, depth - 1, above).alias("p1"), key(2, depth - 1, above).alias("p2"))


def digest_of_ends(ends: DataFrame) -> DataFrame:
    """(k1, k2, conv_id) -> (k1, k2, ends_sha256): the digest of the sorted ids of each key, joined by commas.

    Ids are joined in chunks of neighbouring ids; one task then reads the chunks of a key one by one, as the
    digest is defined on their sequence, and holds only its state.
    """
    ends.sparkSession.conf.set(*BATCH_SETTING)
    chunk = F.floor(F.col("conv_id") / ENDS_IN_CHUNK)
    chunks = ends.groupBy(*KEY, chunk.alias("chunk")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"))
    ordered = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None

        def closed(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], names=[*KEY, "ends_sha256"])

        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if at == (k1, k2):
                    state.update(b"," + ids.encode())
                else:
                    if at:
                        done.append((*at, state.hexdigest()))
                    at, state = (k1, k2), hashlib.sha256(ids.encode())
            yield closed(done)
        if at:
            yield closed([(*at, state.hexdigest())])

    return ordered.mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def nodes(conversations: DataFrame) -> DataFrame:
    """The trie's nodes: (conv_id, depth, parent_conv_id, n_convs, n_children, own_saved, ends_sha256).

    `conv_id` is the smallest conversation that starts with the node's turns; with the depth it names the node.
    """
    placed, convs = numbered(conversations)
    placed = materialize(placed, "placed-turns")
    members = materialize(prefixes(rebuilt(placed, convs)), "prefixes")
    length = F.col("opening") + F.greatest(F.lit(0), F.col("n") - F.col("heads"))
    lengths = convs.select("conv_id", length.alias("depth"))
    lasts = members.select("conv_id", "depth", *KEY).join(lengths, ["conv_id", "depth"], "left_semi")
    turnless = lengths.filter("depth = 0").select("conv_id", F.lit(0).cast("bigint").alias("k1"), F.lit(0).cast("bigint").alias("k2"))
    ends = digest_of_ends(lasts.select("conv_id", *KEY).unionByName(turnless))
    found = members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
        F.count("*").alias("n_convs"), F.first("words").alias("words"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").selectExpr(
        "0L AS k1", "0L AS k2", "conv_id", "0L AS depth", "null AS p1", "null AS p2", "n_convs", "0L AS words")
    found = materialize(found.unionByName(root), "trie")
    # Nodes of depth 1, however many, have the one root; the others meet their parents by key.
    top = found.filter("depth = 0").select("conv_id").first()
    top = F.lit(top.conv_id if top else None).cast("bigint")
    parents = found.filter("depth > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    deep = found.filter("depth > 1").join(parents, ["p1", "p2"])
    linked = deep.unionByName(found.filter("depth = 1").withColumn("parent_conv_id", top)).unionByName(found.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")))
    counts = found.filter("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    full = linked.join(counts, KEY, "left").join(ends, KEY, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return materialize(full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")), "nodes")


def heads_up(turn: int) -> Column:
    """The coin of a node in a round."""
    return F.xxhash64(F.lit(turn), "c", "d") % 2 == 0


def _messages(rows: DataFrame, *messages: dict[str, Column | str | int | bool | None]) -> DataFrame:
    """For each row one row per message; a message names the node (c, d) it is for, and its other columns."""
    def value(v) -> Column:
        return F.col(v) if isinstance(v, str) else v if isinstance(v, Column) else F.lit(v)

    sent = F.inline(F.array(*[F.struct(*[value(v).alias(k) for k, v in m.items()]) for m in messages]))
    return rows.select(sent).filter("c IS NOT NULL")


def contracted(tree: DataFrame, sums: list[str]) -> DataFrame:
    """(c, d, *sums) -> totals over the subtree of each node of `tree` (c, d, pc, pd, *sums).

    (c, d) names a node and (pc, pd) its parent; the root's is null. In each step the nodes and what
    others tell them meet in one aggregate by node; each step's table is written.
    """
    none = F.lit(None).cast("bigint")
    keep, nothing = {s: s for s in sums}, {s: F.lit(0).cast("bigint") for s in sums}
    totals = [F.sum(s).alias(s) for s in sums]
    place = [F.max("pc").alias("pc"), F.max("pd").alias("pd")]
    final, spliced, turn = [], [], 0
    alive = tree.select("c", "d", "pc", "pd", *sums)
    while True:
        # Rake: what has no child is done, and its parent takes its totals.
        told = _messages(
            alive, {"c": "c", "d": "d", "pc": "pc", "pd": "pd", **keep, "inner": False},
            {"c": "pc", "d": "pd", "pc": none, "pd": none, **nothing, "inner": True})
        flagged = written(told.groupBy("c", "d").agg(*place, *totals, F.max("inner").alias("inner")), "trie-rake")
        final.append(flagged.filter("NOT inner").select("c", "d", *sums))
        inner = F.col("inner")
        told = _messages(
            flagged, {"c": "c", "d": "d", "pc": "pc", "pd": "pd", **keep, "inner": "inner", "kids": 0, "kc": none, "kd": none},
            {"c": "pc", "d": "pd", "pc": none, "pd": none, **{s: F.when(inner, 0).otherwise(F.col(s)).cast("bigint") for s in sums}, "inner": False,
             "kids": inner.cast("int"), "kc": F.when(inner, F.col("c")), "kd": F.when(inner, F.col("d"))})
        body = told.groupBy("c", "d").agg(*place, *totals, F.max("inner").alias("inner"), F.sum("kids").alias("kids"), F.max("kc").alias("kc"), F.max("kd").alias("kd"))
        left = Observation()
        body = materialize(body.filter("inner").observe(left, F.count(F.lit(1)).alias("nodes")), "trie-body")
        # The count comes with the write; where the plan had nothing to count, the table is asked.
        nodes = left.get.get("nodes")
        if nodes == 0 or nodes is None and body.isEmpty():
            break
        # Compress: every other node of a chain, as coins fall, is spliced out.
        drawn = body.filter((F.col("kids") == 1) & F.col("pc").isNotNull() & heads_up(turn)).select("c", "d", "pc", "pd", *sums, "kc", "kd")
        below = drawn.select(F.col("c").alias("kc"), F.col("d").alias("kd"))
        out = written(drawn.join(below, ["kc", "kd"], "left_anti"), "trie-spliced")
        spliced.append(out)
        same = {"npc": none, "npd": none}
        told = _messages(
            out, {"c": "c", "d": "d", "pc": none, "pd": none, **nothing, "gone": True, **same},
            {"c": "pc", "d": "pd", "pc": none, "pd": none, **keep, "gone": False, **same},
            {"c": "kc", "d": "kd", "pc": none, "pd": none, **nothing, "gone": False, "npc": "pc", "npd": "pd"})
        told = body.select("c", "d", "pc", "pd", *sums, F.lit(False).alias("gone"), none.alias("npc"), none.alias("npd")).unionByName(told)
        kept = told.groupBy("c", "d").agg(*place, *totals, F.max("gone").alias("gone"), F.max("npc").alias("npc"), F.max("npd").alias("npd")).filter("NOT gone")
        alive = kept.select("c", "d", F.coalesce("npc", "pc").alias("pc"), F.coalesce("npd", "pd").alias("pd"), *sums)
        turn += 1
    # Expand: a node spliced in a round has the total of its child, which left in a later one.
    later = final[len(spliced)]
    for turn in reversed(range(len(spliced))):
        known = later.select(F.col("c").alias("kc"), F.col("d").alias("kd"), *[F.col(s).alias(f"more_{s}") for s in sums])
        back = spliced[turn].join(known, ["kc", "kd"]).select("c", "d", *[(F.col(s) + F.col(f"more_{s}")).alias(s) for s in sums])
        later = later.unionByName(written(back, "trie-expanded")).unionByName(final[turn])
    return later


def trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of `conversations` (conv_id, turn, role, text), one row per node.

    Turns are ordered by `turn`, null first, equal ones by hash; null roles and texts are empty. Each
    conversation c opens with up to crc32(c) % 4 turns of conversation c - c % 20, in place of as many
    own ones; an absent one gives none. A node is a distinct sequence of turns at the start of such
    conversations, the root the empty one. `n_leaves` and `saved_tokens` (words that need not be stored
    again) are totals over its subtree. Rows with a null conv_id belong to no conversation. A turn that
    stands twice is two turns. No conversations give no rows, not even a root. Other columns are not read.
    """
    found = nodes(conversations)
    tree = found.select(
        F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("pc"), F.when(F.col("depth") > 0, F.col("depth") - 1).alias("pd"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves"), F.col("own_saved").alias("saved_tokens"))
    totals = contracted(tree, ["n_leaves", "saved_tokens"]).withColumnsRenamed({"c": "conv_id", "d": "depth"})
    return found.join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


REPORT_SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS family,
         xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
             lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
               lambda x, unused: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 4 AS heads
  FROM turns),
rebuilt AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth
  FROM (SELECT c.conv_id, 0 AS part, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.family AND place <= heads
        UNION ALL
        SELECT conv_id, 1, place, role, text FROM convs JOIN turns USING (conv_id) WHERE place > heads)),
members AS (
  SELECT conv_id, depth, list(md5(role) || md5(text)) OVER (PARTITION BY conv_id ORDER BY depth) AS prefix,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
lengths AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id),
nodes AS (
  SELECT prefix, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved
  FROM members GROUP BY prefix),
ends AS (
  SELECT prefix, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM members JOIN lengths USING (conv_id, depth) GROUP BY prefix),
links AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.prefix AS parent
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[:n.depth - 1]),
children AS (SELECT parent AS prefix, count(*) AS n_children FROM links WHERE depth > 0 GROUP BY parent),
marked AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)),
above AS (SELECT *, unnest(range(0, depth + 1)) AS up FROM marked),
totals AS (
  SELECT prefix[:up] AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM above GROUP BY prefix[:up])
SELECT conv_id, depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM links LEFT JOIN children USING (prefix) JOIN totals USING (prefix) LEFT JOIN ends USING (prefix)
"""
