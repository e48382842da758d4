"""The prefix trie against a walk over all prefixes, and tree contraction against recursion."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from perigee.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Sorted rows of the trie; turns with equal numbers must be equal."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    members = defaultdict(list)
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + ts[h:])
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def words(text):
        return len([w for w in text.translate({i: " " for i in range(9, 14)}).split(" ") if w])

    totals = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * words(p[-1][1]) if p else 0
        totals[p] = (sum(totals[c][0] for c in children[p]) or 1, saved + sum(totals[c][1] for c in children[p]))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *totals[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if built[c] == p).encode()).hexdigest())
        for p, m in members.items())


def check(spark, rows, partitions=4):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = sorted((tuple(r) for r in prefix_trie.trie(docs).collect()), key=lambda r: r[:2])
    assert got == plain(rows)


def test_random_conversations(spark):
    rng = random.Random(4)
    rows = []
    for c in [*range(70), 1000, 1001, 123456789]:
        rows += [(c, t, rng.choice(["user", "system", None]), rng.choice(["a b", "c", "", None, "some more\twords"])) for t in range(rng.randint(1, 5))]
    check(spark, rows)


def test_copies_ends_and_hot_nodes(spark):
    # One conversation copied into most ids, with ids on both sides of a chunk of ends.
    rows = [(c, t, "user", f"turn {t}") for c in range(4000, 4200) for t in range(3)]
    rows += [(c, t, "user", f"turn {t} {c}" if t else "turn 0") for c in range(20) for t in range(2)]
    check(spark, rows)


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"), (5, None, None, None), (5, 0, "user", "x"), (5, 1, "user", "y"), (5, 1, "user", "y"),
        (7, -3, "user", "first"), (7, 2, "", "last"), (-4, 0, "user", "negative"), (21, 0, "user", "  w 　"), (40, 0, "user", "long " * 100_000),
    ]
    check(spark, rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    extra = docs.withColumns({"depth": F.lit("x"), "k1": F.lit("y"), "m": F.create_map(F.lit(1), F.lit(2))})
    assert sorted(map(tuple, prefix_trie.trie(extra).collect()), key=lambda r: r[:2]) == plain(rows)
    assert prefix_trie.trie(docs.limit(0)).collect() == []
    assert prefix_trie.trie(docs.filter("conv_id IS NULL")).collect() == []


def test_one_conversation_over_many_ranges_and_runs(spark):
    rows = [(0, t, "user", f"turn {t % 7}") for t in range(2_600)] + [(1, t, "user", f"turn {t % 7}") for t in range(2_000)]
    check(spark, rows, 8)


def test_contraction_of_any_tree(spark):
    rng = random.Random(9)
    parents = {0: None}
    for i in range(1, 200):
        # Chains, stars and anything between.
        parents[i] = i - 1 if rng.random() < 0.7 else rng.randrange(i) if rng.random() < 0.5 else 0
    weights = {i: rng.randint(0, 9) for i in parents}
    rows = [(i, 5, p, None if p is None else 5, weights[i]) for i, p in parents.items()]
    tree = spark.createDataFrame(rows, "c long, d long, pc long, pd long, w long")
    totals = dict(weights)
    for i in sorted(parents, reverse=True):
        if parents[i] is not None:
            totals[parents[i]] += totals[i]
    assert {r.c: r.w for r in prefix_trie.contracted(tree, ["w"]).collect()} == totals


def test_rounds_grow_slowly_with_the_depth(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(prefix_trie, "heads_up", lambda turn, coin=prefix_trie.heads_up: rounds.append(turn) or coin(turn))
    tree = spark.createDataFrame([(i, 0, i - 1 if i else None, 0 if i else None, 1) for i in range(150)], "c long, d long, pc long, pd long, w long")
    found = {r.c: r.w for r in prefix_trie.contracted(tree, ["w"]).collect()}
    assert found == {i: 150 - i for i in range(150)} and len(rounds) < 25
