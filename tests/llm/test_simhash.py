"""SimHash near-duplicates against all pairs."""

import random

import plain
from perigee.llm import simhash


def check(docs):
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    prints = [plain.fingerprint(t) for _, t in texts]
    unique = sorted(set(prints))
    roots = dict(zip(unique, plain.groups(unique)))
    least = {}
    for (doc_id, _), p in zip(texts, prints):
        if doc_id is not None:
            least[roots[p]] = min(least.get(roots[p], doc_id), doc_id)
    want = plain.Counter((doc_id, f"{p:016x}", least.get(roots[p])) for (doc_id, _), p in zip(texts, prints))
    assert plain.rows(simhash.report(docs), "doc_id", "fingerprint", "component_id") == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(plain.fingerprint(r["text"]) and roots[plain.fingerprint(r["text"])] for r in kept.collect()) == sorted(p and roots[p] for p in {unique[r] for r in roots.values()})


def test_tables(spark):
    check(spark.read.parquet(f"{plain.SF}/documents.parquet"))


def test_awkward_rows(spark):
    check(plain.awkward(spark, "simhash row_1 component_id"))


def test_empty(spark):
    assert simhash.report(plain.empty(spark)).collect() == [] and simhash.one_of_each(plain.empty(spark)).collect() == []


def test_links_and_chains(spark):
    draw = random.Random(8)
    values = [draw.getrandbits(64) for _ in range(60)]
    for v in values[:20]:
        for _ in range(6):  # a chain of small steps, and a star of near copies
            v ^= sum(1 << b for b in draw.sample(range(64), draw.randrange(1, 5)))
            values.append(v)
    values += [values[0] ^ 1 << b for b in range(64)] + [0, (1 << 64) - 1, 1 << 63]
    unique = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in unique]
    prints = spark.createDataFrame([(v,) for v in signed], "simhash bigint")
    want = {tuple(sorted((signed[i], signed[j]))) for i in range(len(unique)) for j in range(i) if (unique[i] ^ unique[j]).bit_count() <= 3}
    pairs = simhash.links(prints)
    assert {tuple(r) for r in pairs.collect()} == want
    found = {r["node"]: r["root"] for r in simhash.components(pairs).collect()}
    for a, b in want:
        assert found[a] == found[b]
    roots = plain.groups(unique)
    assert len(set(found.values())) == len({roots[i] for i, v in enumerate(signed) if v in found})


def test_links_are_not_broadcast_when_generated(spark):
    plan = simhash.links(spark.range(1000).selectExpr("id AS simhash"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
