"""Decontamination against its SQL and against exact containment of every pair."""

import random

import plain
from compare import connect, differences
from perigee.llm import decontaminate, queries


def test_sql(spark):
    found = queries.op7_decontamination(spark, plain.SF)
    assert differences(found, queries.SQL["op7_decontamination"], connect(plain.SF)) == []


def found_in(docs, items):
    table = docs.sparkSession.createDataFrame([(k, v) for k, v in items.items()], "item_id bigint, text string")
    return decontaminate.marked(docs, table)


def test_items_of_every_size_anywhere_in_long_texts(spark):
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = {n: " ".join(draw.choices(vocabulary, k=n)) for n in (1, 2, 4, 5, 6, 8, 9, 12, 13, 20, 21, 40, 70, 130, 300)}
    rows = []
    for n, item in items.items():
        words = item.split()
        for size in (0, 50, 3000):
            at, body = draw.randrange(size + 1), draw.choices(vocabulary, k=size)
            body[at:at] = words
            rows.append((len(rows), " ".join(body).upper() if size == 50 else " \n".join(body)))
            changed = list(words)
            if n > 40:  # one word changed breaks up to five shingles
                changed[n // 2] = "other"
            rows.append((len(rows), " ".join(draw.choices(vocabulary, k=size) + changed)))
            rows.append((len(rows), " ".join(draw.choices(vocabulary, k=size) + words[: n // 2])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for r in found_in(docs, items).collect():
        assert {x["item_id"] for x in r["leaks"]} == plain.contained(r["text"], items)
        for x in r["leaks"]:
            assert x["n_shingles"] == len(plain.shingle_set(items[x["item_id"]]))


def test_awkward_rows(spark):
    items = {1: None, 2: "", 3: " \t", 4: "word", 5: "plain text of some words, which says", None: "no id here", 6: "WORD", 7: plain.LONG * 2}
    found = found_in(plain.awkward(spark, "leaks id other"), items).collect()
    real = {k: v for k, v in items.items() if k is not None and v and v.strip()}
    assert len(found) == len(plain.AWKWARD)
    for r in found:
        assert {x["item_id"] for x in r["leaks"]} == plain.contained(r["text"], real) and r["other"] == "own"


def test_empty(spark):
    assert found_in(plain.empty(spark), {1: "some words that are here"}).collect() == []
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.without_leaks(plain.awkward(spark), none).count() == len(plain.AWKWARD)


def test_one_block_of_items_is_held_at_a_time(spark, monkeypatch):
    from pyspark import SparkContext
    from pyspark.core.broadcast import Broadcast

    draw = random.Random(4)
    items = {n: " ".join(draw.choices([f"w{i}" for i in range(500)], k=12)) for n in range(20)}
    texts = [f"{items[n]} and {items[19 - n]}" for n in range(20)] + [items[3], items[3], None, "", "nothing of it"]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], plain.SCHEMA).repartition(3)
    shown = [*docs.columns, "to_json(leaks)"]
    want = plain.rows(found_in(docs, items).selectExpr(*shown), "*")
    assert sum(r[-1].count("item_id") for r in want.elements()) == 42
    held, most, send, destroy = set(), [], SparkContext.broadcast, Broadcast.destroy

    def sent(self, value):
        shared = send(self, value)
        held.add(id(shared))
        most.append((len(held), len(value)))
        return shared

    def destroyed(self, blocking=False):
        held.discard(id(self))
        destroy(self, blocking)

    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 6)
    monkeypatch.setattr(SparkContext, "broadcast", sent)
    monkeypatch.setattr(Broadcast, "destroy", destroyed)
    assert plain.rows(found_in(docs, items).selectExpr(*shown), "*") == want
    assert len(most) == 4 and max(n for n, _ in most) == 1 and sum(size for _, size in most) == 20
