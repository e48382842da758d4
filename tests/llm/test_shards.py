"""Shards: the law of rows, slots without gaps, and the same result from every run."""

import zlib

import numpy as np
import plain
from perigee.llm import shards
from pyspark.sql import functions as F

WHERE = ["_metadata.file_path", "_metadata.row_index"]


def identity():
    return [F.col(c) for c in WHERE]


def check(found, docs):
    got = found.collect()
    want = plain.Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert plain.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 40
    counts = [len(slots.get(s, [])) for s in range(40)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = shards.report(docs, identity())
    check(found, docs)
    again = shards.report(docs.repartition(7).select(*docs.columns, *[F.col(c).alias(c.split(".")[1]) for c in WHERE]), [F.col("file_path"), F.col("row_index")])
    assert plain.rows(again, "doc_id", "shard", "slot") == plain.rows(found, "doc_id", "shard", "slot")


def test_order_is_random(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text")
    found = shards.shuffled(docs, [F.col("doc_id")], bucket_bytes=2000).toPandas()
    place = found.sort_values(["shard", "slot"]).doc_id.to_numpy()
    assert abs(np.corrcoef(place, range(4000))[0, 1]) < 0.06


def test_neighbouring_buckets_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(shards, "MAX_TASKS", 3)
    docs = spark.range(1000).selectExpr("id AS doc_id", "repeat('t', cast(id % 50 as int)) AS text")
    found = shards.shuffled(docs, [F.col("doc_id")], bucket_bytes=1000)
    check(found.withColumn("text_crc32", F.crc32("text")), docs)
    again = shards.shuffled(docs.repartition(5), [F.col("doc_id")], bucket_bytes=1000)
    assert plain.rows(found, "doc_id", "shard", "slot") == plain.rows(again, "doc_id", "shard", "slot")
    monkeypatch.setattr(shards, "BROADCAST_BUCKETS", 1)
    assert plain.rows(found, "doc_id", "shard", "slot") == plain.rows(shards.shuffled(docs, [F.col("doc_id")], bucket_bytes=1000), "doc_id", "shard", "slot")


def test_awkward_rows(spark, tmp_path):
    plain.awkward(spark, "shard size other").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    check(shards.report(docs, identity()), docs)
    found = shards.shuffled(docs, identity())
    assert found.filter("other = 'own'").count() == len(plain.AWKWARD) and found.columns[-5:] == list(shards.PLACES)


def test_empty(spark, tmp_path):
    plain.empty(spark).write.parquet(str(tmp_path / "d"))
    assert shards.report(spark.read.schema(plain.SCHEMA).parquet(str(tmp_path / "d")), identity()).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{plain.SF}/documents.parquet")
    plan = shards.shuffled(docs, identity())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
