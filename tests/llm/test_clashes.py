"""Every operator on documents whose other columns are named like its own, with a map among them."""

import plain
import public_tokenizers
from perigee.llm import alignment, bpe, decontaminate, line_spread, prefix_counts, quality, secrets, shards, simhash
from pyspark.sql import functions as F

NAMES = "row_1 row_2 __1 __2 __lines __kept __size __text whole found_leaks row_size row_hash row_bucket row_place split_text block pairs numbers own_key Kept"


def documents(spark):
    rows = [(1, "some words on a line\nand more of them here", "en", "s1", 1), (2, None, None, None, None), (3, "long " * 40_000, "en", "s2", 1), (3, "long " * 40_000, "en", "s2", 1)]
    docs = spark.createDataFrame(rows, plain.SCHEMA).repartition(2)
    return docs.select("*", *[F.lit(n).alias(n) for n in NAMES.split()], F.create_map(F.lit("k"), F.lit("v")).alias("tags"))


def same(found, docs, rows=None):
    """The other columns are there with their values."""
    got = found.collect()
    assert len(got) == (docs.count() if rows is None else rows)
    assert set(docs.columns) <= set(found.columns)
    assert all(r[n] == n for r in got for n in NAMES.split()) and all(r["tags"] == {"k": "v"} for r in got)


def test_all(spark):
    docs = documents(spark)
    labels = spark.read.parquet(f"{plain.SF}/labels.parquet")
    whole = spark.read.parquet(f"{plain.SF}/documents.parquet")
    chain = quality.fit(whole, labels)
    path, pieces = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    items = spark.createDataFrame([(7, "no such words in any of these texts")], "item_id long, text string")
    same(secrets.scanned(docs, secrets.fit(whole)), docs)
    same(bpe.encoded(docs, path), docs)
    same(quality.retained(docs.withColumn("text", F.lit(whole.filter("length(text) > 900").first().text)), chain, 0.0), docs)
    same(shards.shuffled(docs, [F.monotonically_increasing_id()]), docs)
    same(simhash.one_of_each(docs), docs, 3)
    same(decontaminate.without_leaks(docs, items), docs)
    same(line_spread.without_boilerplate(docs), docs)
    same(prefix_counts.fitted(prefix_counts.with_steps(docs, pieces), 5), docs)
    found, _ = alignment.aligned(docs, path, pieces)
    assert found.count() == 4 and all(r[n] == n for r in found.collect() for n in NAMES.split())


def test_many_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 1)
    items = spark.createDataFrame([(7, "some words on a line"), (8, "and nothing else at all")], "item_id long, text string")
    docs = documents(spark)
    same(decontaminate.without_leaks(docs, items), docs, 3)
    assert {tuple(leak)[0] for r in decontaminate.marked(docs, items).collect() for leak in r["leaks"]} == {7}
