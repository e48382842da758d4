"""Token files: the library's ids after a round trip, and Simple-8b on awkward values."""

import random
import zlib

import numpy as np
import plain
import public_tokenizers
from perigee.llm import token_files
from pyspark.sql import functions as F
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(docs, ties=None):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        want.append((r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    found = token_files.report(docs, PATH, ties).collect()
    assert plain.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == plain.Counter(want)
    place = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == place
        place += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_tables(spark):
    check(spark.read.parquet(f"{plain.SF}/documents.parquet"), [F.col("_metadata.file_path"), F.col("_metadata.row_index")])


def test_awkward_rows(spark):
    check(plain.awkward(spark, "key tie chunk start ids"))


def test_empty(spark):
    assert token_files.report(plain.empty(spark), PATH).collect() == []


def test_several_ranges_and_read_back(spark):
    # Small ranges aren't merged, so the few rows lie in several.
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        check(plain.awkward(spark))
    finally:
        spark.conf.set(merge, before)
    docs = spark.createDataFrame([(i, "some words") for i in range(20)], "doc_id bigint, text string")
    found = token_files.read_tokens(spark, token_files.write_tokens(docs, PATH)).collect()
    assert sorted(r["start"] for r in found) == [i * len(found[0]["ids"]) for i in range(20)]
    assert all(r["ids"][-1] == 1 for r in found)


def test_round_trip_of_any_values():
    draw = random.Random(4)
    for n in (0, 1, 2, 59, 60, 61, 1023, 1024, 1025, 5000):
        for top in (0, 1, 20, 49_408, 1 << 31, (1 << 60) - 1, 1 << 60, (1 << 64) - 1):
            ids = np.array([draw.randint(0, draw.choice((1, top, top >> 3))) for _ in range(n)], np.uint64)
            words, stretches, escapes = token_files.pack(ids)
            assert (token_files.unpack(words, stretches, escapes, n) == ids).all()
            if n and top < 2:
                assert len(words) <= n // 60 + 2 * (n // 1024 + 1)


def test_any_number_of_ranges(spark):
    docs = spark.createDataFrame([(i, "some words " * (i % 9)) for i in range(200)], "doc_id long, text string").repartition(5)
    found = []
    for ranges in (None, 1, 3, 40):
        out = token_files.write_tokens(docs, PATH, ranges=ranges)
        chunks = spark.read.parquet(out).select("chunk").distinct().count()
        assert ranges is None or chunks <= ranges and (chunks > 1) == (ranges > 1)
        found.append({r["doc_id"]: (r["ids"], r["start"]) for r in token_files.read_tokens(spark, out).collect()})
    assert all(f == found[0] for f in found) and len(found[0]) == 200
