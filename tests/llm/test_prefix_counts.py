"""Counts of prefixes against the tokenizer's own library."""

import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from perigee.llm import prefix_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
POOL = ["a", "th", " ", "   ", "▁", "é", "日", "🙂", "\n", "<s>", "0", "12", "=", "in", "ing", "\x00", "́", "的", "tion"]
DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_every_prefix_has_the_count_of_the_library():
    with open(PATH, "rb") as f:
        own = prefix_counts.PrefixCounter(f.read())
    rng, b = random.Random(3), library()
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for text in [*texts, " " * 40 + "word", "a" + " " * 33 + "b", "", "x" * 70]:
        steps = own.steps(text)
        assert prefix_counts.tokens_at(steps, range(len(text) + 1)) == [len(b.encode(text[:k])) for k in range(len(text) + 1)]


def test_budget_ends_at_the_longest_prefix_that_fits():
    with open(PATH, "rb") as f:
        own = prefix_counts.PrefixCounter(f.read())
    b = library()
    for text in ["The internationalization of tokens", "aaaa  bbbb  internationally", "日本の言葉 and words"]:
        for budget in range(12):
            chars, tokens = prefix_counts.longest(own.steps(text), budget)
            assert chars == max(k for k in range(len(text) + 1) if len(b.encode(text[:k])) <= budget)
            assert tokens == len(b.encode(text[:chars]))


def test_awkward_rows(spark):
    rows = [(1, None, "x"), (1, "", "y"), (2, "same text", "z"), (2, "same text", "z"), (None, " ", None), (3, "long " * 200_000, "l"), (4, "q" * 50_000, "l")]
    docs = spark.createDataFrame(rows, SCHEMA + ", steps string").withColumn("n_tokens", F.lit("mine"))
    found = prefix_counts.fitted(prefix_counts.with_steps(docs, PATH), 10).withColumn("head", prefix_counts.cut(F.col("text"), F.col("fit_chars")))
    b = library()
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_tokens == len(b.encode(r.text or ""))
        assert r.fit_tokens <= 10 and r.fit_tokens == len(b.encode(r.head or ""))
    assert prefix_counts.fitted(prefix_counts.with_steps(docs.limit(0), PATH), 10).count() == 0


def test_counts_at_places(spark):
    docs = spark.createDataFrame([(1, "some words here", [0, 4, 99, -1]), (2, None, [3]), (3, "a", None)], SCHEMA + ", places array<long>")
    got = {r.doc_id: r.tokens_at for r in prefix_counts.counted_at(prefix_counts.with_steps(docs, PATH), "places").collect()}
    b = library()
    assert got == {1: [0, len(b.encode("some")), len(b.encode("some words here")), 0], 2: [0], 3: []}
    assert [r.n_tokens for r in prefix_counts.counted(prefix_counts.with_steps(docs, PATH)).orderBy("doc_id").collect()] == [3, 0, 1]


def test_report_over_the_table(spark, sf_dir=DATA):
    from perigee.llm.queries import op12_token_counts

    b = library()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op12_token_counts(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(b.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)
