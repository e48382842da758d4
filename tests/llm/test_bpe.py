"""BPE by tree concatenation against the library itself."""

import hashlib
import random

import plain
import public_tokenizers
import pytest
from perigee.llm import bpe
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(docs, library):
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert plain.rows(bpe.report(docs, PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == plain.Counter(want)


def test_tables(spark, library):
    check(spark.read.parquet(f"{plain.SF}/documents.parquet"), library)


def test_awkward_rows(spark, library):
    check(plain.awkward(spark, "ids decoded marks part"), library)


def test_empty(spark):
    assert bpe.report(plain.empty(spark), PATH).collect() == []


def test_small_leaves_give_the_same_ids(library):
    with open(PATH, encoding="utf-8") as f:
        own = bpe.Encoder(f.read(), leaf=5)
    draw = random.Random(1)
    parts = ["the ", "a", " ", "  ", "\n", "\n\n", "'s", "'", "12", "é", "漢字", "　", "x" * 40, "aaaaabaaab", "<|endoftext|>", ".", "...", "\U0001f600", " 'll", "\t", "ª", "́"]
    for _ in range(400):
        text = "".join(draw.choices(parts, k=draw.randrange(1, 60)))
        ids = library.encode(text, add_special_tokens=False).ids
        found = bpe.np.frombuffer(own.encode(text), "<i4")
        assert found.tolist() == ids, text
        assert own.decode(found) == library.decode(ids, skip_special_tokens=False)


def test_parts_in_different_tasks(spark, library):
    texts = [plain.LONG * 30, "ab" * 700 + "<|endoftext|>" + " x" * 900, "<|endoftext|>" * 3 + "y" * 333, "\n" * 500 + " " * 700, "漢" * 400]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts)], "doc_id int, text string")
    found = bpe.encoded(docs, PATH, leaf=16, part=64).collect()
    assert len(found) == len(texts) * 2
    for r in found:
        assert r["ids"] == library.encode(r["text"], add_special_tokens=False).ids


def test_unknown_ids_and_broken_bytes_decode(spark):
    docs = spark.createDataFrame([(1, [160, 10**6, -1]), (2, None), (3, [])], "doc_id int, ids array<int>")
    found = {r["doc_id"]: r["decoded"] for r in bpe.decoded(docs, PATH).collect()}
    assert found == {1: "�", 2: None, 3: ""}
