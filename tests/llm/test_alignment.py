"""Alignment of two tokenizers against a walk over both token lists."""

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perigee.llm import alignment
from perigee.llm.pretrained import byte_letters

DATA = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def plain(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per text, by walking over the tokens."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: byte for byte, c in byte_letters().items()}
    words = {i: bytes(back[c] for c in w) for w, i in a.get_vocab().items() if not w.startswith("<|")}
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    found, counts = [], Counter()
    for text in texts:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        spelled = [words[i] for i in ids[0]], [piece(i) for i in ids[1]]
        if not text or any(b"".join(s) != (" " + text).encode() for s in spelled):
            found.append(None)
            continue
        owner = [[i for i, s in zip(own, side) for _ in s] for own, side in zip([range(len(s)) for s in spelled], spelled)]
        links = sorted(set(zip(*owner)))
        ends = [{sum(map(len, side[: i + 1])) for i in range(len(side))} for side in spelled] if len(text) < 3000 else [_ends(s) for s in spelled]
        shared = sorted(ends[0] & ends[1])
        groups, start = [], 0
        for end in shared:
            groups.append("|".join(",".join(str(own[k]) for k in sorted(set(at[start:end]))) for own, at in zip(ids, owner)))
            start = end
        pairs = [(ids[0][i], ids[1][j]) for i, j in links]
        counts.update(pairs)
        found.append((len(ids[0]), len(ids[1]), len(groups), pairs, ";".join(groups)))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (*f[:3], len(f[3]), sum(counts[p] == best[p[1]] for p in f[3]), sum(counts[p] for p in f[3]), f[4]) for f in found]


def _ends(side):
    out, total = set(), 0
    for s in side:
        total += len(s)
        out.add(total)
    return out


def as_tuple(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups


TEXTS = [
    None, "", " ", "a", "plain words, and 12345 numbers", "plain words, and 12345 numbers", "it's  <|endoftext|> <s> here", "日本語 🙂 é́ x",
    "a ▁ stands for itself", "tab\tand\nlines  \n\n  end ", "x" * 300, "\x00zero", "  leading",
]


def test_equals_the_walk(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    found, counts = alignment.aligned(docs, A, B)
    got = {r.doc_id: as_tuple(r) for r in found.collect()}
    assert [got[i] for i in range(len(TEXTS))] == plain(TEXTS)
    assert counts.agg(F.sum("n_links")).first()[0] == sum(p[3] for p in plain(TEXTS))


def test_windows_change_nothing(spark):
    texts = [*TEXTS, "many words in a row " * 40, "one ▁ late " + "more words follow " * 30, "word " * 10 + "x" * 500 + " tail here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found, _ = alignment.aligned(docs, A, B, size=16)
    got = {r.doc_id: as_tuple(r) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts)
    digests, _ = alignment.aligned(docs, A, B, groups="groups_sha256", size=16)
    shas = {r.doc_id: r.groups_sha256 for r in digests.collect()}
    assert [shas[i] for i in range(len(texts))] == [hashlib.sha256(p[6].encode()).hexdigest() if p[0] else "" for p in plain(texts)]


def test_other_columns_and_empty_tables(spark):
    names = ["block", "Pairs", "numbers", "n_a", "groups", "pair", "doc"]
    docs = spark.createDataFrame([(None, "some words", {"k": 1}), (1, None, None)], "doc_id long, text string, m map<string,int>").select("*", *[F.lit("own").alias(n) for n in names])
    found, _ = alignment.aligned(docs, A, B)
    rows = found.collect()
    assert all((r.block, r.Pairs, r.numbers, r.pair, r.doc) == ("own",) * 5 for r in rows)
    assert sorted((r.n_a, r.groups) for r in rows) == [(0, ""), plain(["some words"])[0][::6]]
    found, counts = alignment.aligned(docs.limit(0), A, B)
    assert found.count() == counts.count() == 0


def test_report_over_the_table(spark, sf_dir=DATA):
    from perigee.llm.queries import op11_token_alignment

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = dict(zip([r.doc_id for r in rows], plain([r.text for r in rows])))
    got = op11_token_alignment(spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        *numbers, groups = expected[r.doc_id]
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256] == [*numbers, sha]
