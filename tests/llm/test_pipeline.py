"""The pipeline against its stages done plainly, one after the other."""

import corpus_pipeline
import numpy as np
import plain
import public_tokenizers
from perigee.llm import quality
from test_quality import counted
from tokenizers import Tokenizer


def content_share(text, chain):
    """Viterbi in plain form: best score of each prefix and state."""
    counts, rows = quality.document_features(text)
    unary = np.array(rows) @ np.array(chain.weights)
    best, back = np.array([0.0, unary[0]]), []
    for u in unary[1:]:
        both = best[:, None] + np.array(chain.moves)
        back.append([int(both[1, s] > both[0, s]) for s in (0, 1)])
        best = np.array([both[back[-1][0], 0], both[back[-1][1], 1] + u])
    labels = [int(best[1] > best[0])]
    for step in reversed(back):
        labels.append(step[labels[-1]])
    labels.reverse()
    return sum(c for c, y in zip(counts, labels) if not y) / max(1, sum(counts))


def test_run(spark):
    docs = spark.read.parquet(f"{plain.SF}/documents.parquet")
    labels = spark.read.parquet(f"{plain.SF}/labels.parquet")
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{plain.SF}/benchmark.parquet").collect()}
    chain = quality.fit(docs, labels)
    rows = [r.asDict() for r in docs.collect()]
    rows = [r for r in rows if r["text"] and not counted(r["text"])[-1] and content_share(r["text"], chain) >= 0.5]
    for r, gone in zip(rows, plain.spread_removed([(r["text"], r["source"]) for r in rows], min_texts=10)):
        r["text"] = "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in gone)
    prints = [plain.fingerprint(r["text"]) for r in rows]
    first = {}
    for r, root in zip(rows, plain.groups(prints)):
        if root not in first or r["doc_id"] < first[root]["doc_id"]:
            first[root] = r
    rows = [r for r in first.values() if not plain.contained(r["text"], items)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: (r["text"], tokenizer.encode(r["text"], add_special_tokens=False).ids) for r in rows}
    found = corpus_pipeline.run(spark, plain.SF)
    assert {r["doc_id"]: (r["text"], r["ids"]) for r in found.collect()} == want
    assert found.columns == [*corpus_pipeline.COLUMNS, "ids"] and found.count() == len(want) > 0


def test_stages_bear_awkward_and_empty_tables(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{plain.SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    for source in (plain.awkward(spark, "kept ids leaks simhash"), plain.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, source, str(tmp_path))
            assert found.columns == [*corpus_pipeline.COLUMNS, *(["ids"] if name == "encoding" else [])]
            assert found.count() <= source.count()


def test_stages_carry_further_columns(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{plain.SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    more = ["concat('u', doc_id) AS url", "doc_id AS n_lines", "map('k', doc_id) AS tags"]
    docs = spark.read.parquet(f"{plain.SF}/documents.parquet").limit(60).selectExpr("*", *more).union(
        plain.awkward(spark).selectExpr("*", *more))
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, str(tmp_path))
        assert found.columns == [*docs.columns, *(["ids"] if name == "encoding" else [])]
        rows = found.selectExpr("doc_id", "url", "n_lines", "tags['k'] AS tag").collect()
        assert rows and all((r["url"], r["n_lines"], r["tag"]) == (None if r["doc_id"] is None else f"u{r['doc_id']}", r["doc_id"], r["doc_id"]) for r in rows)
