"""Line dedup against its SQL and against a plain count."""

import corpus_pipeline
import plain
import pytest
from compare import connect, differences
from perigee.llm import line_spread, queries


def test_sql(spark):
    found = queries.op10_line_dedup(spark, plain.SF)
    assert differences(found, queries.SQL["op10_line_dedup"], connect(plain.SF)) == []


def check(docs, **options):
    data = [(r["doc_id"], r["text"], r["source"]) for r in docs.select("doc_id", "text", "source").collect()]
    gone = plain.spread_removed([(t, s) for _, t, s in data], **options)
    want = []
    for (doc_id, text, _), removed in zip(data, gone):
        lines = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in set(removed))
        want.append((doc_id, lines, tuple(removed), 0 if text is None else text.count("\n") + 1))
    found = line_spread.without_boilerplate(docs, **options)
    assert plain.Counter((r["doc_id"], r["text"], tuple(r["removed_lines"]), r["n_lines"]) for r in found.collect()) == plain.Counter(want)
    assert [c for c in found.columns if c not in line_spread.ADDED] == [c for c in docs.columns if c not in line_spread.ADDED]
    return gone


@pytest.mark.parametrize("texts", [1, 10])
def test_lines_near_the_threshold(spark, texts):
    common, rows = "  This line stands on many sites of the web \t", []
    for n in (3, 8, 9, 10, 11, 14, 15, 16, 40):
        for site in range(n):
            body = f"own words of {n} and {site} that are here only and make the text long\n{common}{n}"
            rows.append((len(rows), body if site % 3 else f"{common.upper()}{n}\n\n{body}", "en", f"s{site}", 1))
            rows.append((len(rows), f"{common}{n}", "en", "s0", 1))
    rows += [(len(rows), f"{common}40\n" * 300 + "rest", "en", "s1", 1), (len(rows), "rest\n" * 900 + f"{common}40", "en", None, 1)] * 2
    gone = check(spark.createDataFrame(rows, plain.SCHEMA), min_texts=texts)
    assert any(gone)


def test_awkward_rows(spark):
    check(plain.awkward(spark, "n_lines line at site row_1 row_2 split_text line_1 text_1 __1 __lines"), min_sites=1, min_texts=1)
    check(plain.awkward(spark, "row_1 text_1 split_text"), min_sites=1, min_texts=2)
    check(plain.awkward(spark), min_sites=1, min_chars=0)


def test_empty(spark):
    assert line_spread.report(plain.empty(spark)).collect() == []


def test_short_texts_lose_frames_and_copies_stay(spark):
    frame, copied = "This frame stands on many sites of the web", "This text is only copied, from one site to the next"
    rows = [(site, f"own words {site}\n{frame}", "en", f"s{site}", 1) for site in range(12)]
    rows += [(20 + site, f"{copied}\nshort", "en", f"s{site}", 1) for site in range(12)]
    rows += [(60 + site, frame, "en", f"s{site}", 1) for site in range(2)]
    rows += [(40, f"{copied}\n{frame}", "en", "s1", 1), (41, "long own words " * 20 + f"\n{copied}", "en", None, 1)]
    docs = spark.createDataFrame(rows, plain.SCHEMA).repartition(3)
    found = {r["doc_id"]: r["text"] for r in line_spread.without_boilerplate(docs, min_texts=10).collect()}
    assert [found[site] for site in range(12)] == [f"own words {site}" for site in range(12)]
    assert all(found[20 + site] == f"{copied}\nshort" for site in range(12))
    assert found[60] == found[61] == ""
    assert found[40] == copied and found[41] == "long own words " * 20 + f"\n{copied}"
    through = corpus_pipeline.line_dedup(spark, docs, plain.SF).collect()
    assert {r["doc_id"]: r["text"] for r in through} == found
