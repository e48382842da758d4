"""Line dedup by distinct-site spread: lines that stand on many sites are boilerplate.

Lines are compared trimmed and in lower case. One HyperLogLog sketch of sites per line hash is built
map-side and merged by aggregation, so a line on every page costs one row per task. Lines whose
estimate is near the threshold, on either side, get an exact distinct count; only then are the
boilerplate lines removed from every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import digests, fresh_names, without
from perigee.runtime import materialize, pinned

MIN_SITES = 10
MIN_CHARS = 20
# An estimate within this share of the threshold is counted exactly. A sketch of 2^10 registers errs by
# 3 % (one standard deviation), so the band is 16 deviations wide on either side.
NEAR = 0.5
LOG_REGISTERS = 10
BLANKS = " \t\n\x0b\x0c\r\xa0"
ADDED = ("n_lines", "n_removed", "removed_lines")


def normal(line: Column) -> Column:
    """A line as it is compared; blanks at its ends and letter case don't count."""
    return F.lower(F.btrim(line, F.lit(BLANKS)))


def eligible(line: Column, min_chars: int) -> Column:
    return F.length(line) >= min_chars


def _lines(docs: DataFrame, text: str, min_chars: int, *keep: Column) -> DataFrame:
    """One row (keep..., at, line_1, line_2) per line of `min_chars` or more; null and empty texts have none."""
    # Normalized inside the array: a projection of the exploded line would be computed again by the filter.
    normalized = F.transform(F.split(F.col(text), "\n"), normal)
    parts = docs.filter(F.length(text) >= min_chars).select(*keep, F.posexplode(normalized).alias("at", "line"))
    ids = digests(F.col("line"))
    return parts.filter(eligible(F.col("line"), min_chars)).select(*[c for c in parts.columns if c != "line"], ids[0].alias("line_1"), ids[1].alias("line_2"))


def widespread(docs: DataFrame, site: str = "source", text: str = "text", min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Hashes (line_1, line_2) of the lines that stand on at least `min_sites` distinct non-null sites."""
    lines = _lines(docs.filter(F.col(site).isNotNull()), text, min_chars, F.col(site).cast("string").alias("site")).drop("at")
    keys = ["line_1", "line_2"]
    sketches = lines.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_REGISTERS)).alias("sites"))
    # A line far below the threshold is settled here; few lines are left.
    spread = materialize(sketches.filter(F.col("sites") >= min_sites * (1 - NEAR)), "spread")
    near = spread.filter(F.col("sites") <= min_sites * (1 + NEAR)).select(*keys)
    exact = lines.join(near, keys, "left_semi").distinct().groupBy(*keys).count().filter(F.col("count") >= min_sites)
    sure = spread.filter(F.col("sites") > min_sites * (1 + NEAR)).select(*keys)
    return materialize(sure.unionByName(exact.select(*keys)), "boilerplate")


def without_boilerplate(
    docs: DataFrame, key: str = "doc_id", site: str = "source", text: str = "text",
    min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, min_texts: int = 1,
) -> DataFrame:
    """`docs` with boilerplate lines taken out of the text, and `n_lines`, `n_removed`, `removed_lines`.

    Boilerplate are lines on `min_sites` distinct non-null sites or more that stand in at least `min_texts`
    distinct texts with a site; with more than one, a text that was only copied from site to site keeps
    its lines. All boilerplate goes, whatever its share: a text of nothing else becomes empty. The other
    lines keep their order and bytes. Null texts stay null with no lines; an empty text has one empty
    line. Rows with a null site lose lines but don't count as a site. Repeated rows stay; an empty table
    gives an empty one. Very long texts are split in the JVM, one text at a time. `removed_lines` are
    positions from 0, ascending. Columns named like an added one are replaced, all others stay.
    """
    shared = widespread(docs, site, text, min_sites, min_chars)
    kept = without(docs, ADDED)
    ids = digests(F.col(key), F.col(text))
    keys, same = ["line_1", "line_2"], digests(F.col(text))
    found_in = [F.when(F.col(site).isNotNull(), c).alias(f"text_{i}") for i, c in enumerate(same, 1)] if min_texts > 1 else []
    hits = _lines(kept, text, min_chars, ids[0].alias("row_1"), ids[1].alias("row_2"), *found_in).join(shared, keys, "left_semi")
    if min_texts > 1:
        hits = materialize(hits, "occurrences")
        texts = hits.filter(F.col("text_1").isNotNull()).select(*keys, "text_1", "text_2").distinct()
        framing = texts.groupBy(*keys).count().filter(F.col("count") >= min_texts)
        hits = hits.join(materialize(framing.select(*keys), "framing"), keys, "left_semi")
    hits = materialize(hits.groupBy("row_1", "row_2").agg(F.array_sort(F.collect_set("at")).alias("removed_lines")), "removals")
    row_1, row_2, split = fresh_names(docs, "row_1", "row_2", "split_text")
    hits = hits.withColumnsRenamed({"row_1": row_1, "row_2": row_2})
    found = kept.withColumns({row_1: ids[0], row_2: ids[1]}).join(hits, [row_1, row_2], "left")
    # The lines are split once per row; every use below refers to the column.
    found = pinned(found, **{split: F.split(F.col(text), "\n")})
    lines_of, n_lines = F.col(split), F.size(split)
    gone = F.coalesce("removed_lines", F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), n_lines - 1), gone)
    rest = F.array_join(F.transform(left, lambda at: lines_of[at]), "\n")
    found = found.withColumns({
        text: F.when(F.col("removed_lines").isNull(), F.col(text)).otherwise(rest),
        "n_lines": F.coalesce(n_lines, F.lit(0)).cast("bigint"),
        "n_removed": F.size(gone).cast("bigint"), "removed_lines": gone,
    })
    return found.select(*kept.columns, *ADDED)


def report(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    cleaned = without_boilerplate(docs)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed"), F.sha2(F.col("text"), 256).alias("text_sha256"))


REPORT_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place, unnest(string_split(text, chr(10))) AS raw FROM documents
), normal AS (
  SELECT *, lower(trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))) AS line FROM lines
), wide AS (
  SELECT line FROM normal WHERE length(line) >= {MIN_CHARS} GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), marked AS (
  SELECT n.*, w.line IS NOT NULL AS common FROM normal n LEFT JOIN wide w ON n.line = w.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE common) AS n_removed,
  coalesce(string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) FILTER (WHERE common), '') AS removed,
  sha256(coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (WHERE NOT common), '')) AS text_sha256
FROM marked GROUP BY doc_id
"""
