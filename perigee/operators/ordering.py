"""Tables published in a total order, and what their manifest answers.

Rows are dealt out by range and sorted inside each file, so the files, one after the other, are the whole
order. A manifest keeps a row per file: its first and last key, its rows, and how many rows come before
it. With it a reader knows every row's place without sorting, a page at any depth reads only the files it
touches, and the order can be proved on reading: inside a file row by row, between files by their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# In an order, a name that ends with this sorts from large to small. NULL comes last either way.
DOWN = " desc"


def key_names(order: list[str]) -> list[str]:
    return [name.removesuffix(DOWN) for name in order]


def sort_columns(order: list[str], prefix: str = "") -> list[Column]:
    """Sort expressions of an order; `prefix` names the struct that holds the keys."""
    return [
        F.col(f"{prefix}{name.removesuffix(DOWN)}").desc_nulls_last() if name.endswith(DOWN) else F.col(f"{prefix}{name}").asc_nulls_last()
        for name in order]


def manifest_path(path: str) -> str:
    """Where the manifest of the table at `path` lies: beside it, so that readers of the table don't meet it."""
    return f"{path.removesuffix('.parquet')}.files.parquet"


def _located(df: DataFrame) -> DataFrame:
    """A read of stored files with `__file` and `__at`, the row's place in its file."""
    return df.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at"))


def publish_in_order(df: DataFrame, order: list[str], path: str, mode: str = "overwrite", files: int | None = None) -> DataFrame:
    """Write `df` to `path` in `order`, and its manifest; returns the manifest as stored.

    The number of files follows the session's shuffle partitions and the size of the rows, or is `files`.

    The other columns don't break ties, so `order` should name each row; rows it doesn't tell apart share
    a file. The manifest is written last: a table without one isn't published. The window over the
    manifest has a row per file.
    """
    spark = df.sparkSession
    by = sort_columns(order)
    dealt = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    dealt.sortWithinPartitions(*by).write.mode(mode).option("compression", "snappy").parquet(path)
    rows = _located(spark.read.schema(df.schema).parquet(path))
    key = F.struct(*key_names(order))
    listed = rows.groupBy(F.col("__file").alias("name")).agg(
        F.min_by(key, "__at").alias("first_key"), F.max_by(key, "__at").alias("last_key"), F.count(F.lit(1)).alias("n_rows"))
    before = Window.orderBy(*sort_columns(order, "first_key."), "name").rowsBetween(Window.unboundedPreceding, -1)
    listed = listed.withColumn("n_before", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).cast("bigint"))
    listed.write.mode(mode).parquet(manifest_path(path))
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of the table at `path`: name, first_key, last_key, n_rows, n_before."""
    return spark.read.parquet(manifest_path(path))


def read_in_order(spark: SparkSession, path: str, place: str = "place") -> DataFrame:
    """The table at `path` with each row's `place` in the order, from 0; no sort and no shuffle of rows.

    The manifest is joined as its size allows, so only a table of very many files is shuffled.
    """
    rows = _located(spark.read.parquet(path))
    files = manifest(spark, path).select(F.col("name").alias("__file"), "n_before")
    return rows.join(files, "__file").select(*[c for c in rows.columns if not c.startswith("__")], (F.col("n_before") + F.col("__at")).alias(place))


def rows_between(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """Rows at places `start` to `stop` (end exclusive) in order; only files that hold some are read.

    The files' names come to the driver, at most one per row asked for.
    """
    files = manifest(spark, path)
    touched = files.filter((F.col("n_before") < stop) & (F.col("n_before") + F.col("n_rows") > start)).select("name", "n_before").collect()
    whole = spark.read.parquet(path)
    if not touched:
        return whole.limit(0)
    before = F.create_map(*[F.lit(x) for f in touched for x in (f["name"], f["n_before"])])
    found = _located(spark.read.schema(whole.schema).parquet(*[f"{path}/{f['name']}" for f in touched]))
    found = found.withColumn("__place", before[F.col("__file")] + F.col("__at")).filter(F.col("__place").between(start, stop - 1))
    return found.orderBy("__place").select(*whole.columns)


def check_page(limit: int, offset: int) -> None:
    if not 1 <= limit <= 500:
        raise ValueError("limit must lie in 1..500")
    if offset < 0:
        raise ValueError("offset must not be negative")


def page_of(spark: SparkSession, path: str, limit: int = 50, offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """One page of a published table, and a one-row frame with the total and the page's figures."""
    check_page(limit, offset)
    total = manifest(spark, path).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total")).select(
        "total", F.lit(limit).alias("limit"), F.lit(offset).alias("offset"),
        F.greatest(F.lit(0), F.least(F.lit(limit), F.col("total") - offset)).cast("bigint").alias("returned"),
    )
    return rows_between(spark, path, offset, offset + limit), total


def _precedes(left: str, right: str, order: list[str]) -> Column:
    """True where the keys in struct `left` come strictly before those in struct `right`."""
    out = F.lit(False)
    for name in reversed(order):
        a, b = F.col(f"{left}.{name.removesuffix(DOWN)}"), F.col(f"{right}.{name.removesuffix(DOWN)}")
        smaller = b < a if name.endswith(DOWN) else a < b
        out = F.when(a.eqNullSafe(b), out).when(a.isNull(), False).when(b.isNull(), True).otherwise(smaller)
    return out


def order_proof(spark: SparkSession, path: str, order: list[str]) -> DataFrame:
    """One row that proves the order: files, rows, rows that come before the one stored ahead of them, files
    that begin before the one ahead ends, and rows the manifest misses or counts too often.

    The windows run inside a file, and over the manifest.
    """
    inside = Window.partitionBy("__file").orderBy("__at")
    rows = _located(spark.read.parquet(path)).select("__file", "__at", F.struct(*key_names(order)).alias("key"))
    rows = rows.withColumn("ahead", F.lag("key").over(inside))
    within = rows.agg(F.count(F.lit(1)).alias("stored_rows"), F.count_if(F.col("ahead").isNotNull() & _precedes("key", "ahead", order)).alias("inversions"))
    sequence = Window.orderBy("n_before", "name")
    files = manifest(spark, path).withColumn("ahead", F.lag("last_key").over(sequence))
    between = files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("listed_rows"),
        F.count_if(F.col("ahead").isNotNull() & _precedes("first_key", "ahead", order)).alias("overlaps"))
    return within.crossJoin(F.broadcast(between)).select(
        "files", "stored_rows", "inversions", "overlaps", (F.col("stored_rows") - F.col("listed_rows")).alias("unlisted_rows"))
