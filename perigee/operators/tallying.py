"""Pivots, suppress-when-ambiguous scalars, referential checks, paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.operators.ordering import check_page, page_of, publish_in_order
from perigee.runtime import fresh_path


def pivot_values(df: DataFrame, keys: list[str], name: str, value: str, columns: dict[str, str]) -> DataFrame:
    """Long to wide: one column per (output -> stored name), the largest value of each."""
    picks = [F.max(F.when(F.col(name) == stored, F.col(value))).alias(out) for out, stored in columns.items()]
    return df.groupBy(*keys).agg(*picks)


def only_if_single(count: str, value: Column) -> Column:
    """The value when exactly one identifier is linked, else NULL."""
    return F.when(F.col(count) == 1, value)


def keys_per_identifier(bridge: DataFrame, system: str, name: str, output: str) -> DataFrame:
    """Per identifier value: how many entities it maps to, and the smallest and largest key."""
    rows = bridge.filter((F.col("source_system") == system) & (F.col("identifier_name") == name))
    pairs = rows.groupBy(F.col("identifier_value").alias(output), "asteroid_key").agg(F.lit(1).alias("one"))
    return pairs.groupBy(output).agg(
        F.count("asteroid_key").alias("key_count"),
        F.min("asteroid_key").alias("first_key"),
        F.max("asteroid_key").alias("last_key"),
    )


def orphans(children: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent; NULL keys are not checked."""
    known = parents.select(F.col(parent_key or key).alias("__key")).distinct()
    checked = children.filter(F.col(key).isNotNull())
    return checked.join(known, checked[key] == known["__key"], "left_anti")


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def page(df: DataFrame, order: list[str], limit: int = 50, offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """One page in a total order, and a one-row frame with the total before slicing.

    `df` runs once: it is published in order, and the page reads the files it touches, at any offset. To
    turn several pages of one table, publish it and call `page_of`.
    """
    check_page(limit, offset)
    spark = df.sparkSession
    path = fresh_path(spark, "pages")
    publish_in_order(df, order, path)
    return page_of(spark, path, limit, offset)
