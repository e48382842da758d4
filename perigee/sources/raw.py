"""Raw payload files: nested JSON kept for replay, read as text leaves so that types can be judged.

A payload is one document; at scale there are many files, and each is split into records at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.runtime import pinned

# Records stay JSON text: arrays and maps keep the order of the file.
APPROACH_PAYLOAD = "near_earth_objects map<string, array<string>>"
RISK_PAYLOAD = "data array<string>"


def payload_files(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, payload, source_sha256): whole files with the digest of their bytes."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("path").alias("source_file"),
        F.decode("content", "UTF-8").alias("payload"),
        F.sha2(F.col("content"), 256).alias("source_sha256"),
    )


CORRUPT = {"columnNameOfCorruptRecord": "corrupt"}


def _entries(payloads: DataFrame, payload: str, schema: str, exploded: Column, *names: str) -> DataFrame:
    """One row per record, and one for each payload without any, which says why in `defect`.

    `exploded` gives the record as `names`, the first of which is NULL for a payload without records alone.

    A payload is parsed once. Only one that is marked as broken and gives no record is looked at again,
    to tell an unreadable text from a document of another shape.
    """
    kept = [c for c in payloads.columns if c != payload]
    parsed = pinned(payloads, parsed=F.from_json(payload, f"{schema}, corrupt string", CORRUPT))
    rows = parsed.select(*kept, payload, F.col("parsed.corrupt").alias("corrupt_text"), exploded.alias(*names))
    # A comparison in two steps: the parse of the second is reached for silent broken payloads alone.
    broken = F.col(payload).isNull() | F.when(F.col("corrupt_text").isNotNull(), F.try_parse_json(F.col(payload)).isNull()).otherwise(False)
    defect = F.when(F.col(names[0]).isNull(), F.when(broken, "unreadable").otherwise("empty"))
    return rows.select(*kept, defect.alias("defect"), *names)


def approach_entries(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Close-approach records with their place in the file (date entry, list position), and silent payloads."""
    listed = F.flatten(F.transform(
        F.filter(F.map_entries("parsed.near_earth_objects"), lambda e: e["value"].isNotNull()),
        lambda e, i: F.transform(e["value"], lambda r, j: F.struct(
            i.alias("entry_pos"), e["key"].alias("entry_date"), j.alias("record_pos"), r.alias("record_json")))))
    rows = _entries(payloads, payload, APPROACH_PAYLOAD, F.explode_outer(listed), "record")
    return rows.select(*[c for c in rows.columns if c != "record"], "record.entry_pos", "record.entry_date", "record.record_pos", "record.record_json")


def risk_entries(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Risk records with their place in the list, and silent payloads."""
    return _entries(payloads, payload, RISK_PAYLOAD, F.posexplode_outer("parsed.data"), "record_pos", "record_json")


def approach_records(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per close-approach record, with its place in the file."""
    return approach_entries(payloads, payload).filter("defect IS NULL").drop("defect")


def risk_records(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per risk record, with its place in the list."""
    return risk_entries(payloads, payload).filter("defect IS NULL").drop("defect")


def read_summary(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A run summary as one row, with `readable` false when the file is missing or not one JSON object."""
    from perigee.sources.files import exists

    if not exists(spark, path):
        return spark.createDataFrame([(False,)], "readable boolean").select(
            "readable", F.from_json(F.lit(None).cast("string"), schema).alias("s")).select("readable", "s.*")
    text = payload_files(spark, path).select("payload")
    parsed = text.select(
        F.schema_of_variant(F.try_parse_json("payload")).startswith("OBJECT").alias("ok"), F.from_json("payload", schema).alias("s"))
    return parsed.select(F.coalesce("ok", F.lit(False)).alias("readable"), "s.*")
