"""Writers: declared schemas, date partitions, insert-if-absent loads, redacted raw files, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions.dates import date_parts
from perigee.functions.text import redact_api_key
from perigee.operators.picking import insert_if_absent
from perigee.operators.ordering import publish_in_order
from perigee.operators.resolution import BRIDGE_ORDER, IDENTIFIER, Crosswalk, audit_of, bridge_of
from perigee.runtime import materialize
from perigee.schemas import table_columns
from perigee.sources.files import exists
from perigee.sources.tables import CSV_FORMAT, check_contract, escape_lines, read_table

def write_table(df: DataFrame, name: str, path: str, mode: str = "overwrite") -> None:
    """Declared columns only, Snappy Parquet."""
    check_contract(df, name).write.mode(mode).option("compression", "snappy").parquet(path)


def with_lineage(df: DataFrame, run_id: str, ingested_at: str, source: str) -> DataFrame:
    return df.withColumns({"run_id": F.lit(run_id), "ingested_at": F.lit(ingested_at), "source": F.lit(source)})


RUN_TABLE_DDL = "table_name string, run_id string, ingested_at string, source string, source_raw_file string, source_raw_sha256 string"


def write_table_with_lineage(
    df: DataFrame, name: str, path: str, run_id: str, ingested_at: str, source: str, raw_file: str | None = None, raw_sha256: str | None = None,
) -> None:
    """The table plus a one-row run table next to it, which the lineage check and the served headers read back."""
    write_table(df, name, path)
    runs = df.sparkSession.createDataFrame([(name, run_id, ingested_at, source, raw_file, raw_sha256)], RUN_TABLE_DDL)
    runs.write.mode("overwrite").parquet(f"{path}_runs")


def dataset_lineage(runs: DataFrame) -> DataFrame:
    """One row with the struct `neows`: the newest run of the approach dataset and the raw file it was read from."""
    row = F.struct("ingested_at", "run_id", "source_raw_file", "source_raw_sha256")
    newest = runs.filter(F.col("table_name") == "asteroids").agg(F.max(row).alias("r"))
    return newest.select(F.struct(
        F.col("r.run_id").alias("dataset_run_id"), F.col("r.source_raw_file").alias("source_raw_file"),
        F.col("r.source_raw_sha256").alias("source_raw_sha256")).alias("neows"))


def write_csv(df: DataFrame, path: str) -> None:
    """The five legacy columns; anything else is left out."""
    escape_lines(df.select(*table_columns("asteroids_csv"))).write.mode("overwrite").options(**CSV_FORMAT).csv(path)


def publish(df: DataFrame, root: str, moment: Column) -> None:
    """Write below year=/month=/day=, replacing only the days present.

    The rebalance hint lets AQE split a day that is too big for one task and merge days that are
    too small, so a hot day becomes several files instead of one long task.
    """
    parted = df.withColumns(date_parts(moment)).hint("rebalance", "year", "month", "day")
    (parted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .partitionBy("year", "month", "day").parquet(root))


def redact_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Raw documents with the api_key of every link hidden."""
    return payloads.withColumn(column, redact_api_key(F.col(column)))


# One task reads a packed file, as it can't be split, so a file holds at most so many documents. At its fastest level
# gzip costs hardly more than writing the plain text.
PACKED_DOCUMENTS = 5_000
PACKING = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_raw(payloads: DataFrame, path: str, packed: bool = False) -> None:
    """The redacted documents, one per line; `packed` as gzip, several files per task where there are many documents.

    Whoever reads lines gets the same text of packed files. `payload_files` takes the bytes of whole files and needs plain ones.
    """
    lines = redact_payloads(payloads).select("payload").write.mode("overwrite")
    if packed:
        lines = lines.options(**PACKING, maxRecordsPerFile=PACKED_DOCUMENTS)
    lines.text(path)


def parent_rows(accepted: DataFrame, order: list[str]) -> DataFrame:
    return accepted.select(F.col("id").alias("asteroid_id"), "name", "hazardous", *order)


def child_rows(accepted: DataFrame, order: list[str]) -> DataFrame:
    return accepted.select(F.col("id").alias("asteroid_id"), F.col("closest_approach_date").alias("approach_date"),
                           "miss_distance_km", *order)


def load_relational(spark: SparkSession, accepted: DataFrame, folder: str, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Append the unseen objects and the unseen (object, date) approaches; returns what was added.

    Of several copies the first by `order` stays (columns of `accepted` that give a row's place, not
    among the loaded ones), then the smallest. The surrogate id is a 128-bit digest of the natural key,
    so a repeated load gives the same ids.
    """
    order = order or []
    parents_path, children_path = f"{folder}/asteroids", f"{folder}/close_approaches"
    parents = read_table(spark, parents_path, "relational_asteroids")
    children = read_table(spark, children_path, "relational_close_approaches")
    new_parents = insert_if_absent(parents, parent_rows(accepted, order), ["asteroid_id"], order)
    unseen = insert_if_absent(children, child_rows(accepted, order), ["asteroid_id", "approach_date"], order, between="approach_date")
    natural = F.to_json(F.struct("asteroid_id", "approach_date"))
    new_children = unseen.select(F.md5(natural).alias("approach_id"), "asteroid_id", "approach_date", "miss_distance_km")
    # Fixed before the append, so the read of the target cannot see its own output.
    new_parents, new_children = materialize(new_parents, "new-parents"), materialize(new_children, "new-children")
    new_parents.write.mode("append").parquet(parents_path)
    new_children.write.mode("append").parquet(children_path)
    return new_parents, new_children


def save_crosswalk(crosswalk: Crosswalk, folder: str) -> tuple[str, str]:
    """Bridge and audit side by side, each published in its fixed order with a manifest, and the candidates
    of ambiguous identifiers.

    The collapsed identifiers are computed once for both.
    """
    fixed = materialize(crosswalk.identifiers, "identifiers")
    bridge_path, audit_path = f"{folder}/bridge_asteroid_identifier.parquet", f"{folder}/fact_entity_resolution.parquet"
    publish_in_order(check_contract(bridge_of(fixed), "bridge_asteroid_identifier"), BRIDGE_ORDER, bridge_path)
    publish_in_order(check_contract(audit_of(fixed), "fact_entity_resolution"), IDENTIFIER, audit_path)
    crosswalk.candidates.write.mode("overwrite").parquet(f"{folder}/alias_candidates.parquet")
    crosswalk.links.write.mode("overwrite").parquet(f"{folder}/candidate_links.parquet")
    return bridge_path, audit_path


def write_report(rows: DataFrame, path: str) -> None:
    """Check rows or a run summary as JSON lines. These are a few rows by nature, so one file."""
    rows.coalesce(1).write.mode("overwrite").json(path)


def published(spark: SparkSession, root: str) -> bool:
    return exists(spark, root)
