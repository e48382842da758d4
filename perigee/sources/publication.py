"""Publication of all datasets of a run together.

A run writes its data beside that of earlier runs, below `run=<id>/year=/month=/day=`, and nobody sees it.
Its commit is one small file that lists what was written; readers take from each day the data of the
newest committed run that holds it. So a reader meets all tables of a run or none, a run that stops half
way changes nothing, and publishing a few days again replaces those days only. Files are listed by Spark
(`binaryFile` reads no content for names and sizes), and lists of keys are tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.functions.dates import date_of, date_parts
from perigee.schemas import DATE_PARTS, table_columns, table_schema
from perigee.sources.files import exists
from perigee.sources.tables import CSV_FORMAT, check_contract, escape_lines, restore_lines

# Where each dataset is published, below a root; `{name}` is the table. Fixed values.
LAYOUT = {
    "approach_raw": "raw/approaches",
    "approach": "processed/approaches",
    "approach_csv": "processed_csv/approaches",
    "risk_raw": "raw/sentry/risk_snapshot",
    "risk": "processed/sentry/risk_snapshot",
    "catalog_raw": "raw/sbdb",
    "catalog": "processed/sbdb/{name}",
    "crosswalk": "reference/asteroid_crosswalk/{name}",
    "runs": "metadata/pipeline_runs",
}
DAY = ["year", "month", "day"]
COMMIT_DDL = "run string, committed_at string, place string, year string, month string, day string, key string, bytes bigint"
LISTED_DDL = "key string, bytes bigint"


def dataset_place(dataset: str, name: str | None = None) -> str:
    """The folder of a dataset below a root."""
    return LAYOUT[dataset].format(name=name) if name else LAYOUT[dataset]


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """(key, bytes) of every file with content below `root`, the key relative to it; nothing is opened."""
    if not exists(spark, root):
        return spark.createDataFrame([], LISTED_DDL)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    # The listing spells the root its own way, so a key starts behind the root's last folder names.
    marker = "/" + root.rstrip("/").split("://")[-1].lstrip("/") + "/"
    start = F.locate(marker, F.col("path"))
    return files.select(F.substring("path", start + len(marker), F.length("path")).alias("key"), F.col("length").alias("bytes"))


def with_folders(files: DataFrame) -> DataFrame:
    """(key, bytes, files) of every file and of every folder above one."""
    parts = F.split("key", "/")
    keys = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return files.select(F.explode(keys).alias("key"), "bytes").groupBy("key").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files"))


def stage(df: DataFrame, root: str, run: str, dataset: str, moment: Column, name: str | None = None) -> None:
    """Write a dataset of a run where no reader looks before the commit.

    `moment` gives each row's day. The form follows the dataset: raw payloads are JSON lines, the CSV
    copy has the five legacy columns, tables (`name`, or the dataset's own) keep their declared schema.
    A run that failed is published again under another id.
    """
    place = f"{root}/{dataset_place(dataset, name)}"
    # Only the date is shuffled; its parts and the run are written beside the rows afterwards.
    dated = df.withColumn("__day", date_of(moment))
    if dataset == "approach_csv":
        rows = escape_lines(dated.select(*table_columns("asteroids_csv"), "__day"))
    elif dataset.endswith("_raw"):
        rows = dated.select("payload", "__day")
    else:
        table = name or {"approach": "asteroids", "risk": "fact_sentry_risk_snapshot"}.get(dataset)
        rows = dated.select(*(check_contract(df, table).columns if table else df.columns), "__day")
    rows = rows.hint("rebalance", "__day").withColumns({**date_parts(F.col("__day")), "run": F.lit(run)}).drop("__day")
    writer = rows.write.mode("append").partitionBy("run", *DAY)
    if dataset == "approach_csv":
        writer.options(**CSV_FORMAT).csv(place)
    elif dataset.endswith("_raw"):
        writer.text(place)
    else:
        writer.option("compression", "snappy").parquet(place)


def commit(spark: SparkSession, root: str, run: str, committed_at: str) -> DataFrame:
    """Make all that a run has staged visible at once; returns what was listed.

    The listing is written as one file, which the file system moves into place in one step.
    """
    files = stored_files(spark, root).filter(F.locate(f"/run={run}/", F.concat(F.lit("/"), "key")) > 0)
    part = lambda name: F.regexp_extract("key", f"/{name}=([^/]+)/", 1).alias(name)
    listed = files.filter(~F.col("key").startswith("commits/")).select(
        F.lit(committed_at).alias("committed_at"), F.regexp_extract("key", "^(.*?)/run=", 1).alias("place"), *[part(c) for c in DAY], "key", "bytes", F.lit(run).alias("run"))
    listed.coalesce(1).write.mode("append").partitionBy("run").parquet(f"{root}/commits")
    return commits(spark, root).filter(F.col("run") == run)


def commits(spark: SparkSession, root: str) -> DataFrame:
    """What committed runs have published, a row per file."""
    schema = T.StructType.fromDDL(COMMIT_DDL)
    if not exists(spark, f"{root}/commits"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/commits").parquet(f"{root}/commits").select(*schema.names)


def visible_days(spark: SparkSession, root: str, place: str) -> DataFrame:
    """(run, year, month, day): for each day of a dataset the newest committed run that holds it."""
    rows = commits(spark, root).filter(F.col("place") == place)
    return rows.groupBy(*DAY).agg(F.max(F.struct("committed_at", "run")).alias("newest")).select(F.col("newest.run").alias("run"), *DAY)


def latest_run(spark: SparkSession, root: str, place: str) -> DataFrame:
    """(run, year, month, day) of the newest committed run of a dataset alone."""
    rows = commits(spark, root).filter(F.col("place") == place)
    newest = rows.agg(F.max(F.struct("committed_at", "run")).alias("newest")).select(F.col("newest.run").alias("run"))
    return rows.select("run", *DAY).distinct().join(newest, "run", "left_semi")


def read_published(spark: SparkSession, root: str, dataset: str, name: str | None = None, latest: bool = False) -> DataFrame:
    """A published dataset with its days as text columns, as the commits show it (`latest`: of the newest run only).

    The join is on partition columns alone, so the files of other runs and days are not read.
    """
    place = dataset_place(dataset, name)
    path = f"{root}/{place}"
    table = name or {"approach": "asteroids", "risk": "fact_sentry_risk_snapshot", "approach_csv": "asteroids_csv"}.get(dataset)
    own = T.StructType.fromDDL("value string") if table is None else table_schema(table)
    schema = T.StructType([*own.fields, T.StructField("run", T.StringType()), *T.StructType.fromDDL(DATE_PARTS).fields])
    if not exists(spark, path):
        return spark.createDataFrame([], schema).drop("run")
    reader = spark.read.schema(schema).option("basePath", path)
    rows = reader.options(**CSV_FORMAT).csv(path) if dataset == "approach_csv" else reader.text(path) if table is None else reader.parquet(path)
    if dataset == "approach_csv":
        rows = restore_lines(rows)
    shown = latest_run(spark, root, place) if latest else visible_days(spark, root, place)
    return rows.join(shown, ["run", *DAY], "left_semi").drop("run").select(*own.names, *DAY)


def publication_gaps(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """(key, bytes) of the expected keys (column `key`: files or folders) that hold nothing; `bytes` is 0.

    Expected keys are a table of any size and meet the listing in a join.
    """
    there = with_folders(stored_files(spark, root)).filter("bytes > 0")
    return keys.select("key").distinct().join(there, "key", "left_anti").withColumn("bytes", F.lit(0).cast("bigint"))


def changed_files(spark: SparkSession, root: str) -> DataFrame:
    """(run, key, listed, stored): committed files that are gone (`stored` is NULL) or have another size."""
    there = stored_files(spark, root).select("key", F.col("bytes").alias("stored"))
    rows = commits(spark, root).select("run", "key", F.col("bytes").alias("listed"))
    return rows.join(there, "key", "left").filter(~F.col("listed").eqNullSafe(F.col("stored"))).select("run", "key", "listed", "stored")
