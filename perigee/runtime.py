"""Session defaults, lineage cuts in shared storage, and joins that survive hot keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings every plan here is written for. AQE decides broadcast versus shuffle from the
# measured size of each side and splits skewed shuffle partitions.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task that reads a shuffled part sorts and groups it several times over, so parts stay small.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Sides that are dealt out by some of a join's keys are joined as they are, not shuffled by all keys again.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # HotSpot compiles no method above 8000 bytes; the judging of a record in one generated method would run uncompiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Static settings for sessions made here. Recording the Python call site of every expression costs
# more than planning these queries.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

_SCRATCH: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def build_session(app_name: str = "perigee", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the defaults above; `settings` use underscores for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **STATIC_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local session, as in tests, may leave it unset; it then gets a private folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = tempfile.mkdtemp(prefix="perigee-")
    return _SCRATCH[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; `clear_scratch` knows it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this application has written to its fresh paths, and return how many there were.

    For the end of a job: frames that read intermediate tables can't be used afterwards.
    """
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    return len(paths)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts lineage so a lost executor re-reads files, and gives Catalyst the real size: a join
    against the result is broadcast only while that size is under the broadcast threshold.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A plain projection is copied into every filter and expression above it, so a parsed document
    would be parsed once per field. The value of a generator cannot be copied.
    """
    return df.select(*df.columns, F.inline(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))))


def one_row(df: DataFrame) -> DataFrame:
    """Mark a global aggregate (exactly one row by construction) for broadcast."""
    return F.broadcast(df)


def scattered(key: Column, *spread: str | Column) -> Column:
    """A join key whose NULLs are spread over many values that match nothing."""
    tail = F.pmod(F.xxhash64(*spread), F.lit(4096)).cast("string")
    return F.coalesce(key, F.concat(F.lit("\u0000"), tail))


def attach(
    left: DataFrame,
    right: DataFrame,
    key: str,
    right_key: str | None = None,
    spread: list[str] | None = None,
    when: Column | None = None,
    also: list[tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Left join `right` (one row per `right_key`) onto `left`, and the tables of `also` by the same key.

    Rows of `left` with a NULL key, or for which `when` does not hold, match nothing; their join
    key is scattered so they never meet in a single task.
    """
    right_key = right_key or key
    value = F.col(key).cast("string")
    if when is not None:
        value = F.when(when, value)
    probe = left.withColumn("__probe", scattered(value, *(spread or left.columns[:1])))
    for table, table_key in [(right, right_key), *(also or [])]:
        build = table.filter(F.col(table_key).isNotNull()).withColumn("__build", F.col(table_key).cast("string"))
        clash = [c for c in table.columns if c in probe.columns]
        build = build.drop(*clash) if clash else build
        probe = probe.join(build, F.col("__probe") == F.col("__build"), "left").drop("__build")
    return probe.drop("__probe")
