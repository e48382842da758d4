"""Two-pass external shuffle into shards.

Pass one scatters the records uniformly into buckets that fit in memory, by a seeded hash of each
row's identity (Spark's shuffle is the external store). Pass two takes one bucket at a time, puts it
in a fixed order, permutes it with Fisher-Yates (`shuffle`) and writes it. The buckets in order are
one random sequence; shard s holds its positions from ceil(s*N/S) on, so row counts differ by one at
most. Both passes use DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perigee.llm.common import fresh_names, without
from perigee.runtime import fresh_path, materialize

SHARDS = 40
SEED = 20240
BUCKET_BYTES = 8 << 20
ROW_BYTES = 16
OFFSETS_PER_GROUP = 1024
# Beyond so many buckets a task gets a run of neighbouring ones, and permutes them one after the other.
MAX_TASKS = 50_000
# Offsets take 16 bytes a bucket; up to this many (16 MB) are broadcast, more are joined by shuffle.
BROADCAST_BUCKETS = 1 << 20
PLACES = ("size", "law", "shard", "slot", "grown_shard")


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (none for null) plus 16."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_BYTES


def bucket_offsets(counts: DataFrame) -> DataFrame:
    """(bucket, n) -> (bucket, offset): rows in smaller buckets, summed in two steps.

    No window holds more than `OFFSETS_PER_GROUP` buckets, or one row for each such group.
    """
    group = F.floor(F.col("bucket") / OFFSETS_PER_GROUP)
    grouped = counts.withColumn("part", group)
    parts = grouped.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = grouped.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0)))
    return inside.join(bases, "part").select("bucket", (F.col("base") + F.col("inside")).alias("offset"))


def shuffled(
    docs: DataFrame, identity: list[Column], shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, text: str = "text"
) -> DataFrame:
    """`docs` in random order: every column, `size`, `law` ('rows'), `shard`, `slot` and `grown_shard` (null).

    `identity` are expressions that tell rows apart and don't change when a task runs again, such as
    the file and position of a stored row; copies and null keys then scatter like any rows. Rows with
    equal identity share a bucket. Columns may be of any type; rows of equal identity are put in order by
    their text form where they hold maps or variants. Null texts have size 16. An empty table gives an
    empty one. Columns named like an added one are replaced, all others stay.
    """
    size, where, bucket, place, task = fresh_names(docs, "row_size", "row_hash", "row_bucket", "row_place", "row_task")
    identified = docs.withColumns({size: row_size(F.col(text)), where: F.xxhash64(F.lit(seed), *identity)})
    kept = [c for c in docs.columns if c.lower() not in PLACES]
    total = identified.agg(F.sum(size).alias("bytes"), F.count("*").alias("rows")).first()
    buckets = max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    identified = identified.withColumn(bucket, F.pmod(F.col(where), F.lit(buckets)))
    offsets = materialize(bucket_offsets(identified.groupBy(F.col(bucket).alias("bucket")).agg(F.count("*").alias("n"))), "offsets")
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    # A fixed order of the buckets in a task and of the rows in a bucket: a task that runs again permutes alike.
    # A task's number is that of its partition, so no two buckets meet by chance and each run of a job permutes alike.
    tasks = min(buckets, MAX_TASKS)
    dealt = identified.withColumn(task, F.expr(f"cast(`{bucket}` * {tasks}L div {buckets} as int)")).repartitionById(tasks, task).sortWithinPartitions(bucket)
    record = F.struct(*kept, F.col(size).alias("size"))
    unordered = any("map<" in kind or "variant" in kind for _, kind in docs.dtypes)
    tie = [record.cast("string").alias("tie")] if unordered else []
    listed = F.collect_list(F.struct(F.col(where).alias("where"), *tie, record.alias("record")))
    records = F.array_sort(listed, _by_place) if unordered else F.sort_array(listed)
    permuted = dealt.groupBy(task, F.col(bucket).alias("bucket")).agg(records.alias("records")).select("bucket", F.shuffle("records", seed).alias("records"))
    placed = permuted.join(offsets, "bucket").select("offset", "records")
    rows = placed.select("offset", F.posexplode("records").alias("at", "entry")).select("entry.record.*", (F.col("offset") + F.col("at")).alias(place))
    n = max(1, total["rows"])
    rows = rows.withColumns({"law": F.lit("rows"), "shard": F.expr(f"cast({place} * {shards} div {n} as int)"), "grown_shard": F.lit(None).cast("int")})
    return rows.withColumn("slot", F.expr(f"{place} - (shard * {n}L + {shards - 1}) div {shards}")).select(*kept, *PLACES)


def _by_place(a: Column, b: Column) -> Column:
    """Order of two entries by hash, then by text form."""
    left, right = F.struct(a["where"], a["tie"]), F.struct(b["where"], b["tie"])
    return F.when(left < right, -1).when(left > right, 1).otherwise(0)


def write_shards(docs: DataFrame, identity: list[Column], path: str | None = None, **options) -> str:
    """Write the shuffled records to `path`/shard=K/ and return the path; a reader sorts by `slot`."""
    path = path or fresh_path(docs.sparkSession, "shards")
    shuffled(docs, identity, **options).write.partitionBy("shard").parquet(path)
    return path


def report(docs: DataFrame, identity: list[Column]) -> DataFrame:
    """The digest columns of the registered query, from the written shards."""
    spark = docs.sparkSession
    schema = shuffled_schema(docs)
    stored = spark.read.schema(schema).parquet(write_shards(docs, identity))
    crc = F.coalesce(F.crc32(F.col("text")), F.lit(0)).cast("bigint")
    return stored.select("doc_id", "size", crc.alias("text_crc32"), "law", "shard", "slot", "grown_shard")


def shuffled_schema(docs: DataFrame):
    """Columns of written shards, also where there are no rows."""
    kept = without(docs, PLACES)
    added = {"size": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    return kept.limit(0).select("*", *[F.lit(None).cast(t).alias(k) for k, t in added.items()]).schema
