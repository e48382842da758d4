"""Shared helpers: Arrow columns computed in tasks, rows' identity, scratch tables, held-out rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words are maximal runs without the six ASCII blanks; the same set that bytes.split() uses.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

ARROW_TYPES = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
    "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()),
}
# A task works on this many rows, or this much text, at once.
PIECE_ROWS = 512
PIECE_BYTES = 4 << 20
# Spark's Arrow batches are counted in rows; few, as a single text may be long.
BATCH_SETTING = ("spark.sql.execution.arrow.maxRecordsPerBatch", str(PIECE_ROWS))


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded amount of text; a longer single text is a slice of its own."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (total + size > PIECE_BYTES or i - start >= PIECE_ROWS):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def without(docs: DataFrame, names) -> DataFrame:
    """`docs` without columns that an operator is about to add: the operator's columns win."""
    return docs.drop(*names)


def fresh_names(docs: DataFrame, *names: str) -> list[str]:
    """Column names like `names` that no column of `docs` has, also apart from letter case."""
    taken, found = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        found.append(name)
    return found


def computed(
    docs: DataFrame, fields: dict[str, str], start: Callable[[], Callable[[list[str | None]], list[list]]], text: str = "text"
) -> DataFrame:
    """Add `fields` (name -> Spark type), computed from the text column in Arrow batches.

    `start` runs once in each task and returns a function from a list of texts to one list of values
    per field. All other columns pass through; columns of `docs` named like a field are replaced. The
    number of rows in the session's Arrow batches is set to `PIECE_ROWS`.
    """
    docs.sparkSession.conf.set(*BATCH_SETTING)
    kept = without(docs, fields)
    schema = T.StructType(kept.schema.fields + T.StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in fields.items())).fields)
    names, kinds = schema.names, [ARROW_TYPES[v] for v in fields.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for piece in pieces(batch, text):
                values = work(piece.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*piece.columns, *(v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(values, kinds, strict=True))], names=names)

    return kept.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """Rows to learn from: the id is known and the row isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 != 2, F.lit(False))


def digests(*columns: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds; together they identify the values of `columns`."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)]


def sampled(rows: DataFrame, key: Column, bound: int) -> DataFrame:
    """A sample by hash of `key`, of `bound` rows in expectation; all rows where there are fewer.

    Costs one count that reads only the columns the filters above it need.
    """
    n = rows.count()
    if n <= bound:
        return rows
    return rows.filter(F.pmod(F.xxhash64(F.lit(11), key), F.lit(1 << 30)) < int(bound / n * (1 << 30)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
