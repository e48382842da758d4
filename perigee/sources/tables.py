"""Stored tables: declared schemas, typed-empty when absent, text partition columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.schemas import DATE_PARTS, REQUIRED_TABLES, TABLE_DDL, table_schema
from perigee.sources.files import exists, first_existing

# Other names a table may be stored under, in order of preference.
ALIASES = {
    "fact_sentry_risk_snapshot": ["fact_sentry_risk_snapshot.parquet", "sentry_risk_snapshot.parquet"],
    "bridge_asteroid_identifier": ["bridge_asteroid_identifier.parquet", "dim_asteroid_crosswalk.parquet"],
    "fact_entity_resolution": ["fact_entity_resolution.parquet", "audit_entity_resolution.parquet"],
}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], table_schema(name))


def read_table(spark: SparkSession, path: str | None, name: str) -> DataFrame:
    """The table at `path` under its declared schema; columns an old file lacks read as NULL.

    A missing path gives a typed empty frame, which Catalyst folds out of the plan.
    """
    if not path or not exists(spark, path):
        return empty_table(spark, name)
    return spark.read.schema(table_schema(name)).parquet(path)


def stored_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns actually present in the files (read from footers)."""
    return spark.read.parquet(path).columns


def read_partitioned(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table laid out as year=/month=/day=; the parts stay zero-padded text."""
    parts = T.StructType.fromDDL(DATE_PARTS)
    if not exists(spark, root):
        return spark.createDataFrame([], T.StructType(table_schema(name).fields + parts.fields))
    schema = T.StructType(table_schema(name).fields + parts.fields)
    return spark.read.schema(schema).option("basePath", root).parquet(root)


# Every blank is data; a NULL is written as a mark, so that an empty text stays one. Line ends and the sign
# of the escapes itself are written as escapes, so that each row is one line: files can be split, and no
# text is taken for a mark.
CSV_FORMAT = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": "\\N", "escape": '"'}
LINE_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def escape_lines(df: DataFrame) -> DataFrame:
    """Text columns with backslash and line ends as two-character escapes."""
    def escaped(value: Column) -> Column:
        for sign, written in LINE_ESCAPES:
            value = F.replace(value, F.lit(sign), F.lit(written))
        return value

    return df.withColumns({c: escaped(F.col(c)) for c in _text_columns(df)})


def restore_lines(df: DataFrame) -> DataFrame:
    """Text columns as they were before `escape_lines`."""
    def restored(value: Column) -> Column:
        # Split at escaped backslashes first: what is left between them holds only whole escapes.
        parts = F.transform(F.split(value, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
        return F.array_join(parts, "\\")

    return df.withColumns({c: restored(F.col(c)) for c in _text_columns(df)})


def read_csv(spark: SparkSession, path: str, name: str = "asteroids_csv") -> DataFrame:
    """Comma-separated files with one header line each; blanks and line ends count, and NULL is not the empty text."""
    return restore_lines(spark.read.schema(table_schema(name)).options(**CSV_FORMAT).csv(path))


def resolve_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by name: the first stored name found in the folder."""
    return read_table(spark, first_existing(spark, folder, ALIASES.get(name, [f"{name}.parquet"])), name)


@dataclass(frozen=True)
class Lakehouse:
    """The eight tables the read side needs."""

    asteroids: DataFrame
    risk: DataFrame
    objects: DataFrame
    orbits: DataFrame
    elements: DataFrame
    physical: DataFrame
    bridge: DataFrame
    audit: DataFrame


_MEMBERS = {
    "asteroids": "asteroids",
    "risk": "fact_sentry_risk_snapshot",
    "objects": "fact_sbdb_object_snapshot",
    "orbits": "fact_sbdb_orbit",
    "elements": "fact_sbdb_orbit_element",
    "physical": "fact_sbdb_physical_parameter",
    "bridge": "bridge_asteroid_identifier",
    "audit": "fact_entity_resolution",
}


def open_lakehouse(spark: SparkSession, folder: str) -> Lakehouse:
    """All tables of a folder; those that are missing are empty, so every query keeps one shape."""
    return Lakehouse(**{member: resolve_table(spark, folder, name) for member, name in _MEMBERS.items()})


def register_views(tables: Lakehouse) -> None:
    """Expose the tables to SQL under their stored names."""
    for member, name in _MEMBERS.items():
        getattr(tables, member).createOrReplaceTempView(name)


def storage_ready(spark: SparkSession, folder: str) -> DataFrame:
    """One row per required table and whether it is stored."""
    rows = [(n, exists(spark, f"{folder}/{n}.parquet")) for n in REQUIRED_TABLES]
    return spark.createDataFrame(rows, "table_name string, present boolean")


def check_contract(df: DataFrame, name: str) -> DataFrame:
    """The declared columns in order; unknown or mistyped columns are an error."""
    wanted = table_schema(name)
    extra = [c for c in df.columns if c not in wanted.fieldNames()]
    if extra:
        raise ValueError(f"{name}: columns outside the contract: {extra}")
    out = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted])
    wrong = [f.name for f, got in zip(wanted, out.schema) if f.dataType != got.dataType]
    if wrong:
        raise ValueError(f"{name}: wrong types for {wrong}")
    return out


def known_tables() -> list[str]:
    return list(TABLE_DDL)
