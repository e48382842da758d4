"""Text normalisation, secret redaction, and reading typed leaves out of JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perigee.vocabulary import SENSITIVE_WORDS

# Everything that counts as whitespace: the ASCII blanks and separators and the Unicode spaces.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_RUN = r"(?U)[\s\x1c-\x1f]+"
# The fixed name comes first, as Java then skips through the text; what stands before it is looked at where it is found.
_SECRET = r"(?U)api_key=(?<=[?&]api_key=)[^&\"'\s]+"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def _collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _RUN, " "))


def squeeze(text: Column) -> Column:
    """Strip, and collapse every whitespace run to one space; NULL becomes the empty text."""
    return F.coalesce(_collapse(text), F.lit(""))


def unwrap(text: Column) -> Column:
    """Remove one outer pair of parentheses when it wraps the whole text (of one line)."""
    return F.regexp_replace(text, r"^\((.*)\)$", "$1")


def normalize_designation(text: Column) -> Column:
    """The matching form of a designation: squeezed, unwrapped once, upper case. Stored values never change.

    Once runs are collapsed the only blanks left are single spaces, so the inner text needs a trim.
    """
    return F.coalesce(F.upper(F.trim(unwrap(_collapse(text)))), F.lit(""))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def redact_api_key(text: Column) -> Column:
    """Hide the value of an `api_key` query parameter up to the next separator, quote or space."""
    return F.regexp_replace(text, _SECRET, "api_key=REDACTED")


def is_sensitive(name: Column) -> Column:
    lowered = F.lower(strip(name))
    hit = F.lit(False)
    for word in SENSITIVE_WORDS:
        hit = hit | lowered.contains(word)
    return hit


def scrub_map(entries: Column) -> Column:
    """Drop sensitive keys of a map<string,string> and redact what remains."""
    kept = F.map_filter(entries, lambda k, _: ~is_sensitive(k))
    return F.transform_values(kept, lambda _, v: redact_api_key(v))


def scrub_struct(column: Column, schema) -> Column:
    """Walk a struct/array/map column by its schema: drop sensitive fields, redact every string leaf."""
    from pyspark.sql import types as T

    if isinstance(schema, T.StringType):
        return redact_api_key(column)
    if isinstance(schema, T.ArrayType):
        return F.transform(column, lambda item: scrub_struct(item, schema.elementType))
    if isinstance(schema, T.MapType):
        kept = F.map_filter(column, lambda k, _: ~is_sensitive(k))
        return F.transform_values(kept, lambda _, v: scrub_struct(v, schema.valueType))
    if isinstance(schema, T.StructType):
        fields = [
            scrub_struct(column.getField(f.name), f.dataType).alias(f.name)
            for f in schema.fields
            if not any(word in f.name.strip().lower() for word in SENSITIVE_WORDS)
        ]
        return F.when(column.isNotNull(), F.struct(*fields)) if fields else F.lit(None)
    return column


# --- leaves of a JSON record held as VARIANT -----------------------------------------------------

def leaf(record: Column, path: str) -> Column:
    """The value at `path` as VARIANT; NULL when absent or JSON null."""
    value = F.try_variant_get(record, path, "variant")
    return F.when(~F.is_variant_null(value), value)


def leaf_kind(record: Column, path: str) -> Column:
    """JSON type of the value at `path`: BOOLEAN, STRING, BIGINT, DECIMAL(..), DOUBLE, OBJECT<..>, ARRAY<..>."""
    return F.schema_of_variant(leaf(record, path))


def leaf_text(record: Column, path: str) -> Column:
    """The value at `path` as text whatever its JSON type; NULL when absent or JSON null."""
    return F.try_variant_get(record, path, "string")


def is_object(record: Column, path: str) -> Column:
    return F.coalesce(leaf_kind(record, path).startswith("OBJECT"), F.lit(False))


def is_number(kind: Column) -> Column:
    return kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
