"""Entity keys and directions derived from identifiers by hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perigee.functions.text import strip
from perigee.vocabulary import DIRECTION_SALT, KEY_NAMESPACE


def entity_key(spkid: Column) -> Column:
    """`ast_` + the name-based (version 5) UUID of `spk:<id>` in the fixed namespace.

    A version 5 UUID is the first 16 bytes of SHA-1(namespace bytes, name bytes) with the version
    nibble set to 5 and the top two bits of the ninth byte set to 10.
    """
    name = F.encode(F.concat(F.lit("spk:"), strip(spkid)), "UTF-8")
    namespace = F.unhex(F.lit(KEY_NAMESPACE.replace("-", "")))
    digest = F.sha1(F.concat(namespace, name))
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex(nibble.bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8)).cast("bigint")))
    return F.concat(
        F.lit("ast_"), F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def is_entity_key(text: Column) -> Column:
    return text.rlike(r"(?i)^ast_[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")


def unit_direction(identifier: Column) -> Column:
    """Struct (x, y, z): a point uniform on the unit sphere, fixed by the identifier.

    Two 64-bit fractions of a salted SHA-256 give the height and the azimuth (equal-area map).
    """
    digest = F.sha2(F.concat(F.lit(DIRECTION_SALT), identifier), 256)

    def fraction(start: int) -> Column:
        word = F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(20,0)")
        return word.cast("double") / F.lit(2.0**64)

    height = 1.0 - 2.0 * fraction(1)
    azimuth = 2.0 * F.pi() * fraction(17)
    radius = F.sqrt(F.greatest(F.lit(0.0), 1.0 - height * height))
    return F.struct(
        (radius * F.cos(azimuth)).alias("x"), (radius * F.sin(azimuth)).alias("y"), height.alias("z")
    )
