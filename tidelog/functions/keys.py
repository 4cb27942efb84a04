"""Composition and splitting of hash keys and composite field names.

Parts are joined with ``:``. A part that itself contains ``:`` or ``%`` is
percent-encoded, so that keys of different rows never collide and a composite
field splits back into exactly its parts; ordinary parts look as they are. A null
part is written as the text ``None``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ":"
NULL_TEXT = "None"


def encode_part(part: Column) -> Column:
    text = F.coalesce(part.cast("string"), F.lit(NULL_TEXT))
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit(":"), F.lit("%3A"))


def decode_part(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%3A"), F.lit(":")), F.lit("%25"), F.lit("%"))


def hash_key(table: str, parts: list[Column], names: list[str] | None = None) -> Column:
    """``TABLE:v1:v2``, or ``TABLE:A:B:<a>:<b>`` for a secondary key over ``names``."""
    prefix = [F.lit(table)] + [F.lit(n) for n in (names or [])]
    return F.concat_ws(SEPARATOR, *prefix, *[encode_part(p) for p in parts])


def composite_field(parts: list[Column], column: Column) -> Column:
    """``<part>:<part>:COLUMN``."""
    return F.concat_ws(SEPARATOR, *[encode_part(p) for p in parts], column)


def key_prefix(table: str, names: list[str] | None = None) -> str:
    """Text every key of ``table`` (or of its secondary key ``names``) starts with."""
    return SEPARATOR.join([table, *(names or [])]) + SEPARATOR


def key_parts(rk: Column, prefix: str) -> Column:
    """Encoded parts of a key after its prefix."""
    return F.split(F.substr(rk, F.lit(len(prefix) + 1)), SEPARATOR)


def key_part(rk: Column, prefix: str, index: int) -> Column:
    return decode_part(F.get(key_parts(rk, prefix), F.lit(index)))


def split_field(field: Column) -> tuple[Column, Column]:
    """Split a composite field into its owner text and its column name."""
    column = F.substring_index(field, SEPARATOR, -1)
    owner_length = F.greatest(F.length(field) - F.length(column) - 1, F.lit(0))
    return F.substr(field, F.lit(1), owner_length), column
