"""Rendering of typed values as hash-store text and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

from tidelog.functions.keys import NULL_TEXT


def to_stored_text(value: Column, dtype: DataType | None = None) -> Column:
    """Text kept in the store: null is ``None``, timestamps are epoch milliseconds."""
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        value = F.unix_millis(value.cast("timestamp"))
    return F.coalesce(value.cast("string"), F.lit(NULL_TEXT))


def from_stored_text(text: Column, dtype: DataType) -> Column:
    """Typed value of a stored text; ``None`` and texts that do not fit are null."""
    text = F.nullif(text, F.lit(NULL_TEXT))
    if isinstance(dtype, StringType):
        return text
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.timestamp_millis(text.try_cast("bigint")).cast(dtype)
    if isinstance(dtype, DateType):
        return text.try_cast("date")
    return text.try_cast(dtype)
