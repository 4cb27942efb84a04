"""Explicit nulls of updates as default values, for consumers without presence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tidelog.spec import OP, UPDATE, TableSpec

# The default standing for an explicit null, by type family.
NUMERIC_DEFAULT = -999999999
TIMESTAMP_DEFAULT = 300000000000  # epoch milliseconds
STRING_DEFAULT = "__UPDATE_NULL__"
DATE_DEFAULT = 3333  # days since the epoch


def default_for(dtype: DataType) -> Column:
    """The default of a type as a literal of this type."""
    if isinstance(dtype, DecimalType) and dtype.precision - dtype.scale < 9:
        raise ValueError(f"{dtype.simpleString()} cannot hold {NUMERIC_DEFAULT}")
    if isinstance(dtype, (IntegerType, LongType, DoubleType, DecimalType)):
        return F.lit(NUMERIC_DEFAULT).cast(dtype)
    if isinstance(dtype, StringType):
        return F.lit(STRING_DEFAULT)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.timestamp_millis(F.lit(TIMESTAMP_DEFAULT)).cast(dtype)
    if isinstance(dtype, DateType):
        return F.date_from_unix_date(F.lit(DATE_DEFAULT))
    raise ValueError(f"no default for type {dtype.simpleString()}")


def encode_nulls(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Flatten presence structs; an explicit null of an update becomes the default."""
    flat = {}
    for name in spec.columns:
        cell = F.col(name)
        nulled = (F.col(OP) == UPDATE) & cell.isNotNull() & cell["v"].isNull()
        flat[name] = F.when(nulled, default_for(spec.type_of(name))).otherwise(cell["v"])
    return changes.withColumns(flat)


def decode_value(value: Column, dtype: DataType) -> Column:
    """Null where the value equals the default of its type."""
    return F.nullif(value, default_for(dtype))


def decode_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Turn defaults of the listed columns back into nulls."""
    return df.withColumns({c: decode_value(F.col(c), df.schema[c].dataType) for c in columns})
