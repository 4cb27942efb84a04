"""Connect records: JSON with a schema part and a payload part."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Names of the logical types of the record format.
CONNECT_DATE = "org.apache.kafka.connect.data.Date"
CONNECT_DECIMAL = "org.apache.kafka.connect.data.Decimal"
CONNECT_TIMESTAMP = "org.apache.kafka.connect.data.Timestamp"

_TIMES = (TimestampType, TimestampNTZType)
_TWO_64 = "18446744073709551616"
_TWO_32 = "4294967296"


def connect_field(field: StructField) -> dict:
    """Schema entry of one column."""
    entry = {"field": field.name, "type": field.dataType.typeName(), "optional": field.nullable}
    if isinstance(field.dataType, (IntegerType, LongType)):
        entry["type"] = "int64"
    elif isinstance(field.dataType, DateType):
        entry.update(type="int32", name=CONNECT_DATE, version=1)
    elif isinstance(field.dataType, _TIMES):
        entry.update(type="int64", name=CONNECT_TIMESTAMP, version=1)
    elif isinstance(field.dataType, DecimalType):
        entry.update(type="bytes", name=CONNECT_DECIMAL, version=1, parameters={
            "scale": str(field.dataType.scale),
            "connect.decimal.precision": str(field.dataType.precision),
        })
    return entry


def connect_schema(schema: StructType, columns: list[str], name: str) -> str:
    """Schema part as JSON text; it depends on column types only."""
    fields = [connect_field(schema[c]) for c in columns]
    return json.dumps({"type": "struct", "optional": False, "name": name, "fields": fields},
                      separators=(",", ":"), ensure_ascii=False)


def decimal_bytes(value: Column, dtype: DecimalType) -> Column:
    """Base64 of the unscaled value as big-endian two's complement.

    Eight bytes up to 18 digits, sixteen beyond. The digits are taken from the
    plain text of the decimal, which is exact at every scale.
    """
    digits = F.replace(value.cast("string"), F.lit("."), F.lit(""))
    if dtype.precision <= 18:
        return F.base64(F.unhex(F.lpad(F.hex(digits.cast("bigint")), 16, "0")))
    unscaled = digits.cast("decimal(38,0)")
    word, half = F.lit(_TWO_64).cast("decimal(20,0)"), F.lit(_TWO_32).cast("decimal(10,0)")
    rest = unscaled % word
    low = F.when(rest < 0, rest + word).otherwise(rest).cast("decimal(20,0)")
    high = F.call_function("div", unscaled, word) - F.when(rest < 0, 1).otherwise(0)
    return F.base64(F.unhex(F.concat(
        F.lpad(F.hex(high), 16, "0"),
        F.lpad(F.hex(F.call_function("div", low, half)), 8, "0"),
        F.lpad(F.hex((low % half).cast("bigint")), 8, "0"),
    )))


def payload_value(value: Column, dtype: DataType) -> Column:
    """Value as the record format carries it."""
    if isinstance(dtype, _TIMES):
        return F.unix_millis(value.cast("timestamp"))
    if isinstance(dtype, DateType):
        return F.unix_date(value)
    if isinstance(dtype, DecimalType):
        return decimal_bytes(value, dtype)
    return value


def connect_json(schema: StructType, columns: list[str], name: str) -> Column:
    """The complete record text for ``columns``; the schema part is one literal."""
    payload = F.struct(*[payload_value(F.col(c), schema[c].dataType).alias(c) for c in columns])
    head = '{"schema":' + connect_schema(schema, columns, name) + ',"payload":'
    return F.concat(F.lit(head), F.to_json(payload, {"ignoreNullFields": "false"}), F.lit("}"))
