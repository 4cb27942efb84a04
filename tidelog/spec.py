"""Description of a replicated table: its name, key columns and value columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DataType, StructField, StructType

PARTITION = "KFK_PTT"
OFFSET = "KFK_OFFSET"
OP = "__OP_TYPE"

INSERT, UPDATE, DELETE = "I", "U", "D"


@dataclass(frozen=True)
class TableSpec:
    """A table whose changes are replicated.

    Offsets are compared per key, which is sound because a topic keyed by the
    primary key sends every change of one key to one partition
    (``tidelog.operators.quality.split_keys`` finds violations).
    """

    name: str
    key: StructType
    values: StructType

    @classmethod
    def of(cls, name: str, key: dict[str, DataType], values: dict[str, DataType]) -> TableSpec:
        """Build a spec from column types by name."""
        struct = lambda columns: StructType([StructField(n, t) for n, t in columns.items()])
        return cls(name, struct(key), struct(values))

    @property
    def pk(self) -> list[str]:
        return self.key.fieldNames()

    @property
    def columns(self) -> list[str]:
        return self.values.fieldNames()

    def type_of(self, column: str):
        return (self.values if column in self.columns else self.key)[column].dataType
