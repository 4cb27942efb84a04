"""Row-at-a-time model of the change semantics, for comparison on small inputs."""

import json

from pyspark.sql.types import LongType, StringType

from tidelog.sources.change_stream import RAW_SCHEMA
from tidelog.spec import TableSpec

SPEC = TableSpec.of("T", {"ID": LongType()}, {"A": StringType(), "B": LongType()})
ABSENT = "__absent__"


def record(key, op, offset, partition=0, **values):
    """A change as (KEY, VALUE, topic, partition, offset)."""
    value = None
    if op != "tombstone":
        fields = {k: v for k, v in values.items() if v != ABSENT}
        value = json.dumps({"payload": {"ID": key, **fields, "__OP_TYPE": op}})
    return json.dumps({"payload": {"ID": key}}), value, "t", partition, offset


def frame(spark, records):
    return spark.createDataFrame(records, RAW_SCHEMA)


def replay(records, rows=None, columns=("A", "B")):
    """Apply records in offset order to ``{key: (values, partition, offset)}``."""
    rows = dict(rows or {})
    for key, value, _, partition, offset in sorted(records, key=lambda r: r[4]):
        pk = json.loads(key)["payload"]["ID"]
        payload = {"__OP_TYPE": "D"} if value is None else json.loads(value)["payload"]
        if payload["__OP_TYPE"] == "D":
            rows.pop(pk, None)
            continue
        present = {c: payload[c] for c in columns if c in payload}
        if payload["__OP_TYPE"] == "U" and not present:
            continue
        old = rows.get(pk, (dict.fromkeys(columns), None, None))[0]
        rows[pk] = ({**old, **present}, partition, offset)
    return rows


def as_rows(df):
    return {r["ID"]: ({"A": r["A"], "B": r["B"]}, r["KFK_PTT"], r["KFK_OFFSET"]) for r in df.collect()}
