"""Maintenance of secondary hashes from the old and the new state of touched keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.keys import composite_field, hash_key
from tidelog.functions.skew import pin_small
from tidelog.functions.stored_text import to_stored_text
from tidelog.operators.fold import ALIVE, RESET
from tidelog.operators.hash_store import HDEL, SET, emit, entry
from tidelog.spec import TableSpec


def touched_before_after(image: DataFrame, folded: DataFrame, spec: TableSpec,
                         max_keys: int | None = None) -> DataFrame:
    """Per touched key the old row (``before``) and the new row (``after``), null if none.

    With ``max_keys`` the touched keys are counted first and, if few, filter the
    image by broadcast, so that it is not shuffled. This evaluates ``folded`` once
    more; persist it.
    """
    if max_keys:
        keys, small = pin_small(folded.select(*spec.pk), max_keys)
        if small:
            image = image.join(F.broadcast(keys), spec.pk, "left_semi")
    old = image.select(*spec.pk, F.struct(*spec.columns).alias("before"))
    pair = folded.join(old, spec.pk, "left")

    def after(name: str) -> Column:
        return (F.when(F.col(name).isNotNull(), F.col(name)["v"])
                .when(~F.col(RESET), F.col("before")[name]).alias(name))

    row = F.struct(*[after(c) for c in spec.columns])
    return pair.select(
        *spec.pk, "before", F.when(F.col(ALIVE), row).alias("after"), RESET,
        *[F.col(c).isNotNull().alias(f"__set_{c}") for c in spec.columns])


def index_mutations(touched: DataFrame, spec: TableSpec, pseudo_keys: list[list[str]],
                    value_columns: list[str]) -> DataFrame:
    """Field deletes and writes for every pseudo key.

    Fields leave the old hash when the row is gone or moved; in the new hash all
    fields are written for a new or moved row, else the changed ones.
    """
    before, after = F.col("before"), F.col("after")
    entries = []
    for pseudo_key in pseudo_keys:
        owner = [F.col(c) for c in spec.pk if c not in pseudo_key]
        part = lambda row: [F.col(c) if c in spec.pk else row[c] for c in pseudo_key]
        old_rk = hash_key(spec.name, part(before), pseudo_key)
        new_rk = hash_key(spec.name, part(after), pseudo_key)
        moved = old_rk != new_rk
        leaves = before.isNotNull() & (after.isNull() | moved)
        rewritten = before.isNull() | moved | F.col(RESET)
        for name in value_columns:
            field = composite_field(owner, F.lit(name))
            entries.append(F.when(leaves, entry(HDEL, old_rk, field, None)))
            value = to_stored_text(after[name], spec.type_of(name))
            changed = after.isNotNull() & (rewritten | F.col(f"__set_{name}"))
            entries.append(F.when(changed, entry(SET, new_rk, field, value)))
    return emit(touched, entries)


def sync_columns(spec: TableSpec, pseudo_keys: list[list[str]], value_columns: list[str]) -> list[str]:
    """Columns the primary hash needs: every pseudo key column and value column, without the key."""
    wanted = dict.fromkeys([c for q in pseudo_keys for c in q] + value_columns)
    return [c for c in wanted if c not in spec.pk]

