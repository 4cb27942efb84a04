"""Durable state of a replicated table: a bucketed base, its manifest, and one small delta per micro-batch.

A batch is reduced to one state per key and written to a delta folder of its own; the
image is never rewritten for it. Reading combines the base with the deltas that the base does
not hold yet. ``compact`` merges these into the buckets they touch, writes those buckets as a
new version, and then a manifest: which folder holds each bucket and the offsets in it, and
which deltas are contained. The other buckets stay where they are, so a compaction costs what
the deltas touch, and a delta is read until it is merged and never again.

As combining is idempotent, a batch written twice or a compaction that ended before its
manifest changes nothing. Beside every delta and every base lies a zone map, the largest
offset per partition, so that a gate by offset reads neither.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidelog.functions.skew import SMALL_ROWS, pin_small
from tidelog.operators.fold import (
    DELETED_AT,
    LIVE_AT,
    combine_states,
    current_rows,
    finish_states,
    lift_changes,
    lift_rows,
)
from tidelog.spec import OFFSET, PARTITION, TableSpec

BUCKET, VERSION = "__bucket", "__version"
DELTA_NAME = re.compile(r"[0-9a-f]{32}")


@dataclass
class Manifest:
    """What the base consists of; its size follows the number of buckets, not of rows."""

    version: int = -1
    buckets: int = 0
    written: dict[str, int] = field(default_factory=dict)          # bucket -> version whose folder holds it
    offsets: dict[str, list[int]] = field(default_factory=dict)    # bucket -> least and largest offset
    deltas: list[str] = field(default_factory=list)                # merged, as far as their folders still exist


class ChangeStore:
    """``buckets`` is the layout of the bases this handle writes; it does not affect reading."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.buckets = buckets

    # -- folders ---------------------------------------------------------
    def _glob(self, pattern: str) -> list[str]:
        """Paths below the root that match, relative to it."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        depth = pattern.count("/") + 1
        return sorted("/".join(status.getPath().toUri().getPath().split("/")[-depth:]) for status in found or [])

    def _complete(self, kind: str) -> list[str]:
        """Names of the completely written folders of a kind (those with a success marker)."""
        return [name.split("/")[1] for name in self._glob(f"{kind}/*/_SUCCESS")]

    def manifest(self) -> Manifest:
        """The newest complete manifest."""
        versions = [int(name) for name in self._complete("manifest")]
        if not versions:
            return Manifest()
        text = self.spark.read.text(f"{self.root}/manifest/{max(versions):08d}", wholetext=True).first()[0]
        return Manifest(**json.loads(text))

    def _new_deltas(self, manifest: Manifest) -> list[str]:
        """Complete deltas that the base does not contain."""
        merged = set(manifest.deltas)
        return [name for name in self._complete("delta") if DELTA_NAME.fullmatch(name) and name not in merged]

    # -- layout ----------------------------------------------------------
    def _state_schema(self) -> StructType:
        at = lambda f: StructType([StructField("at", LongType()), StructField("v", f.dataType)])
        return StructType(
            [StructField(f.name, f.dataType) for f in self.spec.key]
            + [StructField(PARTITION, IntegerType()), StructField(OFFSET, LongType()),
               StructField(DELETED_AT, LongType()), StructField(LIVE_AT, LongType())]
            + [StructField(f.name, at(f)) for f in self.spec.values])

    def _zone_schema(self) -> StructType:
        return StructType([StructField(PARTITION, IntegerType()), StructField(OFFSET, LongType())])

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.spec.pk), F.lit(buckets)).cast("int")

    def _buckets_of(self, df: DataFrame, buckets: int) -> list[int]:
        """Buckets that the keys of ``df`` fall into; at most ``buckets`` numbers reach the driver."""
        return sorted(r[0] for r in df.select(self._bucket(buckets).alias("b")).distinct().collect())

    def _cast(self, states: DataFrame) -> DataFrame:
        return states.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                               for f in self._state_schema()])

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self._state_schema())

    # -- writing ---------------------------------------------------------
    def _zones(self, states: DataFrame) -> DataFrame:
        return (states.filter(F.col(PARTITION).isNotNull()).groupBy(PARTITION).agg(F.max(OFFSET).alias(OFFSET))
                .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._zone_schema()]))

    def append(self, changes: DataFrame) -> None:
        """Store the net effect of a batch of changes; storing it again is harmless."""
        states = combine_states(lift_changes(changes, self.spec), self.spec)
        name = uuid.uuid4().hex
        self._cast(states).write.parquet(f"{self.root}/delta/{name}")
        # a delta whose zone map is lacking is still read, and asked for its offsets itself
        self._zones(self._read_deltas([name])).coalesce(1).write.parquet(f"{self.root}/zone/{name}")

    def seed(self, image: DataFrame) -> None:
        """Take in a table image (offsets -1 if it was bulk loaded)."""
        self._merge(self._cast(lift_rows(image, self.spec)), everything=True)

    def compact(self) -> list[str]:
        """Merge the deltas into the buckets they touch; returns the folders that are no longer needed."""
        self._merge(None)
        return self.replaced()

    def _merge(self, more: DataFrame | None, everything: bool = False) -> None:
        manifest = self.manifest()
        deltas = self._new_deltas(manifest)
        other_layout = manifest.version >= 0 and manifest.buckets != self.buckets
        if not deltas and more is None and not other_layout:
            return
        fresh = [] if more is None else [more]
        fresh += [self._read_deltas(deltas)] if deltas else []
        touched = None if everything or other_layout else self._buckets_of(reduce(DataFrame.unionByName, fresh), self.buckets)
        kept = self._read_base(manifest, touched)
        states = combine_states(reduce(DataFrame.unionByName, [*([] if kept is None else [kept]), *fresh]), self.spec)
        version = manifest.version + 1
        # adaptive execution sizes the files: large buckets are split, small ones share a task
        (self._cast(states).withColumn(BUCKET, self._bucket(self.buckets)).hint("rebalance", BUCKET)
         .write.mode("overwrite").partitionBy(BUCKET).parquet(self._version_folder(version)))
        zones = self._applied(manifest, deltas)
        if more is not None:
            zones = zones.unionByName(self._zones(more))
        self._zones(zones).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/zone/base-{version:08d}")
        self._commit(manifest, version, deltas, touched is None)

    def _version_folder(self, version: int) -> str:
        return f"{self.root}/base/{VERSION}={version}"

    def _commit(self, before: Manifest, version: int, deltas: list[str], everything: bool) -> None:
        """Write the manifest that makes a version's buckets count."""
        schema = self._state_schema().add(StructField(BUCKET, IntegerType()))
        rows = self.spark.read.schema(schema).parquet(self._version_folder(version))
        ranges = rows.groupBy(BUCKET).agg(F.min(OFFSET).alias("low"), F.max(OFFSET).alias("high")).collect()
        written, offsets = ({}, {}) if everything else (dict(before.written), dict(before.offsets))
        written.update({str(r[BUCKET]): version for r in ranges})
        offsets.update({str(r[BUCKET]): [r["low"], r["high"]] for r in ranges})
        there = set(self._complete("delta"))
        after = Manifest(version, self.buckets, written, offsets, [d for d in before.deltas if d in there] + deltas)
        text = self.spark.createDataFrame([(json.dumps(asdict(after)),)], "value string")
        text.coalesce(1).write.text(f"{self.root}/manifest/{version:08d}")

    def replaced(self) -> list[str]:
        """Folders that the newest manifest does without: merged deltas, and versions of buckets before it."""
        manifest = self.manifest()
        merged = {f"{kind}/{name}" for kind in ("delta", "zone") for name in manifest.deltas}
        gone = [name for name in (*self._glob("delta/*"), *self._glob("zone/*")) if name in merged]
        for name in self._glob(f"base/{VERSION}=*/{BUCKET}=*"):
            version, bucket = (int(part.partition("=")[2]) for part in name.split("/")[1:])
            if version <= manifest.version and manifest.written.get(str(bucket)) != version:
                gone.append(name)
        gone += [f"manifest/{name}" for name in self._complete("manifest") if int(name) < manifest.version]
        gone += [name for name in self._glob("zone/base-*") if int(name[-8:]) < manifest.version]
        return gone

    def retire(self, folders: list[str]) -> None:
        """Delete folders a compaction has replaced, once no reader uses them."""
        for name in folders:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    # -- reading ---------------------------------------------------------
    def _read_base(self, manifest: Manifest, buckets: list[int] | None = None) -> DataFrame | None:
        """States of the given buckets (all, if None); only their folders are listed and read."""
        wanted = manifest.written if buckets is None else {str(b): None for b in buckets}
        folders = [f"{self._version_folder(manifest.written[b])}/{BUCKET}={b}" for b in wanted if b in manifest.written]
        if not folders:
            return None
        schema = self._state_schema().add(StructField(VERSION, IntegerType())).add(StructField(BUCKET, IntegerType()))
        base = self.spark.read.schema(schema).option("basePath", f"{self.root}/base").parquet(*folders)
        return base.drop(VERSION, BUCKET)

    def _read_deltas(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(self._state_schema()).parquet(*[f"{self.root}/delta/{n}" for n in names])

    def _applied(self, manifest: Manifest, deltas: list[str]) -> DataFrame:
        """Rows of the zone maps of the base and of ``deltas``."""
        mapped = set(self._complete("zone"))
        maps = [f"{self.root}/zone/{n}" for n in deltas if n in mapped]
        if manifest.version >= 0:
            maps.append(f"{self.root}/zone/base-{manifest.version:08d}")
        found = (self.spark.read.schema(self._zone_schema()).parquet(*maps) if maps
                 else self.spark.createDataFrame([], self._zone_schema()))
        unmapped = [n for n in deltas if n not in mapped]
        return found.unionByName(self._zones(self._read_deltas(unmapped))) if unmapped else found

    def applied_offsets(self) -> DataFrame:
        """Largest offset held per partition, from the zone maps alone.

        Usable as the image of ``offset_gate``: neither the base nor a delta is read.
        """
        manifest = self.manifest()
        return self._zones(self._applied(manifest, self._new_deltas(manifest)))

    def states(self, max_keys: int = SMALL_ROWS) -> DataFrame:
        """One state per key, deleted keys included.

        While the deltas touch at most ``max_keys`` keys (checked), the untouched
        part of the base is passed through without a shuffle. Only keys are counted and
        broadcast; the rows of the deltas stay on the executors.
        """
        manifest = self.manifest()
        names = self._new_deltas(manifest)
        base = self._read_base(manifest)
        if not names:
            return self._empty() if base is None else base
        deltas = self._read_deltas(names)
        if base is None:
            return self._cast(combine_states(deltas, self.spec))
        keys, small = pin_small(deltas.select(*self.spec.pk).distinct(), max_keys)
        if not small:
            return self._cast(combine_states(base.unionByName(deltas), self.spec))
        hit = self._buckets_of(keys, manifest.buckets)
        parts = [self._read_base(manifest, [int(b) for b in manifest.written if int(b) not in set(hit)])]
        held = self._read_base(manifest, hit)
        fresh = deltas
        if held is not None:
            parts.append(held.join(F.broadcast(keys), self.spec.pk, "left_anti"))
            fresh = held.join(F.broadcast(keys), self.spec.pk, "left_semi").unionByName(deltas)
        parts.append(self._cast(combine_states(fresh, self.spec)))
        return reduce(DataFrame.unionByName, [p for p in parts if p is not None])

    def image(self) -> DataFrame:
        """Current rows of the table."""
        return current_rows(finish_states(self.states(), self.spec), self.spec)

    def rows_of(self, keys: DataFrame, max_keys: int = SMALL_ROWS) -> DataFrame:
        """Current rows of the given keys.

        Up to ``max_keys`` keys (checked) are broadcast and read only their buckets
        of the base; more are joined to the whole image.
        """
        wanted, small = pin_small(keys.select(*self.spec.pk).distinct(), max_keys)
        if not small:
            return self.image().join(wanted, self.spec.pk, "left_semi")
        manifest = self.manifest()
        names, parts = self._new_deltas(manifest), []
        if manifest.written:
            parts.append(self._read_base(manifest, self._buckets_of(wanted, manifest.buckets)))
        if names:
            parts.append(self._read_deltas(names))
        parts = [p.join(F.broadcast(wanted), self.spec.pk, "left_semi") for p in parts if p is not None] or [self._empty()]
        combined = combine_states(reduce(DataFrame.unionByName, parts), self.spec)
        return current_rows(finish_states(combined, self.spec), self.spec)

    def changed_since(self, offset: int) -> DataFrame:
        """Folded states of the keys whose newest change is after ``offset``, deleted ones too.

        Reads the deltas not merged yet, their buckets, and the buckets whose range of
        offsets goes beyond ``offset``.
        """
        manifest = self.manifest()
        names = self._new_deltas(manifest)
        buckets = {int(b) for b, (_, high) in manifest.offsets.items() if high > offset}
        parts = []
        if names:
            deltas = self._read_deltas(names)
            parts.append(deltas)
            buckets |= set(self._buckets_of(deltas, manifest.buckets)) if manifest.written else set()
        parts.append(self._read_base(manifest, sorted(buckets)))
        parts = [p for p in parts if p is not None] or [self._empty()]
        combined = combine_states(reduce(DataFrame.unionByName, parts), self.spec)
        return finish_states(combined.filter(F.col(OFFSET) > offset), self.spec)
