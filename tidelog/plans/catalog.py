"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

import contextlib
import datetime
import itertools
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tidelog.functions.keys import NULL_TEXT, hash_key
from tidelog.functions.sentinels import decode_nulls, encode_nulls
from tidelog.operators import enrich, filters, fold, hash_store, index_sync, lag, lookup, merge
from tidelog.operators import records, versioned_lookup
from tidelog.operators.parse import flatten, parse_changes, presence_flags, rejected_changes
from tidelog.operators.quality import split_keys
from tidelog.plans import fixtures as fx
from tidelog.plans.fixtures import EVT
from tidelog.session import configure, work_dir
from tidelog.sinks import jdbc as jdbc_sink
from tidelog.sinks.change_store import ChangeStore
from tidelog.sinks.records import write_csv, write_record_files
from tidelog.sinks.tables import replace_slice_files, written_table
from tidelog.sinks.hash_writer import fetch_hashes
from tidelog.sources import jdbc as jdbc_source
from tidelog.sources import kv_source
from tidelog.sources.change_stream import file_stream, project_raw
from tidelog.sources.offset_log import read_offset_log
from tidelog.spec import OFFSET, OP, PARTITION, TableSpec
from tidelog.streaming.alerts import stream_lag_alerts as alerts_stream
from tidelog.streaming.business import enriched_batch
from tidelog.streaming.micro_batch import run_micro_batches, sync_hashes, sync_store
from tidelog.streaming.pending import PendingLookups
from tidelog.streaming.progress import ProgressRecords, observed_step
from tidelog.streaming.stateful import state_rows, stateful_sync
from tidelog.streaming.stats import STATS_KEY, BatchStats
from tidelog.streaming.wakeup import lookup_wakeups

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

EVT_STORED = StructType([*EVT.values.fields, StructField(PARTITION, LongType()),
                         StructField(OFFSET, LongType())])
INDEX_KEYS = [["TAG"], ["TAG", "AMT"]]
INDEX_VALUES = ["AMT", "PROPS"]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LOAD_TIME = "2024-11-11 00:00:00"
# bytes of a row group of the files of a stream: a row group is read by one task
TOPIC_BLOCK = 8 << 20


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- change rows ---------------------------------------------------------------

@query
def changelog_parse(spark, sf_dir):
    return flatten(fx.changes(spark, sf_dir), EVT)


@query
def changelog_parse_lenient(spark, sf_dir):
    """A log with unfit values, keys and texts: what is malformed has no operation."""
    return flatten(parse_changes(fx.dirty_changes(spark, sf_dir), EVT, strict=False), EVT).filter(F.col(OP).isNotNull())


@query
def changelog_rejected(spark, sf_dir):
    """The malformed records of the same log and what is wrong with them."""
    return rejected_changes(fx.dirty_changes(spark, sf_dir), EVT).select("partition", "offset", "fault")


@query
def changelog_presence(spark, sf_dir):
    flags = presence_flags(fx.changes(spark, sf_dir), EVT)
    return flags.select("user_id", OFFSET, *[f"{c}_present" for c in EVT.columns])


@query
def tombstone_to_delete(spark, sf_dir):
    return fx.changes(spark, sf_dir).select("user_id", OP, PARTITION, OFFSET)


@query
def null_sentinel_encode(spark, sf_dir):
    return encode_nulls(fx.changes(spark, sf_dir), EVT)


@query
def null_sentinel_decode(spark, sf_dir):
    return decode_nulls(encode_nulls(fx.changes(spark, sf_dir), EVT), EVT.columns)


@query
def business_filter(spark, sf_dir):
    flat = flatten(fx.changes(spark, sf_dir), EVT)
    guard = F.coalesce(F.col("AMT"), F.lit(0)) < 100
    return flat.filter(filters.business_predicate(guard, [F.col(c) for c in EVT.columns]))


@query
def touched_filter(spark, sf_dir):
    flat = flatten(fx.changes(spark, sf_dir), EVT)
    return flat.filter(filters.touched_predicate(F.col("AMT"), F.col("AMT") >= 50))


@query
def effective_changes(spark, sf_dir):
    return flatten(filters.effective_changes(fx.changes(spark, sf_dir), EVT), EVT)


@query
def op_counts(spark, sf_dir):
    return filters.operation_counts(fx.changes(spark, sf_dir))


@query
def latest_by_key(spark, sf_dir):
    return flatten(filters.latest_by_key(fx.changes(spark, sf_dir), EVT.pk), EVT)


@query
def distinct_keys(spark, sf_dir):
    return filters.distinct_keys(fx.changes(spark, sf_dir), EVT.pk)


@query
def deleted_keys(spark, sf_dir):
    return filters.deleted_keys(fx.changes(spark, sf_dir), EVT.pk).select("user_id", PARTITION, OFFSET)


@query
def key_partition_check(spark, sf_dir):
    """Keys seen in more than one partition, of a log dealt out by offset instead of key."""
    dealt = fx.changes(spark, sf_dir).withColumn(PARTITION, (F.col(OFFSET) % fx.PARTITIONS).cast("int"))
    return split_keys(dealt, EVT.pk)


# -- fold and merge --------------------------------------------------------------

@query
def max_offset_per_partition(spark, sf_dir):
    return merge.max_offset_per_partition(fx.early_image(spark, sf_dir))


@query
def offset_gate(spark, sf_dir):
    late = filters.effective_changes(fx.late_changes(spark, sf_dir), EVT)
    return flatten(merge.offset_gate(late, fx.early_image(spark, sf_dir)), EVT)


@query
def fold_changelog(spark, sf_dir):
    return fx.image(fx.changes(spark, sf_dir))


@query
def merge_snapshot(spark, sf_dir):
    return merge.merge_snapshot(fx.early_image(spark, sf_dir), fx.late_changes(spark, sf_dir), EVT)


@query
def merge_snapshot_small_batch(spark, sf_dir):
    return merge.merge_small_batch(
        fx.early_image(spark, sf_dir), fx.late_changes(spark, sf_dir), EVT)


@query
def merge_snapshot_versioned(spark, sf_dir):
    """Seed, two deltas, a compaction, then a repeated delta."""
    store = ChangeStore(spark, work_dir(spark, "store"), EVT, buckets=8)
    store.seed(fx.early_image(spark, sf_dir))
    late = written_table(fx.late_changes(spark, sf_dir))
    store.append(late.filter(F.col(PARTITION) < 3))
    store.append(late.filter(F.col(PARTITION) >= 3))
    store.compact()
    store.append(late)
    return store.image()


@query
def change_store_reopened(spark, sf_dir):
    """The image of a store seeded, read and compacted through handles of different layouts."""
    root = work_dir(spark, "store")
    narrow, plain = (ChangeStore(spark, root, EVT, buckets=n) for n in (8, 64))
    narrow.seed(fx.early_image(spark, sf_dir))
    plain.append(written_table(fx.late_changes(spark, sf_dir)))
    before = written_table(plain.image())
    merged = plain.compact()
    plain.retire(merged)
    agreed = [before, narrow.image(), plain.rows_of(before.select(*EVT.pk))]
    return agreed[0].intersectAll(agreed[1]).intersectAll(agreed[2])


@query
def change_store_compacted(spark, sf_dir):
    """The image after three compactions, each of the buckets that its deltas touch."""
    store = ChangeStore(spark, work_dir(spark, "store"), EVT, buckets=32)
    log = written_table(fx.changes(spark, sf_dir))
    bounds = [fx.log_position(spark, sf_dir, tenths) for tenths in (0, 4, 6, 9, 10)]
    for n, (low, high) in enumerate(itertools.pairwise(bounds)):
        store.append(log.filter(F.col(OFFSET).between(low, high - 1)))
        if n < 3:
            store.retire(store.compact())
    return store.image()


@query
def change_store_changed_since(spark, sf_dir):
    """Keys changed in the last fifth of the log, deleted ones too, by the store's ranges of offsets."""
    store = ChangeStore(spark, work_dir(spark, "store"), EVT, buckets=32)
    log = written_table(fx.changes(spark, sf_dir))
    since = fx.log_position(spark, sf_dir, 8) - 1
    for low, high in ((-1, since), (since, fx.log_position(spark, sf_dir, 9)), (fx.log_position(spark, sf_dir, 9), 1 << 62)):
        store.append(log.filter((F.col(OFFSET) > low) & (F.col(OFFSET) <= high)))
        if low < since:
            store.compact()
    return store.changed_since(since).select("user_id", fold.ALIVE, OFFSET)


@query
def offset_gate_from_store(spark, sf_dir):
    """The late log gated by the zone maps of a store of a base and a delta."""
    store = ChangeStore(spark, work_dir(spark, "store"), EVT, buckets=16)
    log = written_table(fx.changes(spark, sf_dir))
    middle, end = (fx.log_position(spark, sf_dir, tenths) for tenths in (3, 6))
    store.append(log.filter(F.col(OFFSET) < middle))
    store.compact()
    store.append(log.filter(F.col(OFFSET).between(middle, end - 1)))
    late = filters.effective_changes(log.filter(F.col(OFFSET) >= fx.log_position(spark, sf_dir, 4)), EVT)
    return flatten(merge.offset_gate(late, store.applied_offsets()), EVT)


# -- keyed hashes ------------------------------------------------------------------

def _stored(spark, sf_dir):
    return hash_store.image_to_store(fx.early_image(spark, sf_dir), EVT)


def _index(spark, sf_dir):
    return hash_store.image_to_index(fx.image(fx.changes(spark, sf_dir)), EVT, ["TAG"],
                                     ["AMT", "TAG", "PROPS"])


@query
def kv_mutations(spark, sf_dir):
    return hash_store.folded_mutations(fold.fold_changes(fx.changes(spark, sf_dir), EVT), EVT)


@query
def kv_row_mutations(spark, sf_dir):
    """Field writes, field deletes and key deletes straight from table rows."""
    customer = fx.table(spark, sf_dir, "customer")
    keyed, field = ["c_nationkey"], ["c_custkey"]
    written = hash_store.hset_mutations(customer, "CUSTOMER", keyed, ["c_name"], field, True)
    fields = hash_store.hdel_mutations(customer, "CUSTOMER", keyed, ["c_mktsegment"], field)
    keys = hash_store.del_mutations(fx.table(spark, sf_dir, "orders"), "ORDERS", ["o_orderkey"])
    return written.unionByName(fields).unionByName(keys)


@query
def kv_apply(spark, sf_dir):
    image = fx.early_image(spark, sf_dir)
    gated = merge.offset_gate(fx.late_changes(spark, sf_dir), image)
    return hash_store.apply_mutations(
        hash_store.image_to_store(image, EVT), hash_store.folded_mutations(fold.fold_changes(gated, EVT), EVT))


@query
def kv_index_mutations(spark, sf_dir):
    image = fx.early_image(spark, sf_dir)
    folded = fold.fold_changes(merge.offset_gate(fx.late_changes(spark, sf_dir), image), EVT)
    touched = index_sync.touched_before_after(image, folded, EVT)
    return index_sync.index_mutations(touched, EVT, INDEX_KEYS, INDEX_VALUES)


@query
def kv_index_unpack(spark, sf_dir):
    return hash_store.index_rows(_index(spark, sf_dir), EVT, ["TAG"], EVT.values)


@query
def kv_index_lookup(spark, sf_dir):
    """All rows stored under the tag the view changes carry."""
    sensors = flatten(fx.changes(spark, sf_dir), EVT).filter(F.col("TAG") == "view")
    return hash_store.index_lookup(_index(spark, sf_dir), sensors, EVT, ["TAG"], EVT.values)


def _mixed(spark, sf_dir):
    """One store with the row hashes and two secondary hashes whose keys begin alike."""
    image = fx.image(fx.changes(spark, sf_dir))
    parts = [hash_store.image_to_store(image, EVT)]
    parts += [hash_store.image_to_index(image, EVT, key, ["AMT", "TAG", "PROPS"]) for key in INDEX_KEYS]
    return written_table(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query
def kv_decode_mixed(spark, sf_dir):
    return hash_store.decode_store(_mixed(spark, sf_dir), EVT, EVT_STORED)


@query
def kv_index_unpack_mixed(spark, sf_dir):
    return hash_store.index_rows(_mixed(spark, sf_dir), EVT, ["TAG"], EVT.values)


@query
def kv_index_apply(spark, sf_dir):
    """The secondary hash of the early image, brought up to date by field writes and deletes."""
    image = fx.early_image(spark, sf_dir)
    folded = fold.fold_changes(merge.offset_gate(fx.late_changes(spark, sf_dir), image), EVT)
    changed = index_sync.index_mutations(index_sync.touched_before_after(image, folded, EVT), EVT, [["TAG"]], INDEX_VALUES)
    return hash_store.apply_mutations(hash_store.image_to_index(image, EVT, ["TAG"], INDEX_VALUES), changed)


@query
def kv_count(spark, sf_dir):
    return hash_store.count_keys(_stored(spark, sf_dir), "EVT:")


@query
def kv_select(spark, sf_dir):
    return hash_store.first_keys(_stored(spark, sf_dir), "EVT:", 10)


@query
def kv_fields(spark, sf_dir):
    return hash_store.field_names(_stored(spark, sf_dir), "EVT:")


@query
def kv_scan(spark, sf_dir):
    return hash_store.matching(_stored(spark, sf_dir), "EVT:[1-4]*")


@query
def kv_scan_pages(spark, sf_dir):
    """All pages of a scan, seven keys each."""
    return hash_store.numbered_pages(_stored(spark, sf_dir), "EVT:", 7)


def _file_store(spark, sf_dir):
    """A keyed store in files, written through the data source: the early image, then the mutations up to now."""
    kv_source.register(spark)
    options = {"store": "tidelog.sources.kv_source:file_store", "root": work_dir(spark, "kv").removeprefix("file://"), "partitions": "4"}
    image = fx.early_image(spark, sf_dir)
    late = fx.changes(spark, sf_dir).filter(F.col(OFFSET) >= fx.log_position(spark, sf_dir, 6))
    mutations = hash_store.folded_mutations(fold.fold_changes(late, EVT), EVT)
    seed = hash_store.image_to_store(image, EVT).withColumn("op", F.lit(hash_store.SET))
    for frame in (seed, mutations):
        frame.select("rk", "field", "value", "op").write.format(kv_source.FORMAT).options(**options).mode("append").save()
    return options


@query
def kv_source_scan(spark, sf_dir):
    """The fields with a value of a range of keys, read through the data source of the keyed store."""
    rows = spark.read.format(kv_source.FORMAT).options(**_file_store(spark, sf_dir)).load()
    return rows.filter(F.col("rk").startswith("EVT:1") & (F.col("value") != NULL_TEXT))


@query
def kv_fetch(spark, sf_dir):
    """Typed rows of the hashes that the changed keys name, asked for by the executors."""
    options = _file_store(spark, sf_dir)
    keys = filters.distinct_keys(fx.change_keys(spark, sf_dir), EVT.pk)
    wanted = keys.select(hash_key(EVT.name, [F.col("user_id")]).alias("rk"))
    found = fetch_hashes(wanted, lambda: kv_source.file_store(options))
    return hash_store.decode_store(found, EVT, EVT_STORED)


@query
def kv_delete_prefix(spark, sf_dir):
    primary, index = _stored(spark, sf_dir), _index(spark, sf_dir)
    return hash_store.without_prefix(primary.unionByName(index), "EVT:TAG:")


@query
def kv_typed_decode(spark, sf_dir):
    return hash_store.decode_store(_stored(spark, sf_dir), EVT, EVT_STORED)


@query
def kv_timestamp_decode(spark, sf_dir):
    """Timestamps stored as epoch milliseconds and read back typed."""
    spec = TableSpec.of("EVENT", {"event_id": LongType()},
                        {"ts": TimestampNTZType(), "event_type": StringType()})
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    stored = hash_store.image_to_store(events, spec, with_offsets=False)
    return hash_store.decode_store(stored, spec, spec.values)


@query
def kv_lookup(spark, sf_dir):
    store = hash_store.image_to_store(fx.lagging_image(spark, sf_dir), EVT)
    return versioned_lookup.lookup_keys(fx.change_keys(spark, sf_dir), store, EVT.name, EVT.pk, EVT.values)


@query
def versioned_lookup_status(spark, sf_dir):
    store = hash_store.image_to_store(fx.lagging_image(spark, sf_dir), EVT)
    return versioned_lookup.versioned_lookup(
        fx.change_keys(spark, sf_dir), store, EVT.name, EVT.pk, EVT.values)


# -- lookups and enrichment ------------------------------------------------------------

@query
def semi_join_lookup(spark, sf_dir):
    customer = fx.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return lookup.semi_join_lookup(fx.table(spark, sf_dir, "orders"), customer,
                                   {"c_custkey": "o_custkey"},
                                   ["o_orderkey", "o_custkey", "o_orderstatus"])


@query
def multi_view_sql(spark, sf_dir):
    """Order totals per nation; orders are reduced per customer before the join."""
    read = lambda name: fx.table(spark, sf_dir, name)
    return lookup.query_with_frames(spark, """
        SELECT n.n_name, COUNT(*) AS customers, SUM(t.orders) AS orders, CAST(SUM(t.total) AS DECIMAL(38,2)) AS total
          FROM (SELECT o_custkey, COUNT(*) AS orders,
                       SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS total
                  FROM df1 WHERE o_orderstatus = 'F' GROUP BY o_custkey) t
          JOIN df2 c ON c.c_custkey = t.o_custkey
          JOIN df3 n ON n.n_nationkey = c.c_nationkey
         GROUP BY n.n_name""", read("orders"), read("customer"), read("nation"))


@query
def mapping_max(spark, sf_dir):
    return lookup.mapping_max(fx.table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")


@query
def enrich_latest(spark, sf_dir):
    changes = flatten(fx.changes(spark, sf_dir), EVT)
    customer = fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    events = fx.table(spark, sf_dir, "events").select(F.col("event_id").alias(OFFSET), "ts")
    joined = enrich.enrich_latest(changes, customer, EVT.pk).join(events, OFFSET)
    result = joined.select("user_id", OP, OFFSET, "AMT", "c_name", "c_mktsegment",
                           enrich.compact_time(F.col("ts")).alias("changed_at"))
    return enrich.with_load_time(result, LOAD_TIME, "loaded_at").withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))


@query
def case_code_projection(spark, sf_dir):
    return fx.table(spark, sf_dir, "part").select(
        "p_partkey", enrich.category_code(F.col("p_name"), "r%", "red", "other").alias("category"),
        F.lit("part").alias("kind")).distinct()


@query
def anti_join_deletes(spark, sf_dir):
    customer = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("K"))
    orders = (fx.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
              .select(F.col("o_custkey").alias("K")).distinct())
    return enrich.vanished_keys(customer, orders, ["K"])


@query
def reload_or_keep(spark, sf_dir):
    """A mapping loaded once and kept, because the second load finds nothing."""
    mapping = lookup.mapping_max(fx.table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")
    first = lookup.reload_or_keep(mapping, spark.createDataFrame([], mapping.schema), ["o_custkey"])
    return lookup.reload_or_keep(mapping.filter(F.lit(False)), first, ["o_custkey"])


# -- records ---------------------------------------------------------------------------

def _order_rows(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_day"), F.col("o_orderdate").alias("o_at"))


@query
def connect_upsert(spark, sf_dir):
    return records.connect_records(
        _order_rows(spark, sf_dir), "stage.ORDERS", ["o_orderkey"],
        ["o_orderkey", "o_orderstatus", "o_totalprice", "o_day", "o_at"])


@query
def connect_tombstone(spark, sf_dir):
    return records.connect_records(_order_rows(spark, sf_dir), "stage.ORDERS", ["o_orderkey"])


@query
def connect_value_only(spark, sf_dir):
    return records.connect_records(_order_rows(spark, sf_dir), "stage.ORDERS",
                                   value_columns=["o_orderkey", "o_day"])


@query
def json_payload(spark, sf_dir):
    flat = flatten(fx.changes(spark, sf_dir), EVT)
    rows = flat.select("user_id", OFFSET, F.col("TAG"), F.col("AMT").cast("string").alias("AMT"))
    kept = records.json_records(rows, ["user_id", OFFSET, "TAG", "AMT"], ignore_nulls=False)
    dropped = records.json_records(rows, ["user_id", OFFSET, "TAG", "AMT"], ignore_nulls=True)
    return kept.withColumn("nulls", F.lit("kept")).unionByName(dropped.withColumn("nulls", F.lit("dropped")))


# -- relational databases ------------------------------------------------------------------

def _database(spark: SparkSession) -> dict[str, str]:
    """Connection of the JDBC queries: ``spark.tidelog.jdbc.url`` and ``.driver``.

    Without these settings an in-process Derby database is used, which only local
    mode can share between tasks.
    """
    url = spark.conf.get("spark.tidelog.jdbc.url", None)
    if url:
        return {"url": url, "driver": spark.conf.get("spark.tidelog.jdbc.driver")}
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.tidelog.jdbc.url and spark.tidelog.jdbc.driver")
    name = work_dir(spark, "db").rsplit("-", 1)[1]
    return {"url": f"jdbc:derby:memory:d{name};create=true",
            "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@query
def jdbc_query_scan(spark, sf_dir):
    """Parallel read of two market segments; the condition runs in the database."""
    options = _database(spark)
    customer = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    jdbc_sink.append(customer, options, "customer", column_types="c_mktsegment VARCHAR(32)")
    names = jdbc_source.probe_schema(spark, options, "customer").fieldNames()
    scanned = jdbc_source.read_table(spark, options, "customer", '"c_custkey"', 4)
    return scanned.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(*names)


@query
def jdbc_append(spark, sf_dir):
    options = _database(spark)
    supplier = fx.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    jdbc_sink.append(supplier, options, "supplier")
    connectors = jdbc_source.Connectors({"mem": options})
    return connectors.query(spark, "mem", 'SELECT "s_nationkey", COUNT(*) AS "suppliers" '
                                          'FROM supplier GROUP BY "s_nationkey"').select(
        "s_nationkey", F.col("suppliers").cast("bigint").alias("suppliers"))


@query
def jdbc_slice_replace(spark, sf_dir):
    """The BUILDING customers are replaced by the MACHINERY ones under their code."""
    options = _database(spark)
    customer = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    jdbc_sink.append(customer, options, "segments",
                     column_types="c_mktsegment VARCHAR(32)")
    fresh = customer.filter(F.col("c_mktsegment") == "MACHINERY").withColumn(
        "c_mktsegment", F.lit("BUILDING"))
    jdbc_sink.replace_slice(spark, fresh, options, "segments", '"c_mktsegment"', ["BUILDING"])
    return jdbc_source.read_table(spark, options, "segments")


@query
def jdbc_key_lookup(spark, sf_dir):
    options = _database(spark)
    jdbc_sink.append(fx.table(spark, sf_dir, "customer"), options, "customer")
    return jdbc_source.lookup_in_database(
        spark, options, "customer", fx.table(spark, sf_dir, "supplier"),
        {"s_nationkey": '"c_nationkey"'}, ['"c_custkey"', '"c_nationkey"'], keys_per_query=10)


@query
def jdbc_key_ranges(spark, sf_dir):
    """Orders of many keys: three of ten runs of a hundred, covered by few intervals."""
    options = _database(spark)
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    jdbc_sink.append(orders, options, "orders")
    wanted = orders.filter("o_orderkey div 100 % 10 < 3").select(F.col("o_orderkey").alias("k"))
    return jdbc_source.lookup_in_database(
        spark, options, "orders", wanted, {"k": '"o_orderkey"'}, ['"o_orderkey"', '"o_orderstatus"'], keys_per_query=200, max_pushed_keys=100)


@query
def jdbc_balanced_scan(spark, sf_dir):
    """A table read by connections of equal share over a column that crowds at its low end."""
    options = _database(spark)
    skewed = F.pow(F.col("c_custkey") / 100, F.lit(3)).cast("decimal(18,4)").alias("weight")
    customer = fx.table(spark, sf_dir, "customer").select("c_custkey", skewed)
    jdbc_sink.append(customer, options, "customer")
    return jdbc_source.read_balanced(spark, options, "customer", '"weight"', 5).select("c_custkey")


@query
def jdbc_append_once(spark, sf_dir):
    """Two loads, the first one repeated."""
    options = _database(spark)
    supplier = fx.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    for load, rows in [("low", supplier.filter("s_nationkey < 12")), ("low", supplier.filter("s_nationkey < 12")),
                       ("high", supplier.filter("s_nationkey >= 12"))]:
        jdbc_sink.append_once(rows, options, "supplier", load)
    return jdbc_source.read_table(spark, options, "supplier")


@query
def jdbc_bulk_copy(spark, sf_dir):
    """A table copied to another one over parallel connections and stamped as a seed."""
    options = _database(spark)
    customer = fx.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"))
    jdbc_sink.append(customer, options, "customer")
    jdbc_sink.copy_table(spark, options, "customer", options, "seeded", split_column='"c_acctbal"', partitions=4,
                         seeded_at=LOAD_TIME)
    return jdbc_source.read_table(spark, options, "seeded").withColumn("KFK_PRDC_TS", F.col("KFK_PRDC_TS").cast("timestamp_ntz"))


@query
def initial_load_stamped(spark, sf_dir):
    customer = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return jdbc_sink.stamp_seed(customer, LOAD_TIME)


@query
def file_slice_replace(spark, sf_dir):
    """Slice replace on a partitioned file table."""
    path = work_dir(spark, "slices")
    customer = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    replace_slice_files(customer, path, "c_mktsegment")
    fresh = customer.filter(F.col("c_mktsegment") == "MACHINERY").withColumn(
        "c_mktsegment", F.lit("BUILDING"))
    replace_slice_files(fresh, path, "c_mktsegment")
    return spark.read.parquet(path)


# -- streams -----------------------------------------------------------------------------------

def _log_files(spark, raw, parts: int) -> str:
    """The raw log as files of a stream; offsets rise inside each Kafka partition.

    Row groups are small, so that the few files of a batch keep all cores busy, however long the log.
    """
    path = work_dir(spark, "topic")
    raw.repartitionByRange(parts, "offset").write.option("parquet.block.size", TOPIC_BLOCK).parquet(path)
    return path


def _stream(spark, path, files: int):
    """The files as a topic delivers its records, projected to the change columns."""
    records = file_stream(spark, path, files).selectExpr(
        "CAST(KEY AS BINARY) AS key", "CAST(VALUE AS BINARY) AS value", "topic", "partition", "offset")
    return project_raw(records)


def _ordered_topic(spark, sf_dir, tenths: list[int]) -> str:
    """The raw log as one file per part, written one after the other: batches come in the order of the log."""
    path, raw = work_dir(spark, "topic"), written_table(fx.raw_changes(spark, sf_dir))
    bounds = [fx.log_position(spark, sf_dir, n) for n in tenths]
    for low, high in itertools.pairwise(bounds):
        raw.filter(F.col("offset").between(low, high - 1)).coalesce(1).write.mode("append").parquet(path)
    return path


@query
def stream_sync_image(spark, sf_dir):
    stream = _stream(spark, _log_files(spark, fx.raw_changes(spark, sf_dir), 8), 2)
    store = ChangeStore(spark, work_dir(spark, "store"), EVT)
    sync_store(stream, EVT, store, work_dir(spark, "offsets")).awaitTermination()
    return store.image()


@query
def stream_sync_hashes(spark, sf_dir):
    """Row hashes and a secondary hash kept in step with the log: the mutations of all batches, applied."""
    target, batches = work_dir(spark, "mutations"), itertools.count()
    store = ChangeStore(spark, work_dir(spark, "store"), EVT)
    stream = _stream(spark, _ordered_topic(spark, sf_dir, [0, 3, 5, 8, 10]), 1)
    sync_hashes(stream, EVT, store, work_dir(spark, "offsets"),
                lambda m: m.withColumn("n", F.lit(next(batches))).write.mode("append").parquet(target),
                [["TAG"]], ["AMT", "TAG"], compact_every=3).awaitTermination()
    written = spark.read.parquet(target)
    content = spark.createDataFrame([], "rk string, field string, value string")
    for n in range(next(batches)):
        content = written_table(hash_store.apply_mutations(content, written.filter(F.col("n") == n).drop("n")))
    return content


@query
def stream_sync_hashes_narrow(spark, sf_dir):
    """Status of the newest changes against hashes that hold one column of the table: none is stale."""
    target, batches = work_dir(spark, "mutations"), itertools.count()
    sync_hashes(_stream(spark, _ordered_topic(spark, sf_dir, [0, 4, 7, 10]), 1), EVT, ChangeStore(spark, work_dir(spark, "store"), EVT),
                work_dir(spark, "offsets"),
                lambda m: m.withColumn("n", F.lit(next(batches))).write.mode("append").parquet(target),
                value_columns=["TAG"]).awaitTermination()
    written = spark.read.parquet(target)
    content = spark.createDataFrame([], "rk string, field string, value string")
    for n in range(next(batches)):
        content = written_table(hash_store.apply_mutations(content, written.filter(F.col("n") == n).drop("n")))
    changes = filters.effective_changes(fx.changes(spark, sf_dir), EVT)
    return versioned_lookup.versioned_lookup(changes, content, EVT.name, EVT.pk, StructType([EVT.values["TAG"]]))


@query
def stream_pending_lookups(spark, sf_dir):
    """Keys looked up in a store that lags behind: the status of what was ready, late or given up.

    Four batches a minute apart see the store of the early image, then that of the final
    one; missing keys are given up after two minutes.
    """
    clock = iter([datetime.datetime(2024, 1, 1, 0, n, tzinfo=datetime.timezone.utc) for n in range(4)])
    pending = PendingLookups(spark, work_dir(spark, "pending"), EVT.name, EVT.pk, EVT.values, 120, lambda: next(clock))
    inserts = written_table(fx.changes(spark, sf_dir).filter(F.col(OP) == "I"))
    early = hash_store.image_to_store(fx.early_image(spark, sf_dir), EVT)
    final = hash_store.image_to_store(written_table(fx.image(fx.changes(spark, sf_dir))), EVT)
    empty = inserts.limit(0)
    ready = [written_table(pending.resolve(n, changes, stored)) for n, changes, stored in [
        (0, inserts, early), (1, empty, final), (2, empty, final), (3, empty, final)]]
    rows = [r.select("user_id", F.lit(n).alias("batch"), F.lit("ready").alias("outcome")) for n, r in enumerate(ready)]
    rows.append(pending.given_up(inserts).select("user_id", F.col("n").alias("batch"), F.lit("expired").alias("outcome")))
    return reduce(DataFrame.unionByName, rows)


@contextlib.contextmanager
def _state_store(spark):
    """RocksDB as the provider of streaming state, while the block runs.

    Batches without data are switched off: where a state has timers there would be no end of them.
    """
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _collected(rows, target: str, checkpoint: str) -> None:
    """Run a stream over what is there, appending its rows with their batch number to ``target``."""
    run_micro_batches(rows, lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("append").parquet(target),
                      checkpoint).awaitTermination()


@query
def stream_keyed_state(spark, sf_dir):
    """The same image from the state store: newest emitted row per key, if alive."""
    target = work_dir(spark, "emitted")
    with _state_store(spark):
        changes = parse_changes(_stream(spark, _log_files(spark, fx.raw_changes(spark, sf_dir), 8), 4), EVT)
        _collected(stateful_sync(changes, EVT), target, work_dir(spark, "offsets"))
    emitted = filters.latest_by_key(spark.read.parquet(target), EVT.pk, F.col("batch"))
    return emitted.filter(fold.ALIVE).drop(fold.ALIVE, "batch")


@query
def stream_keyed_state_seeded(spark, sf_dir):
    """The image read back from the state itself, seeded with the early image; deleted keys are forgotten."""
    checkpoint = work_dir(spark, "offsets")
    raw = written_table(fx.raw_changes(spark, sf_dir).filter(F.col("offset") >= fx.log_position(spark, sf_dir, 6)))
    with _state_store(spark):
        changes = parse_changes(_stream(spark, _log_files(spark, raw, 4), 2), EVT)
        rows = stateful_sync(changes, EVT, image=fx.early_image(spark, sf_dir), keep_deleted=86_400)
        _collected(rows, work_dir(spark, "emitted"), checkpoint)
        state = state_rows(spark, checkpoint, EVT)
    return state.filter(fold.ALIVE).drop(fold.ALIVE)


@query
def stream_lookup_wakeup(spark, sf_dir):
    """Outcomes of the newest changes against a store that lags behind and then catches up for even keys.

    The first batch brings the changes, the next one the store's updates; what still waits then is given up.
    """
    target, changes_at, updates_at = (work_dir(spark, n) for n in ("outcomes", "changes", "updates"))
    log = written_table(filters.effective_changes(fx.changes(spark, sf_dir), EVT).select("user_id", OP, OFFSET))
    stored = lambda image: image.select("user_id", OFFSET, F.lit(False).alias("__gone"), *EVT.columns)
    seed = stored(fx.early_image(spark, sf_dir))
    final = stored(written_table(fx.image(fx.changes(spark, sf_dir)))).filter("user_id % 2 = 0")
    log.coalesce(1).write.parquet(changes_at)
    final.limit(0).write.parquet(updates_at)
    with _state_store(spark):
        stream = lambda at, like: spark.readStream.schema(like.schema).parquet(at)
        outcomes = lookup_wakeups(stream(changes_at, log), stream(updates_at, final), EVT.pk, EVT.values, seed, max_wait=0.001)
        checkpoint = work_dir(spark, "offsets")
        _collected(outcomes, target, checkpoint)
        final.coalesce(1).write.mode("append").parquet(updates_at)
        _collected(outcomes, target, checkpoint)
    return spark.read.parquet(target).drop("batch")


@query
def stream_lag_alerts(spark, sf_dir):
    """The alarms of ``lag_alerts`` raised batch by batch, with a restart in between."""
    target, path, checkpoint = (work_dir(spark, n) for n in ("alerts", "samples", "offsets"))
    samples = written_table(fx.lag_samples(spark, sf_dir).select("consumer", "sample_no", "status"))
    bounds = [fx.log_position(spark, sf_dir, tenths) for tenths in (0, 3, 5, 8, 10)]
    alerts = None
    with _state_store(spark):
        for n, (low, high) in enumerate(itertools.pairwise(bounds)):
            samples.filter(F.col("sample_no").between(low, high - 1)).coalesce(1).write.mode("append").parquet(path)
            if n % 2:
                stream = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(path)
                alerts = alerts_stream(stream)
                _collected(alerts, target, checkpoint)
    return spark.read.parquet(target).drop("batch")


@query
def stream_business_records(spark, sf_dir):
    """Records of the business job: changed BUILDING customers, tombstones for the others, with their batch."""
    target, emissions = work_dir(spark, "records"), itertools.count()
    customer = (fx.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
                .select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey"))
    on_batch = enriched_batch(
        EVT, "stage.CUSTOMER",
        select=lambda changes: filters.effective_changes(changes, EVT),
        touched=lambda changes, n: changes.select("user_id"),
        result=lambda changes, n: enrich.enrich_latest(changes, customer, EVT.pk).select(*customer.columns),
        key_columns=["user_id"], value_columns=customer.columns,
        # every batch sends its tombstones, then its upserts
        emit=lambda sent: write_record_files(sent.withColumn("batch", F.lit(next(emissions) // 2)), target))
    run_micro_batches(_stream(spark, _ordered_topic(spark, sf_dir, [0, 5, 10]), 1), on_batch, work_dir(spark, "offsets")).awaitTermination()
    return spark.read.parquet(target)


@query
def stream_business_full(spark, sf_dir):
    """The whole business job in two batches, with the number of the batch that sent each record.

    Filter, freshness-checked lookup, SQL over frames, sensor lookup, hash lookup, enrichment; tombstones before
    upserts, none for keys that still wait; rows per step.
    """
    target, emissions = work_dir(spark, "records"), itertools.count()
    stored = written_table(hash_store.image_to_store(written_table(fx.image(fx.changes(spark, sf_dir))), EVT))
    pending = PendingLookups(spark, work_dir(spark, "pending"), EVT.name, EVT.pk, EVT.values)
    customer, nation, orders = (fx.table(spark, sf_dir, n) for n in ("customer", "nation", "orders"))
    stats, like = BatchStats("BUSINESS", "full"), fx.changes(spark, sf_dir).limit(0)

    def result(changes, n):
        ready = pending.resolve(n, changes, stored)
        named = lookup.query_with_frames(spark, """
            SELECT r.user_id, n.n_name AS nation FROM df1 r JOIN df2 c ON c.c_custkey = r.user_id
              JOIN df3 n ON n.n_nationkey = c.c_nationkey""", ready, customer, nation)
        closed = lookup.semi_join_lookup(orders.filter("o_orderstatus = 'F'"), ready, {"user_id": "o_custkey"}, ["o_custkey", "o_orderkey"])
        counts = closed.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count(F.lit(1)).alias("orders"))
        hashes = versioned_lookup.lookup_keys(ready, stored, EVT.name, EVT.pk, StructType([EVT.values["TAG"]]))
        view = named.join(counts, "user_id", "left").join(hashes, "user_id").withColumn("orders", F.coalesce("orders", F.lit(0).cast("long")))
        latest = changes.select("user_id", OP, OFFSET)
        return enrich.enrich_latest(latest, view, EVT.pk).select("user_id", "nation", "orders", "TAG", OFFSET)

    def emit(records):
        n = next(emissions)
        records.withColumns({"batch": F.lit(n // 2), "part": F.lit(("tombstone", "upsert")[n % 2])}).write.mode("append").parquet(target)

    on_batch = enriched_batch(
        EVT, "stage.FULL", select=lambda changes: filters.effective_changes(changes, EVT),
        touched=lambda changes, n: changes.select("user_id"), result=result, key_columns=["user_id"],
        value_columns=["user_id", "nation", "orders", "TAG", OFFSET], emit=emit, stats=stats,
        waiting=lambda n: pending.waiting(n, like))
    run_micro_batches(_stream(spark, _ordered_topic(spark, sf_dir, [0, 5, 10]), 1), on_batch, work_dir(spark, "offsets")).awaitTermination()
    steps = stats.flush(spark).select(F.col("MSG").alias("key"), F.col("ROW_CNT").cast("string").alias("value"),
                                      F.col("EPOCH_ID").cast("int").alias("batch"), F.lit("step").alias("part"))
    return spark.read.parquet(target).unionByName(steps)


@query
def batch_stats(spark, sf_dir):
    """Rows per step over all micro-batches of the log."""
    stats = BatchStats("BATCH_STATS", "changes by step")
    target = work_dir(spark, "stats")

    def on_batch(batch, batch_id):
        read = stats.observe(batch_id, "read", parse_changes(batch, EVT))
        kept = stats.observe(batch_id, "effective", filters.effective_changes(read, EVT))
        kept.write.format("noop").mode("overwrite").save()
        stats.flush(spark).write.mode("append").parquet(target)

    stream = _stream(spark, _log_files(spark, fx.raw_changes(spark, sf_dir), 4), 2)
    run_micro_batches(stream, on_batch, work_dir(spark, "offsets")).awaitTermination()
    return spark.read.parquet(target).groupBy("APP_NAME", "MSG", "STEM_NUM").agg(
        F.sum("ROW_CNT").alias("ROW_CNT"))


@query
def stream_progress_records(spark, sf_dir):
    """Rows per step from the progress events of the stream; the batch function only writes."""
    name = f"progress-{uuid.uuid4().hex}"
    listener = ProgressRecords(name, "BATCH_STATS", "changes by step")
    read = observed_step(parse_changes(_stream(spark, _log_files(spark, fx.raw_changes(spark, sf_dir), 4), 2), EVT), 1, "read")
    kept = observed_step(filters.effective_changes(read, EVT), 2, "effective")
    spark.streams.addListener(listener)
    try:
        run_micro_batches(kept, lambda df, n: df.write.format("noop").mode("overwrite").save(), work_dir(spark, "offsets"),
                          name=name).awaitTermination()
        listener.wait()
    finally:
        spark.streams.removeListener(listener)
    return listener.flush(spark).groupBy("APP_NAME", "MSG", "STEM_NUM").agg(F.sum("ROW_CNT").alias("ROW_CNT"))


@query
def batch_stats_records(spark, sf_dir):
    """The statistics of one pass over the log as records of a topic."""
    stats = BatchStats("BATCH_STATS", "log", lambda: datetime.datetime(2024, 11, 11, tzinfo=datetime.timezone.utc))
    read = stats.observe(0, "read", fx.changes(spark, sf_dir))
    kept = stats.observe(0, "effective", filters.effective_changes(read, EVT))
    kept.write.format("noop").mode("overwrite").save()
    return records.connect_records(stats.flush(spark), "stage.STATS", STATS_KEY, [*STATS_KEY, "STEM_NUM", "MSG", "ROW_CNT"])


@query
def csv_round_trip(spark, sf_dir):
    """A table replaced as headerless CSV files and read back."""
    path = work_dir(spark, "csv")
    parts = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    write_csv(parts.limit(0), path)
    write_csv(parts, path)
    return spark.read.schema(parts.schema).csv(path)


# -- lag ---------------------------------------------------------------------------------------

@query
def offset_log_latest(spark, sf_dir):
    return lag.offset_log_entries(fx.offset_log_lines(spark, sf_dir))


@query
def offset_log_files(spark, sf_dir):
    """Newest offsets of written logs whose files are numbered 0, 9 and 10."""
    root, lines = work_dir(spark, "checkpoints"), written_table(fx.offset_files(spark, sf_dir))
    for app, n in [(r.app, r.n) for r in lines.select("app", "n").distinct().collect()]:  # three per event type
        own = lines.filter((F.col("app") == app) & (F.col("n") == n))
        own.coalesce(1).sortWithinPartitions("line").select("value").write.text(f"{root}/{app}/offsets/{n}")
    return read_offset_log(spark, root)


@query
def consumer_lag(spark, sf_dir):
    committed = lag.offset_log_entries(fx.offset_log_lines(spark, sf_dir))
    events = fx.table(spark, sf_dir, "events")
    ends = events.groupBy(
        F.concat(F.lit("t"), F.col("event_id") % 3).alias("topic"),
        (F.col("user_id") % fx.PARTITIONS).cast("int").alias("partition")).agg(
        F.max("event_id").alias("end_offset"))
    return lag.consumer_lag(committed, ends)


@query
def lag_by_topic(spark, sf_dir):
    return lag.lag_by_topic(fx.lag_samples(spark, sf_dir))


@query
def lag_alerts(spark, sf_dir):
    samples = fx.lag_samples(spark, sf_dir).select("consumer", "sample_no", "status")
    return lag.lag_alerts(samples, block=2000)
