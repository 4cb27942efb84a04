"""SQL equivalents of the registered queries, written against the given tables.

The change log is described straight from ``events`` here, without its JSON form,
and folds use windows, so that the two sides share no method.
"""

from __future__ import annotations

_CL = """cl AS (
  SELECT user_id, CAST(user_id % 6 AS INTEGER) AS ptt, event_id AS off,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
         event_type IN ('signup', 'click', 'purchase') OR (event_type = 'view' AND event_id % 2 = 0) AS amt_p,
         CASE WHEN event_type IN ('signup', 'click', 'purchase') THEN CAST(value AS DECIMAL(12,2)) END AS amt,
         event_type = 'signup' OR (event_type = 'view' AND event_id % 2 = 0) AS tag_p,
         CASE WHEN event_type = 'signup' OR (event_type = 'view' AND event_id % 2 = 0) THEN event_type END AS tag,
         event_type IN ('signup', 'purchase') AS props_p,
         CASE WHEN event_type IN ('signup', 'purchase') THEN props END AS props
    FROM events)"""
_EFFECTIVE = "(op <> 'U' OR amt_p OR tag_p OR props_p)"
_LENGTH = "(SELECT MAX(event_id) + 1 FROM events)"
_EARLY = f"off * 10 < {_LENGTH} * 6"
_LATE = f"off * 10 >= {_LENGTH} * 4"
_FLAT = ('user_id, op AS "__OP_TYPE", ptt AS KFK_PTT, off AS KFK_OFFSET, '
         "amt AS AMT, tag AS TAG, props AS PROPS")


def _fold(name: str, source: str, where: str = "TRUE") -> str:
    """CTEs computing the fold of ``source`` as ``name``: value structs, alive, reset."""
    cells = ", ".join(
        f"arg_max({{'v': {c}}}, off) FILTER ({c}_p AND op <> 'D' AND off > d) AS {c}"
        for c in ("amt", "tag", "props"))
    return f"""{name}_d AS (
  SELECT *, COALESCE(MAX(off) FILTER (op = 'D') OVER (PARTITION BY user_id), -1) AS d
    FROM {source} WHERE {_EFFECTIVE} AND ({where})),
{name} AS (
  SELECT user_id, arg_max(ptt, off) AS ptt, MAX(off) AS off,
         bool_or(op <> 'D' AND off > d) AS alive, bool_or(op = 'D') AS reset, {cells}
    FROM {name}_d GROUP BY user_id)"""


def _image(name: str, fold: str) -> str:
    return f"""{name} AS (
  SELECT user_id, amt.v AS amt, tag.v AS tag, props.v AS props, ptt, off FROM {fold} WHERE alive)"""


_IMG = ",\n".join([_CL, _fold("f0", "cl", _EARLY), _image("img", "f0")])
_NOW = ",\n".join([_CL, _fold("f1", "cl"), _image("now", "f1")])
_MX = "mx AS (SELECT ptt, MAX(off) AS mo FROM img GROUP BY ptt)"
_GATED = _MX + f""",
gated AS (SELECT cl.* FROM cl LEFT JOIN mx USING (ptt)
           WHERE {_EFFECTIVE} AND {_LATE} AND off > COALESCE(mo, -1))"""
_ROW = "user_id, amt AS AMT, tag AS TAG, props AS PROPS, ptt AS KFK_PTT, off AS KFK_OFFSET"


def _store(source: str) -> str:
    """Primary hash rows of an image CTE."""
    part = lambda name, value: (
        f"SELECT 'EVT:' || user_id AS rk, '{name}' AS field, "
        f"COALESCE(CAST({value} AS VARCHAR), 'None') AS value FROM {source}")
    return " UNION ALL ".join(part(n, v) for n, v in [
        ("AMT", "amt"), ("TAG", "tag"), ("PROPS", "props"), ("KFK_PTT", "ptt"), ("KFK_OFFSET", "off")])


def _mutations(fold: str) -> str:
    """Primary hash mutations of a fold CTE."""
    none = "CAST(NULL AS VARCHAR)"
    parts = [f"SELECT 'EVT:' || user_id AS rk, {none} AS field, {none} AS value, 'del' AS op "
             f"FROM {fold} WHERE reset"]
    for name, cell in [("AMT", "amt"), ("TAG", "tag"), ("PROPS", "props")]:
        parts.append(f"SELECT 'EVT:' || user_id, '{name}', COALESCE(CAST({cell}.v AS VARCHAR), 'None'), "
                     f"'set' FROM {fold} WHERE alive AND {cell} IS NOT NULL")
    for name, value in [("KFK_PTT", "ptt"), ("KFK_OFFSET", "off")]:
        parts.append(f"SELECT 'EVT:' || user_id, '{name}', CAST({value} AS VARCHAR), 'set' FROM {fold} "
                     "WHERE alive AND (amt IS NOT NULL OR tag IS NOT NULL OR props IS NOT NULL)")
    return " UNION ALL ".join(parts)


def _index_mutations() -> str:
    """Both secondary hashes, by comparing the image before with the rows after."""
    parts = []
    for key in (("tag",), ("tag", "amt")):
        names = ":".join(k.upper() for k in key)
        rk = lambda row: "'EVT:" + names + ":' || " + " || ':' || ".join(
            f"COALESCE(CAST({row}_{k} AS VARCHAR), 'None')" for k in key)
        for field in ("amt", "props"):
            label = f"user_id || ':{field.upper()}'"
            parts.append(f"SELECT {rk('o')} AS rk, {label} AS field, CAST(NULL AS VARCHAR) AS value, "
                         f"'hdel' AS op FROM ba WHERE had AND (NOT alive OR {rk('o')} <> {rk('n')})")
            parts.append(f"SELECT {rk('n')}, {label}, COALESCE(CAST(n_{field} AS VARCHAR), 'None'), 'set' "
                         f"FROM ba WHERE alive AND (NOT had OR reset OR {rk('o')} <> {rk('n')} OR s_{field})")
    return " UNION ALL ".join(parts)


_BEFORE_AFTER = """ba AS (
  SELECT f2.user_id, f2.alive, f2.reset, img.user_id IS NOT NULL AS had,
         img.amt AS o_amt, img.tag AS o_tag, img.props AS o_props,
         CASE WHEN f2.amt IS NOT NULL THEN f2.amt.v WHEN NOT f2.reset THEN img.amt END AS n_amt,
         CASE WHEN f2.tag IS NOT NULL THEN f2.tag.v WHEN NOT f2.reset THEN img.tag END AS n_tag,
         CASE WHEN f2.props IS NOT NULL THEN f2.props.v WHEN NOT f2.reset THEN img.props END AS n_props,
         f2.amt IS NOT NULL AS s_amt, f2.props IS NOT NULL AS s_props
    FROM f2 LEFT JOIN img USING (user_id))"""

_LAG = """lag AS (
  SELECT user_id AS consumer, event_id AS sample_no,
         CASE WHEN event_id % 50 = 0 THEN 'STALL'
              WHEN event_type IN ('error', 'click', 'view') THEN 'ERR'
              WHEN event_type = 'signup' THEN 'WARN'
              WHEN event_type = 'purchase' THEN 'OK' END AS status,
         't' || (event_id % 3) AS topic, event_id % 100 AS current_lag
    FROM events)"""

_COMMITTED = """newest AS (SELECT event_type, MAX(event_id // 500) AS n FROM events GROUP BY 1),
committed AS (
  SELECT e.event_type AS app, n AS batch, 't' || (event_id % 3) AS topic,
         CAST(user_id % 6 AS INTEGER) AS "partition", MAX(event_id) AS committed
    FROM events e JOIN newest w ON e.event_type = w.event_type AND e.event_id // 500 = w.n
   GROUP BY 1, 2, 3, 4)"""

_LAGGING = ",\n".join([_CL, _fold("f3", "cl", f"ptt < 3 OR {_EARLY}"), _image("behind", "f3")])

_KEY_SCHEMA = ('{"type":"struct","optional":false,"name":"stage.ORDERS.Key","fields":'
               '[{"field":"o_orderkey","type":"int64","optional":true}]}')
_DAY_FIELD = ('{"field":"o_day","type":"int32","optional":true,'
              '"name":"org.apache.kafka.connect.data.Date","version":1}')
_VALUE_SCHEMA = (
    '{"type":"struct","optional":false,"name":"stage.ORDERS.Value","fields":'
    '[{"field":"o_orderkey","type":"int64","optional":true},'
    '{"field":"o_orderstatus","type":"string","optional":true},'
    '{"field":"o_totalprice","type":"bytes","optional":true,'
    '"name":"org.apache.kafka.connect.data.Decimal","version":1,'
    '"parameters":{"scale":"2","connect.decimal.precision":"15"}},'
    + _DAY_FIELD + ',{"field":"o_at","type":"int64","optional":true,'
    '"name":"org.apache.kafka.connect.data.Timestamp","version":1}]}')
_SMALL_SCHEMA = ('{"type":"struct","optional":false,"name":"stage.ORDERS.Value","fields":'
                 '[{"field":"o_orderkey","type":"int64","optional":true},' + _DAY_FIELD + "]}")
_DAY = "date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))"


def _record(schema: str, payload: str) -> str:
    return "'{\"schema\":" + schema + ",\"payload\":' || " + payload + " || '}'"


_KEY = _record(_KEY_SCHEMA, "json_object('o_orderkey', o_orderkey)::VARCHAR")
_VALUE = _record(_VALUE_SCHEMA, (
    "json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus, 'o_totalprice', "
    "to_base64(unhex(format('{:016X}', CAST(CAST(o_totalprice AS DECIMAL(15,2)) * 100 AS BIGINT)))), "
    f"'o_day', {_DAY}, 'o_at', epoch_ms(o_orderdate))::VARCHAR"))
_SMALL = _record(_SMALL_SCHEMA, f"json_object('o_orderkey', o_orderkey, 'o_day', {_DAY})::VARCHAR")

_USER_FIELD = '{"field":"user_id","type":"int64","optional":true}'
_CUSTOMER_KEY = _record(
    '{"type":"struct","optional":false,"name":"stage.CUSTOMER.Key","fields":[' + _USER_FIELD + "]}",
    "json_object('user_id', user_id)::VARCHAR")
_CUSTOMER_VALUE = _record(
    '{"type":"struct","optional":false,"name":"stage.CUSTOMER.Value","fields":[' + _USER_FIELD
    + ',{"field":"c_name","type":"string","optional":true}'
    + ',{"field":"c_nationkey","type":"int64","optional":true}]}',
    "json_object('user_id', user_id, 'c_name', c_name, 'c_nationkey', c_nationkey)::VARCHAR")

_FULL_KEY = _record(
    '{"type":"struct","optional":false,"name":"stage.FULL.Key","fields":[' + _USER_FIELD + "]}",
    "json_object('user_id', user_id)::VARCHAR")
_FULL_VALUE = _record(
    '{"type":"struct","optional":false,"name":"stage.FULL.Value","fields":[' + _USER_FIELD
    + ',{"field":"nation","type":"string","optional":true},{"field":"orders","type":"int64","optional":false}'
    + ',{"field":"TAG","type":"string","optional":true},{"field":"KFK_OFFSET","type":"int64","optional":true}]}',
    "json_object('user_id', user_id, 'nation', nation, 'orders', orders, 'TAG', tag, 'KFK_OFFSET', off)::VARCHAR")

# what is wrong with the records of the log with unfit values
_DIRTY = """dirty AS (
  SELECT *, CASE WHEN off % 11 = 0 THEN 'key user_id'
                 WHEN off % 7 = 2 AND op <> 'D' THEN 'operation'
                 WHEN off % 7 IN (0, 1) AND amt IS NOT NULL THEN 'value AMT' END AS fault FROM cl)"""

_STATS_FIELDS = ('{"field":"APP_NAME","type":"string","optional":true},'
                 '{"field":"CASE_NM","type":"string","optional":true},'
                 '{"field":"EPOCH_ID","type":"int64","optional":true}')
_STATS_KEY = _record(
    '{"type":"struct","optional":false,"name":"stage.STATS.Key","fields":[' + _STATS_FIELDS + "]}",
    "json_object('APP_NAME', 'BATCH_STATS', 'CASE_NM', 'log', 'EPOCH_ID', 0)::VARCHAR")
_STATS_VALUE = _record(
    '{"type":"struct","optional":false,"name":"stage.STATS.Value","fields":[' + _STATS_FIELDS
    + ',{"field":"STEM_NUM","type":"int64","optional":true},{"field":"MSG","type":"string","optional":true}'
    + ',{"field":"ROW_CNT","type":"int64","optional":true}]}',
    "json_object('APP_NAME', 'BATCH_STATS', 'CASE_NM', 'log', 'EPOCH_ID', 0, 'STEM_NUM', n, 'MSG', msg, 'ROW_CNT', c)::VARCHAR")

_FOLDED_ROWS = f"WITH {_NOW} SELECT {_ROW} FROM now"
_MERGED_ROWS = (f"WITH {_IMG},\n{_GATED},\n{_fold('f2', 'gated')},\n{_BEFORE_AFTER}\n"
                "SELECT img.user_id, img.amt AS AMT, img.tag AS TAG, img.props AS PROPS, "
                "img.ptt AS KFK_PTT, img.off AS KFK_OFFSET FROM img "
                "WHERE user_id NOT IN (SELECT user_id FROM f2) UNION ALL "
                "SELECT ba.user_id, n_amt, n_tag, n_props, f2.ptt, f2.off "
                "FROM ba JOIN f2 USING (user_id) WHERE ba.alive")


def _tag_hash(rows: str, fields: list[str]) -> str:
    """Secondary hash by TAG of a table expression."""
    return " UNION ALL ".join(
        f"SELECT 'EVT:TAG:' || COALESCE(TAG, 'None') AS rk, user_id || ':{f}' AS field, "
        f"COALESCE(CAST({f} AS VARCHAR), 'None') AS value FROM {rows} m" for f in fields)


_ENCODED_AMT = "CASE WHEN op = 'U' AND amt_p AND amt IS NULL THEN CAST(-999999999 AS DECIMAL(12,2)) ELSE amt END"


def all_sql() -> dict[str, str]:
    found = _all_sql()
    # the streaming form of a query has the result of the batch form
    found["stream_lag_alerts"] = found["lag_alerts"]
    found["stream_progress_records"] = found["batch_stats"]
    return found


def _all_sql() -> dict[str, str]:
    cl, img, now, lagging = f"WITH {_CL} ", f"WITH {_IMG} ", f"WITH {_NOW} ", f"WITH {_LAGGING} "
    latest = "arg_max(cl, off)"
    return {
        "changelog_parse": cl + f"SELECT {_FLAT} FROM cl",
        "changelog_parse_lenient": f"WITH {_CL}, {_DIRTY} SELECT {_FLAT} FROM dirty WHERE fault IS NULL",
        "changelog_rejected": f'WITH {_CL}, {_DIRTY} SELECT ptt AS "partition", off AS "offset", fault FROM dirty WHERE fault IS NOT NULL',
        "changelog_presence": cl + 'SELECT user_id, off AS KFK_OFFSET, amt_p AS "AMT_present", '
                                   'tag_p AS "TAG_present", props_p AS "PROPS_present" FROM cl',
        "tombstone_to_delete": 'SELECT user_id, CASE event_type WHEN \'signup\' THEN \'I\' '
                               "WHEN 'error' THEN 'D' ELSE 'U' END AS \"__OP_TYPE\", "
                               "CAST(user_id % 6 AS INTEGER) AS KFK_PTT, event_id AS KFK_OFFSET FROM events",
        "null_sentinel_encode": cl + f'SELECT user_id, op AS "__OP_TYPE", ptt AS KFK_PTT, off AS KFK_OFFSET, '
                                     f"{_ENCODED_AMT} AS AMT, tag AS TAG, props AS PROPS FROM cl",
        "null_sentinel_decode": cl + f"SELECT {_FLAT} FROM cl",
        "business_filter": cl + f"SELECT {_FLAT} FROM cl WHERE COALESCE(amt, 0) < 100 AND "
                                "(amt IS NOT NULL OR tag IS NOT NULL OR props IS NOT NULL OR op = 'I')",
        "touched_filter": cl + f"SELECT {_FLAT} FROM cl WHERE (amt >= 50 AND op = 'I') OR op = 'U'",
        "effective_changes": cl + f"SELECT {_FLAT} FROM cl WHERE {_EFFECTIVE}",
        "op_counts": cl + 'SELECT op AS "__OP_TYPE", CAST(COUNT(*) AS BIGINT) AS changes FROM cl GROUP BY op',
        "latest_by_key": cl + f"SELECT {_FLAT} FROM cl QUALIFY ROW_NUMBER() OVER "
                              "(PARTITION BY user_id ORDER BY off DESC) = 1",
        "distinct_keys": "SELECT DISTINCT user_id FROM events",
        "deleted_keys": cl + "SELECT user_id, ptt AS KFK_PTT, off AS KFK_OFFSET FROM (SELECT *, "
                             "ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY off DESC) AS rn FROM cl) "
                             "WHERE rn = 1 AND op = 'D'",
        "key_partition_check": "SELECT user_id, CAST(MIN(event_id % 6) AS INTEGER) AS first_partition, "
                               "CAST(MAX(event_id % 6) AS INTEGER) AS last_partition "
                               "FROM events GROUP BY user_id HAVING MIN(event_id % 6) <> MAX(event_id % 6)",
        "max_offset_per_partition": img + "SELECT ptt AS KFK_PTT, MAX(off) AS MAX_KFK_OFFSET FROM img "
                                          "WHERE ptt IS NOT NULL GROUP BY ptt",
        "offset_gate": f"WITH {_IMG}, {_GATED} SELECT {_FLAT} FROM gated",
        "fold_changelog": _FOLDED_ROWS,
        "merge_snapshot": _MERGED_ROWS,
        "merge_snapshot_small_batch": _MERGED_ROWS,
        "merge_snapshot_versioned": _FOLDED_ROWS,
        "change_store_reopened": _FOLDED_ROWS,
        "change_store_compacted": _FOLDED_ROWS,
        "change_store_changed_since": f"WITH {_CL}, {_fold('f1', 'cl')} SELECT user_id, alive AS __alive, off AS KFK_OFFSET "
                                      f"FROM f1 WHERE off * 10 >= {_LENGTH} * 8",
        "offset_gate_from_store": f"WITH {_CL}, mx AS (SELECT ptt, MAX(off) AS mo FROM cl WHERE {_EFFECTIVE} AND {_EARLY} GROUP BY ptt) "
                                  f"SELECT {_FLAT} FROM cl LEFT JOIN mx USING (ptt) WHERE {_EFFECTIVE} AND {_LATE} AND off > COALESCE(mo, -1)",
        "kv_mutations": f"WITH {_CL}, {_fold('f1', 'cl')} {_mutations('f1')}",
        "kv_row_mutations":
            "SELECT 'CUSTOMER:' || c_nationkey AS rk, c_custkey || ':c_name' AS field, "
            "c_name AS value, 'set' AS op FROM customer WHERE c_name IS NOT NULL UNION ALL "
            "SELECT 'CUSTOMER:' || c_nationkey, c_custkey || ':c_mktsegment', NULL, 'hdel' FROM customer "
            "UNION ALL SELECT 'ORDERS:' || o_orderkey, NULL, NULL, 'del' FROM orders",
        "kv_apply": f"WITH {_IMG}, {_GATED}, {_fold('f2', 'gated')}, m AS ({_mutations('f2')}), "
                    f"s AS ({_store('img')}) "
                    "SELECT rk, field, value FROM m WHERE op = 'set' UNION ALL "
                    "SELECT rk, field, value FROM s WHERE rk NOT IN (SELECT rk FROM m WHERE op = 'del') "
                    "AND NOT EXISTS (SELECT 1 FROM m WHERE m.rk = s.rk AND m.field = s.field)",
        "kv_index_mutations": f"WITH {_IMG}, {_GATED}, {_fold('f2', 'gated')}, {_BEFORE_AFTER} "
                              + _index_mutations(),
        "kv_index_unpack": now + "SELECT 'EVT:TAG:' || COALESCE(tag, 'None') AS rk, tag AS TAG, user_id, "
                                 "amt AS AMT, props AS PROPS FROM now",
        "kv_decode_mixed": now + "SELECT user_id, amt AS AMT, tag AS TAG, props AS PROPS, "
                                 "CAST(ptt AS BIGINT) AS KFK_PTT, off AS KFK_OFFSET FROM now",
        "kv_index_unpack_mixed": now + "SELECT 'EVT:TAG:' || COALESCE(tag, 'None') AS rk, tag AS TAG, user_id, "
                                       "amt AS AMT, props AS PROPS FROM now",
        "kv_index_apply": _tag_hash(f"({_MERGED_ROWS})", ["AMT", "PROPS"]),
        "kv_index_lookup": now + "SELECT 'EVT:TAG:view' AS rk, tag AS TAG, user_id, amt AS AMT, "
                                 "props AS PROPS FROM now WHERE tag = 'view'",
        "kv_count": img + "SELECT CAST(COUNT(*) AS BIGINT) AS keys FROM img",
        "kv_select": img + f", s AS ({_store('img')}) SELECT rk, substr(rk, 5) AS PK0, field, value FROM s "
                           "WHERE rk IN (SELECT DISTINCT rk FROM s ORDER BY rk LIMIT 10)",
        "kv_fields": "SELECT unnest(['AMT', 'KFK_OFFSET', 'KFK_PTT', 'PROPS', 'TAG']) AS field",
        "kv_scan": img + f", s AS ({_store('img')}) SELECT * FROM s WHERE substr(rk, 5, 1) BETWEEN '1' AND '4'",
        "kv_scan_pages": img + f", s AS ({_store('img')}) SELECT rk, field, value, (dense_rank() OVER (ORDER BY rk) - 1) // 7 AS page FROM s",
        "kv_source_scan": now + f", s AS ({_store('now')}) SELECT * FROM s WHERE rk LIKE 'EVT:1%' AND value <> 'None'",
        "kv_fetch": now + "SELECT user_id, amt AS AMT, tag AS TAG, props AS PROPS, CAST(ptt AS BIGINT) AS KFK_PTT, off AS KFK_OFFSET FROM now",
        "kv_delete_prefix": img + _store("img"),
        "kv_typed_decode": img + "SELECT user_id, amt AS AMT, tag AS TAG, props AS PROPS, "
                                 "CAST(ptt AS BIGINT) AS KFK_PTT, off AS KFK_OFFSET FROM img",
        "kv_timestamp_decode": "SELECT event_id, date_trunc('millisecond', ts) AS ts, event_type FROM events",
        "kv_lookup": lagging + "SELECT user_id, amt AS AMT, tag AS TAG, props AS PROPS FROM behind",
        "versioned_lookup_status": lagging + f""", newest AS (
            SELECT * FROM cl QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY off DESC) = 1),
            j AS (SELECT n.user_id, n.op, n.off, b.user_id AS found, b.off AS stored, b.amt, b.tag, b.props
                    FROM newest n LEFT JOIN behind b USING (user_id) WHERE n.op <> 'D'),
            st AS (SELECT *, CASE WHEN found IS NULL THEN 'missing'
                                  WHEN op = 'U' AND stored < off THEN 'stale' ELSE 'ok' END AS status FROM j)
            SELECT user_id, op AS "__OP_TYPE", off AS KFK_OFFSET, status,
                   CASE WHEN status = 'ok' THEN amt END AS AMT, CASE WHEN status = 'ok' THEN tag END AS TAG,
                   CASE WHEN status = 'ok' THEN props END AS PROPS FROM st""",
        "semi_join_lookup": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE EXISTS (SELECT 1 "
                            "FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey = o_custkey)",
        "multi_view_sql": "SELECT n_name, CAST(COUNT(DISTINCT c_custkey) AS BIGINT) AS customers, "
                          "CAST(COUNT(*) AS BIGINT) AS orders, "
                          "SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS total FROM orders "
                          "JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey "
                          "WHERE o_orderstatus = 'F' GROUP BY n_name",
        "mapping_max": "SELECT o_custkey, MAX(o_orderkey) AS o_orderkey FROM orders "
                       "WHERE o_custkey IS NOT NULL GROUP BY o_custkey",
        "enrich_latest": cl + """SELECT l.user_id, l.op AS "__OP_TYPE", l.off AS KFK_OFFSET, l.amt AS AMT,
            c_name, c_mktsegment, strftime(e.ts, '%Y%m%d%H%M%S') AS changed_at,
            TIMESTAMP '2024-11-11 00:00:00' AS loaded_at FROM (SELECT * FROM cl QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY off DESC) = 1) l
            JOIN customer ON c_custkey = l.user_id JOIN events e ON e.event_id = l.off""",
        "case_code_projection": "SELECT DISTINCT p_partkey, CASE WHEN p_name LIKE 'r%' THEN 'red' "
                                "ELSE 'other' END AS category, 'part' AS kind FROM part",
        "anti_join_deletes": "SELECT DISTINCT c_custkey AS K FROM customer WHERE NOT EXISTS (SELECT 1 "
                             "FROM orders WHERE o_orderstatus = 'P' AND o_custkey = c_custkey)",
        "reload_or_keep": "SELECT o_custkey, MAX(o_orderkey) AS o_orderkey FROM orders "
                          "WHERE o_custkey IS NOT NULL GROUP BY o_custkey",
        "connect_upsert": f"SELECT {_KEY} AS key, {_VALUE} AS value FROM orders",
        "connect_tombstone": f"SELECT {_KEY} AS key, CAST(NULL AS VARCHAR) AS value FROM orders",
        "connect_value_only": f"SELECT {_SMALL} AS value FROM orders",
        "json_payload": cl + """SELECT json_object('user_id', user_id, 'KFK_OFFSET', off, 'TAG', tag,
            'AMT', CAST(amt AS VARCHAR))::VARCHAR AS value, 'kept' AS nulls FROM cl UNION ALL
            SELECT '{"user_id":' || user_id || ',"KFK_OFFSET":' || off
                   || CASE WHEN tag IS NULL THEN '' ELSE ',"TAG":"' || tag || '"' END
                   || CASE WHEN amt IS NULL THEN '' ELSE ',"AMT":"' || amt || '"' END || '}',
                   'dropped' FROM cl""",
        "jdbc_query_scan": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer "
                           "WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
        "jdbc_append": "SELECT s_nationkey, CAST(COUNT(*) AS BIGINT) AS suppliers FROM supplier GROUP BY 1",
        "jdbc_slice_replace": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING' "
                              "UNION ALL SELECT c_custkey, 'BUILDING' FROM customer "
                              "WHERE c_mktsegment = 'MACHINERY'",
        "jdbc_key_lookup": "SELECT c_custkey, c_nationkey FROM customer "
                           "WHERE c_nationkey IN (SELECT s_nationkey FROM supplier)",
        "jdbc_key_ranges": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey // 100 % 10 < 3",
        "jdbc_balanced_scan": "SELECT c_custkey FROM customer",
        "jdbc_append_once": "SELECT s_suppkey, s_nationkey FROM supplier",
        "jdbc_bulk_copy": "SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, "
                          "CAST(-1 AS INTEGER) AS KFK_PTT, CAST(-1 AS BIGINT) AS KFK_OFFSET, "
                          "TIMESTAMP '2024-11-11 00:00:00' AS KFK_PRDC_TS FROM customer",
        "initial_load_stamped": "SELECT c_custkey, c_name, CAST(-1 AS INTEGER) AS KFK_PTT, "
                                "CAST(-1 AS BIGINT) AS KFK_OFFSET, "
                                "TIMESTAMP '2024-11-11 00:00:00' AS KFK_PRDC_TS FROM customer",
        "file_slice_replace": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING' "
                              "UNION ALL SELECT c_custkey, 'BUILDING' FROM customer "
                              "WHERE c_mktsegment = 'MACHINERY'",
        "stream_sync_image": _FOLDED_ROWS,
        "stream_keyed_state": _FOLDED_ROWS,
        "stream_keyed_state_seeded": _FOLDED_ROWS,
        "stream_lookup_wakeup": f"""WITH early AS ({img} SELECT user_id, off FROM img),
            final AS ({now} SELECT * FROM now),
            asked AS (SELECT user_id, arg_max(op, off) AS op, MAX(off) AS off FROM ({cl} SELECT * FROM cl WHERE {_EFFECTIVE}) GROUP BY user_id),
            judged AS (
              SELECT a.*, CASE WHEN op = 'I' AND e.user_id IS NOT NULL OR e.off >= a.off THEN 'ok'
                               WHEN f.user_id IS NOT NULL AND a.user_id % 2 = 0 THEN 'late'
                               WHEN e.user_id IS NULL THEN 'expired' ELSE 'stale' END AS outcome
                FROM asked a LEFT JOIN early e USING (user_id) LEFT JOIN final f USING (user_id) WHERE op <> 'D'),
            held AS ({img} SELECT * FROM img)
            SELECT j.user_id, j.op AS "__OP_TYPE", j.off AS KFK_OFFSET, outcome,
                   CASE outcome WHEN 'ok' THEN h.amt WHEN 'late' THEN f.amt END AS AMT,
                   CASE outcome WHEN 'ok' THEN h.tag WHEN 'late' THEN f.tag END AS TAG,
                   CASE outcome WHEN 'ok' THEN h.props WHEN 'late' THEN f.props END AS PROPS
              FROM judged j LEFT JOIN held h USING (user_id) LEFT JOIN final f USING (user_id)""",
        "stream_sync_hashes_narrow": now + f""", newest AS (SELECT * FROM cl WHERE {_EFFECTIVE}
                QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY off DESC) = 1)
            SELECT n.user_id, n.op AS "__OP_TYPE", n.off AS KFK_OFFSET, 'ok' AS status, now.tag AS TAG
              FROM newest n JOIN now USING (user_id) WHERE n.op <> 'D'""",
        "stream_sync_hashes": "SELECT rk, field, value FROM (" + now + _store("now") + ") WHERE field <> 'PROPS' AND NOT (field = 'TAG' AND value = 'None') "
                              "UNION ALL " + _tag_hash(f"({_FOLDED_ROWS})", ["AMT", "TAG"]),
        "stream_pending_lookups": f"""WITH early AS ({img} SELECT user_id FROM img),
            final AS ({now} SELECT user_id FROM now),
            asked AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup')
            SELECT user_id, CAST(CASE WHEN user_id IN (FROM early) THEN 0 WHEN user_id IN (FROM final) THEN 1 ELSE 2 END AS INTEGER) AS batch,
                   CASE WHEN user_id IN (FROM early) OR user_id IN (FROM final) THEN 'ready' ELSE 'expired' END AS outcome
              FROM asked""",
        "stream_business_records": cl + f"""SELECT {_CUSTOMER_KEY} AS key,
            CASE WHEN c_custkey IS NOT NULL THEN {_CUSTOMER_VALUE} END AS value, batch
            FROM (SELECT DISTINCT user_id, CAST(CASE WHEN off * 10 < {_LENGTH} * 5 THEN 0 ELSE 1 END AS INTEGER) AS batch FROM cl WHERE {_EFFECTIVE}) t
            LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON c_custkey = user_id""",
        "stream_business_full": now + f""", b AS (
              SELECT *, CAST(CASE WHEN off * 10 < {_LENGTH} * 5 THEN 0 ELSE 1 END AS INTEGER) AS batch FROM cl WHERE {_EFFECTIVE}),
            n AS (SELECT * FROM b QUALIFY ROW_NUMBER() OVER (PARTITION BY batch, user_id ORDER BY off DESC) = 1),
            counted AS (SELECT o_custkey, COUNT(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
            view AS (SELECT now.user_id, now.tag, n_name AS nation, COALESCE(orders, 0) AS orders FROM now JOIN customer ON c_custkey = now.user_id
                     JOIN nation ON n_nationkey = c_nationkey LEFT JOIN counted ON o_custkey = now.user_id),
            sent AS (SELECT n.batch, n.off, view.* FROM n JOIN view USING (user_id) WHERE op <> 'D')
            SELECT {_FULL_KEY} AS key, {_FULL_VALUE} AS value, batch, 'upsert' AS part FROM sent UNION ALL
            SELECT {_FULL_KEY}, NULL, batch, 'tombstone' FROM n WHERE op = 'D'
                OR (user_id IN (SELECT user_id FROM now) AND user_id NOT IN (SELECT user_id FROM view)) UNION ALL
            SELECT 'changes', CAST(COUNT(*) AS VARCHAR), batch, 'step' FROM b GROUP BY batch UNION ALL
            SELECT 'rows sent', CAST((SELECT COUNT(*) FROM sent s WHERE s.batch = x.batch) AS VARCHAR), batch, 'step' FROM (SELECT DISTINCT batch FROM b) x""",
        "batch_stats": cl + f"""SELECT 'BATCH_STATS' AS APP_NAME, 'read' AS MSG, CAST(1 AS INTEGER) AS STEM_NUM,
            CAST(COUNT(*) AS BIGINT) AS ROW_CNT FROM cl UNION ALL
            SELECT 'BATCH_STATS', 'effective', 2, CAST(COUNT(*) AS BIGINT) FROM cl WHERE {_EFFECTIVE}""",
        "batch_stats_records": cl + f"""SELECT {_STATS_KEY} AS key, {_STATS_VALUE} AS value FROM (
            SELECT 1 AS n, 'read' AS msg, COUNT(*) AS c FROM cl UNION ALL
            SELECT 2, 'effective', COUNT(*) FROM cl WHERE {_EFFECTIVE})""",
        "csv_round_trip": "SELECT p_partkey, p_name, p_size FROM part",
        "offset_log_files": """SELECT event_type AS app, CAST(10 AS BIGINT) AS batch, 't' || (event_id % 3) AS topic,
            CAST(user_id % 6 AS INTEGER) AS "partition", MAX(event_id) AS committed FROM events GROUP BY 1, 3, 4""",
        "offset_log_latest": f"WITH {_COMMITTED} SELECT * FROM committed",
        "consumer_lag": f"WITH {_COMMITTED}, " + """ends AS (
            SELECT 't' || (event_id % 3) AS topic, CAST(user_id % 6 AS INTEGER) AS "partition",
                   MAX(event_id) AS end_offset FROM events GROUP BY 1, 2)
            SELECT app, topic, "partition", committed, end_offset,
                   CASE WHEN end_offset IS NOT NULL THEN greatest(end_offset - coalesce(committed, 0), 0) END AS lag
              FROM (SELECT app, topic, "partition", committed FROM committed) FULL JOIN
                   (SELECT app, topic, "partition", end_offset
                      FROM ends LEFT JOIN (SELECT DISTINCT app, topic FROM committed) USING (topic))
                   USING (app, topic, "partition")""",
        "lag_by_topic": f"WITH {_LAG} " + """SELECT consumer, topic, FALSE AS is_total,
            CAST(SUM(current_lag) AS BIGINT) AS lag FROM lag GROUP BY 1, 2 UNION ALL
            SELECT consumer, NULL, TRUE, CAST(SUM(current_lag) AS BIGINT) FROM lag GROUP BY 1""",
        "lag_alerts": f"WITH {_LAG}, " + """c AS (
            SELECT *, CASE WHEN status IS DISTINCT FROM LAG(status) OVER w THEN 1 ELSE 0 END AS chg,
                   ROW_NUMBER() OVER w AS rn FROM lag WINDOW w AS (PARTITION BY consumer ORDER BY sample_no)),
            g AS (SELECT *, SUM(chg) OVER (PARTITION BY consumer ORDER BY sample_no) AS grp FROM c),
            r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY consumer, grp ORDER BY sample_no) AS run FROM g)
            SELECT consumer, sample_no, status, run,
                   CASE status WHEN 'ERR' THEN 'committed offset does not advance'
                               WHEN 'WARN' THEN 'committed offset advances but lag keeps growing'
                               ELSE 'status needs a check' END AS status_text,
                   CASE WHEN run = 1 THEN 'first occurrence' WHEN run < 60 THEN run || 'm elapsed'
                        ELSE (run // 60) || 'h ' || (run % 60) || 'm elapsed' END AS elapsed
              FROM r WHERE status <> 'OK' AND (run = 1 OR run % 5 = 0)""",
    }
