"""Expected results as SQL over the base tables.

No JSON is involved here: the statements repeat the arithmetic of the derived
logs (FIXTURES.md), so they check the engine independently of its parser.
"""

from __future__ import annotations

# One row per record of the order log, with what must become of it.
_LOG = """
WITH base AS (
  SELECT o_orderkey AS k, epoch_us(o_orderdate) // 1000 AS t0,
         lpad(lower(to_hex(o_orderkey)), 24, '0') AS oid,
         'cust-' || o_custkey AS customer, 'city-' || (o_orderkey % 50) AS city, o_totalprice AS total,
         CASE (o_orderkey // 3) % 3 WHEN 0 THEN 'PAID' WHEN 1 THEN 'SHIPPED' ELSE 'CANCELLED' END AS paid,
         CASE WHEN o_orderkey % 97 = 0 THEN 97 WHEN o_orderkey % 89 = 0 THEN 89 WHEN o_orderkey % 83 = 0 THEN 83
              WHEN o_orderkey % 79 = 0 THEN 79 WHEN o_orderkey % 73 = 0 THEN 73 WHEN o_orderkey % 71 = 0 THEN 71
              WHEN o_orderkey % 67 = 0 THEN 67 WHEN o_orderkey % 61 = 0 THEN 61 WHEN o_orderkey % 59 = 0 THEN 59
         END AS odd
  FROM orders
), log AS (
  SELECT *, 0 AS slot, t0 AS ts, CASE WHEN k % 5 = 0 THEN 'r' ELSE 'c' END AS op,
         'PENDING' AS status, total AS amount, city AS town FROM base
  UNION ALL SELECT *, 1, t0 + 60000, 'u', paid, total, city FROM base WHERE k % 3 = 0
  UNION ALL SELECT *, 2, t0 + 30000, 'u', 'PAID', NULL, NULL FROM base WHERE k % 7 = 0
  UNION ALL SELECT *, 3, t0 + 180000, 'd', NULL, NULL, NULL FROM base WHERE k % 10 = 0
  UNION ALL SELECT *, 4, t0 + 180000, 'tombstone', NULL, NULL, NULL FROM base WHERE k % 10 = 0
  UNION ALL SELECT *, 5, t0 + 240000, 'c', 'PENDING', total, city FROM base WHERE k % 20 = 0
  UNION ALL SELECT *, 6, t0 + 300000, CASE WHEN odd IN (89, 73, 71, 67) THEN 'u' ELSE 'unknown' END,
         'SHIPPED', total, city FROM base WHERE odd IS NOT NULL
), ev AS (
  SELECT *, k * 8 + slot AS "offset", CAST(k % 4 AS INTEGER) AS part,
         ts + (k * 7) % 200 - CASE WHEN k % 50 = 0 THEN 220 ELSE 0 END AS kafka_ms,
         CASE WHEN slot <> 6 THEN 0 ELSE k % 5 END AS retries,
         CASE WHEN slot <> 6 OR odd IN (83, 67) THEN NULL
              WHEN odd IN (97, 61, 59) THEN 'Malformed Debezium envelope'
              WHEN odd IN (89, 79) THEN 'schema_validation_failed'
              WHEN odd = 73 THEN 'Malformed ''after'' JSON string'
              ELSE 'transform_failed: total' END AS error,
         CASE WHEN slot = 4 THEN 'skipped_tombstone' WHEN slot = 3 THEN 'delete'
              WHEN slot <> 6 OR odd = 67 THEN 'upsert' WHEN odd = 83 THEN 'skipped_no_route' ELSE 'dlq' END AS disposition,
         '{"id":"{\\"$oid\\":\\"' || oid || '\\"}"}' AS record_key,
         '{"_id":{"$oid":"' || oid || '"},' AS doc_id, '"status":"SHIPPED","city":"' || city || '","total":' AS doc_rest,
         CASE odd WHEN 97 THEN 'not-valid-json'
                  WHEN 89 THEN '{"op":"u","ts_ms":' || ts || ',"after":' || '"' || replace(doc_id || doc_rest || total || '}', '"', '\\"') || '"' || ',"source":{}}'
                  WHEN 79 THEN '{"op":"x","ts_ms":' || ts || ',"after":' || 'null,"source":{}}'
                  WHEN 73 THEN '{"op":"u","ts_ms":' || ts || ',"after":' || '"' || replace('{"_id": tru', '"', '\\"') || '"' || ',"source":{}}'
                  WHEN 71 THEN '{"op":"u","ts_ms":' || ts || ',"after":' || '"' || replace(doc_id || '"customer_id":"' || customer || '",' || doc_rest || '"abc"}', '"', '\\"') || '"' || ',"source":{}}'
                  WHEN 61 THEN '{"op":"c"} trailing' WHEN 59 THEN '[1]' END AS payload
  FROM log
), delivered AS (
  SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE slot = 0 AND k % 53 = 0
), applied AS (
  SELECT * FROM ev WHERE disposition IN ('upsert', 'delete')
), ranked AS (
  SELECT *, max(CASE WHEN disposition = 'delete' THEN slot ELSE -1 END) OVER (PARTITION BY k) AS gone,
         max(slot) OVER (PARTITION BY k) AS last_slot
  FROM applied
), final AS (
  SELECT oid AS order_id, max(CASE WHEN slot = last_slot THEN customer END) AS customer_id,
         max(CASE WHEN slot = last_slot THEN status END) AS status,
         max(CASE WHEN slot = last_slot THEN town END) AS city,
         max(CASE WHEN slot = last_slot THEN amount END) AS total,
         max(CASE WHEN slot = last_slot THEN ts END) AS updated_ms,
         max(CASE WHEN slot = last_slot THEN kafka_ms END) AS updated_kafka_ms,
         max(last_slot + k * 8) AS last_offset,
         min_by(ts, slot) FILTER (WHERE slot > gone) AS created_ms
  FROM ranked GROUP BY k, oid HAVING max(last_slot) <> max(gone)
)
"""

_ORDERS_FLAT = """
SELECT order_id, customer_id, status, city, total, created_ms AS created_at_ms, updated_ms AS updated_at_ms FROM final
"""

# The metric rows derived from the event table.
_METRICS = """
WITH raw AS (
  SELECT event_id AS n, epoch_us(ts) // 1000 AS mongo, event_type, props, ts,
         epoch_us(ts) // 1000 + (event_id * 7) % 200 - CASE WHEN event_id % 50 = 0 THEN 220 ELSE 0 END AS kafka
  FROM events
), timed AS (
  SELECT *, kafka + (n * 13) % 500 AS recv, kafka + (n * 13) % 500 + (n * 3) % 100 AS stored FROM raw
), metrics AS (
  SELECT 'doc-' || n AS doc_id, event_type AS collection,
         CASE n % 4 WHEN 0 THEN 'c' WHEN 1 THEN 'u' WHEN 2 THEN 'd' ELSE 'r' END AS operation,
         CAST(octet_length(encode(props)) AS INTEGER) AS doc_size_bytes,
         mongo AS mongo_ts_ms, kafka AS kafka_ts_ms, recv AS consumer_recv_ms, stored AS pg_stored_ms,
         greatest(0, kafka - mongo) AS debezium_lat_ms,
         greatest(0, recv - kafka) AS consumer_lat_ms,
         greatest(0, stored - recv) AS write_lat_ms,
         greatest(0, stored - mongo) AS e2e_lat_ms,
         ts AS recorded_at, epoch_us(ts) // 1000 AS recorded_at_ms,
         'poc.mydb.' || event_type AS topic, CAST(n % 4 AS INTEGER) AS part, n
  FROM timed WHERE mongo > 0 AND kafka > 0
)
"""

_KPIS = """
SELECT count(*) AS total_docs,
       coalesce(round(avg(e2e_lat_ms)), 0.0) AS avg_e2e_ms,
       coalesce(round_even(percentile_cont(0.50) WITHIN GROUP (ORDER BY e2e_lat_ms), 0), 0.0) AS p50_ms,
       coalesce(round_even(percentile_cont(0.95) WITHIN GROUP (ORDER BY e2e_lat_ms), 0), 0.0) AS p95_ms,
       coalesce(round_even(percentile_cont(0.99) WITHIN GROUP (ORDER BY e2e_lat_ms), 0), 0.0) AS p99_ms,
       coalesce(round(avg(doc_size_bytes)), 0.0) AS avg_bytes,
       coalesce(round(avg(debezium_lat_ms)), 0.0) AS avg_deb_ms,
       coalesce(round(avg(consumer_lat_ms)), 0.0) AS avg_con_ms,
       coalesce(round(avg(write_lat_ms)), 0.0) AS avg_wrt_ms,
       count(*) FILTER (WHERE recorded_at > as_of - INTERVAL 5 MINUTE) AS tput_5m,
       count(*) FILTER (WHERE recorded_at > as_of - INTERVAL 1 MINUTE) AS tput_1m
"""

# Offset positions and lag.
_OFFSETS = """
, positions AS (
  SELECT 'poc.mydb.orders' AS topic, part AS "partition", min("offset") AS low, max("offset") + 1 AS high,
         max("offset") + 1 - part * 25 AS committed FROM ev GROUP BY part
  UNION ALL SELECT 'poc.mydb.products', 0, min(p_partkey), max(p_partkey) + 1, max(p_partkey) + 1 FROM part
  UNION ALL SELECT 'poc.mydb.customers', 0, min(c_custkey), max(c_custkey) + 1, NULL FROM customer
), lags AS (
  SELECT topic, CAST("partition" AS INTEGER) AS "partition", greatest(coalesce(committed, 0), 0) AS committed, high,
         greatest(0, high - greatest(coalesce(committed, 0), 0)) AS lag FROM positions
)
"""

# Orders and products together.
_ALL = """
, everything AS (
  SELECT 'orders' AS collection, op, disposition, error FROM delivered
  UNION ALL SELECT 'products', 'c', CASE WHEN p_partkey % 11 = 0 THEN 'dlq' ELSE 'skipped_no_route' END,
         CASE WHEN p_partkey % 11 = 0 THEN 'schema_validation_failed' END FROM part
)
"""

_ITEMS = """
WITH doc AS (
  SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS line, min(l_partkey) AS p1, max(l_partkey) AS p2,
         min(l_quantity) AS q1, max(l_quantity) AS q2, min(l_extendedprice) AS u1, max(l_extendedprice) AS u2
  FROM lineitem GROUP BY 1, 2
), alive AS (
  SELECT *, lpad(lower(to_hex(k)), 24, '0') || '-' || line AS order_id FROM doc WHERE NOT (k % 10 = 0 AND line = 1)
), line_items AS (
  SELECT order_id, 'sku-' || p1 AS sku, CAST(q1 AS DOUBLE) AS qty, u1 AS unit_price FROM alive
  UNION ALL SELECT order_id, 'sku-' || p2, CAST(q2 AS DOUBLE), u2 FROM alive WHERE line % 2 = 0
)
"""

_METRIC_COLUMNS = (
    "doc_id, collection, operation, doc_size_bytes, mongo_ts_ms, kafka_ts_ms, consumer_recv_ms, pg_stored_ms, "
    "debezium_lat_ms, consumer_lat_ms, write_lat_ms, e2e_lat_ms, recorded_at_ms"
)
_NEWEST = "recorded_at DESC, topic DESC, part DESC, n DESC"


def _clock(column: str) -> str:
    return f"strftime(make_timestamp({column} * 1000), '%H:%M:%S.%g')"


def all_expected() -> dict[str, str]:
    flat = _LOG + _ORDERS_FLAT
    failed_at = (
        "strftime(make_timestamp(kafka_ms * 1000), '%Y-%m-%dT%H:%M:%S') || "
        "CASE WHEN kafka_ms % 1000 = 0 THEN '' ELSE '.' || lpad(CAST((kafka_ms % 1000) * 1000 AS VARCHAR), 6, '0') END || '+00:00'"
    )
    return {
        # merge
        "orders_flat_final": flat,
        "merge_two_batches": flat,
        "merge_interleaved_batches": flat,
        "orders_by_source_time": _LOG
        + """
, timed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, "offset") AS pos FROM applied
), marked AS (
  SELECT *, max(CASE WHEN disposition = 'delete' THEN pos ELSE 0 END) OVER (PARTITION BY k) AS gone_pos,
         max(pos) OVER (PARTITION BY k) AS last_pos FROM timed
)
SELECT oid AS order_id, max(CASE WHEN pos = last_pos THEN customer END) AS customer_id,
       max(CASE WHEN pos = last_pos THEN status END) AS status, max(CASE WHEN pos = last_pos THEN town END) AS city,
       max(CASE WHEN pos = last_pos THEN amount END) AS total, min(ts) FILTER (WHERE pos > gone_pos) AS created_at_ms,
       max(ts) AS updated_at_ms
FROM marked GROUP BY k, oid HAVING max(last_pos) <> max(gone_pos)
""",
        "stream_orders_flat": flat,
        "transactions_final": _LOG
        + "SELECT order_id, 'txn-' || order_id AS txn_id, total AS amount, status, updated_ms AS recorded_at_ms FROM final",
        "line_items_final": _ITEMS + "SELECT * FROM line_items",
        "target_lookup": flat
        + "WHERE order_id IN (SELECT lpad(lower(to_hex(n)), 24, '0') FROM (VALUES (1), (2), (3), (7), (10), (20), (33), (67), (97), (134)) AS v(n))",
        "target_rows_of_customers": flat
        + """
WHERE order_id IN (
  SELECT lpad(lower(to_hex(o_orderkey)), 24, '0') FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')
""",
        "stream_transactions": _LOG
        + "SELECT order_id, 'txn-' || order_id AS txn_id, total AS amount, status, updated_ms AS recorded_at_ms FROM final",
        "stream_two_collections": _LOG
        + """
SELECT 'orders' AS collection, order_id AS key, status AS label, total AS amount, updated_ms AS changed_ms FROM final
UNION ALL SELECT 'customers', lpad(lower(to_hex(c_custkey)), 24, '0'), lpad(lower(to_hex(c_custkey)), 24, '0') || '/' || c_name,
       CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE c_acctbal END,
       1704067200000 + c_custkey * 1000 + CASE WHEN c_custkey % 3 = 0 THEN 60000 ELSE 0 END
FROM customer WHERE c_custkey % 10 <> 0
""",
        "extreme_values": """
SELECT lpad(lower(to_hex(c_custkey)), 24, '0') AS doc_id, CASE WHEN n < 2 THEN 'dlq' ELSE 'upsert' END AS disposition,
       CASE WHEN n < 2 THEN 'transform_failed: ts_ms' END AS error,
       CASE n WHEN 2 THEN 9223372036854775 WHEN 3 THEN -9223372036854775 WHEN 4 THEN 1704067200000 WHEN 5 THEN 1704067200000 END AS updated_at_ms,
       CASE n WHEN 2 THEN 1.0::DOUBLE WHEN 3 THEN 1.0 WHEN 4 THEN 2.5 WHEN 5 THEN 3000000000.0 END AS qty
FROM (SELECT *, c_custkey % 6 AS n FROM customer)
""",
        # parsing, validation, routing
        "parsed_event_counts": _LOG + _ALL + "SELECT collection, op, count(*) AS n FROM everything GROUP BY 1, 2",
        "disposition_counts": _LOG + _ALL + "SELECT disposition, count(*) AS n FROM everything GROUP BY 1",
        "rejection_reasons": _LOG
        + _ALL
        + "SELECT collection, error, count(*) AS n FROM everything WHERE disposition = 'dlq' GROUP BY 1, 2",
        "drift_fields": _LOG
        + """
SELECT 'orders' AS collection, oid AS doc_id, f AS field, CASE f WHEN 'loyalty' THEN '7' ELSE 'web' END AS value
FROM ev CROSS JOIN (VALUES ('loyalty'), ('source_app')) AS names(f) WHERE slot = 6 AND odd = 67
""",
        "drift_metadata": _LOG
        + """
SELECT oid AS doc_id, "offset", '{"loyalty":7,"source_app":"web"}' AS metadata FROM ev WHERE slot = 6 AND odd = 67
""",
        "routed_rows": _LOG
        + """
SELECT db_target, tbl AS "table", disposition = 'delete' AS is_delete, count(*) AS n
FROM delivered CROSS JOIN (VALUES ('analytics', 'orders_flat'), ('finance', 'transactions')) AS t(db_target, tbl)
WHERE disposition IN ('upsert', 'delete') GROUP BY ALL
""",
        "delete_keys": _LOG
        + """
SELECT op, oid AS doc_id, "offset", CASE WHEN op = 'd' THEN ts ELSE 0 END AS ts_ms FROM ev WHERE slot IN (3, 4)
""",
        "coerced_types": _LOG
        + """
SELECT "offset", oid AS doc_id, customer AS customer_id, amount AS total, ts AS event_ms, kafka_ms AS kafka_ts_ms
FROM ev WHERE disposition = 'upsert'
""",
        "product_rules": """
SELECT CAST(p_partkey AS VARCHAR) AS doc_id,
       CASE WHEN p_partkey % 11 = 0 THEN 'dlq' ELSE 'skipped_no_route' END AS disposition,
       CASE WHEN p_partkey % 11 = 0 THEN 'price' ELSE '' END AS missing
FROM part
""",
        # quarantine
        "dlq_records": _LOG
        + f"""
SELECT 'poc.mydb.orders' AS source_topic, part AS source_partition, "offset" AS source_offset, error,
       CAST(retries AS INTEGER) AS retry_count, {failed_at} AS failed_at,
       CASE WHEN retries >= 3 THEN 'dead' ELSE 'dlq' END AS destination, record_key AS raw_key, payload AS raw_value
FROM ev WHERE disposition = 'dlq'
""",
        "retry_routing": _LOG
        + """
SELECT CASE WHEN retries >= 3 THEN 'dead' ELSE 'dlq' END AS destination, CAST(retries AS INTEGER) AS retry_count,
       count(*) AS n FROM ev WHERE disposition = 'dlq' GROUP BY 1, 2
""",
        "replay_plan": _LOG
        + """
SELECT part AS "partition", "offset", CASE WHEN retries + 1 > 3 THEN 'dead' ELSE 'replayed' END AS action,
       CAST(retries + 1 AS INTEGER) AS retry_count, 'poc.mydb.orders' AS topic, record_key AS key, payload AS raw_value,
       CAST(retries + 1 AS VARCHAR) AS retry_header
FROM ev WHERE disposition = 'dlq'
""",
        "replay_counts": _LOG
        + """
SELECT CASE WHEN retries + 1 > 3 THEN 'dead' ELSE 'replayed' END AS action, count(*) AS n
FROM ev WHERE disposition = 'dlq' GROUP BY 1
""",
        "replay_first_50": _LOG
        + """
SELECT part AS "partition", "offset", CASE WHEN retries + 1 > 3 THEN 'dead' ELSE 'replayed' END AS action
FROM ev WHERE disposition = 'dlq' ORDER BY part, "offset" LIMIT 50
""",
        "replay_odd_messages": """
SELECT CAST(c_custkey % 3 AS INTEGER) AS "partition", c_custkey AS "offset",
       CASE WHEN n = 5 THEN 'dead' WHEN n = 6 THEN 'replayed' ELSE 'skipped' END AS action,
       CAST(CASE WHEN n = 5 THEN 4 WHEN n <> 4 THEN 1 END AS INTEGER) AS retry_count,
       CASE WHEN n > 1 THEN 'v' || c_custkey ELSE '' END AS raw_value
FROM (SELECT *, c_custkey % 7 AS n FROM customer)
""",
        "stream_dlq_replay": _LOG
        + """
SELECT 'replayed' AS action, CAST(count(*) AS BIGINT) AS n FROM ev WHERE disposition = 'dlq' AND retries < 3
""",
        "stream_replay_until_dead": _LOG
        + """
SELECT record_key AS raw_key, CASE WHEN mended THEN 'written' ELSE 'dead' END AS outcome,
       CAST(CASE WHEN mended THEN retries + 1 ELSE greatest(retries, 3) END AS INTEGER) AS retry_count,
       CASE WHEN NOT mended THEN error END AS error, CASE WHEN mended THEN 'SHIPPED' END AS status
FROM (SELECT *, odd = 89 AND retries < 3 AS mended FROM ev WHERE disposition = 'dlq')
""",
        # metrics
        "stage_latencies": _METRICS + f"SELECT {_METRIC_COLUMNS} FROM metrics",
        "kpi_summary": _METRICS + _KPIS + "FROM metrics, (SELECT max(recorded_at) AS as_of FROM metrics)",
        "kpi_incremental": _METRICS + _KPIS + "FROM metrics, (SELECT max(recorded_at) AS as_of FROM metrics)",
        "kpi_empty": _METRICS
        + _KPIS
        + "FROM metrics, (SELECT max(recorded_at) AS as_of FROM metrics) WHERE recorded_at > as_of",
        "throughput_windows": _METRICS
        + """
SELECT count(*) FILTER (WHERE recorded_at > as_of - INTERVAL 5 MINUTE) AS tput_5m,
       count(*) FILTER (WHERE recorded_at > as_of - INTERVAL 1 MINUTE) AS tput_1m
FROM metrics, (SELECT max(recorded_at) AS as_of FROM metrics)
""",
        "throughput_per_minute": _METRICS
        + "SELECT (epoch_us(recorded_at) // 60000000) * 60000 AS minute_ms, count(*) AS n FROM metrics GROUP BY 1",
        "latency_last_100": _METRICS
        + f"""
SELECT recorded_at_ms, e2e_lat_ms, debezium_lat_ms, consumer_lat_ms, write_lat_ms FROM metrics ORDER BY {_NEWEST} LIMIT 100
""",
        "recent_20": _METRICS
        + f"""
SELECT doc_id, collection, operation AS op, doc_size_bytes AS bytes, {_clock('mongo_ts_ms')} AS mongo_time,
       {_clock('kafka_ts_ms')} AS kafka_time, {_clock('consumer_recv_ms')} AS consumer_time,
       {_clock('pg_stored_ms')} AS pg_time, debezium_lat_ms AS deb_ms, consumer_lat_ms AS con_ms,
       write_lat_ms AS wrt_ms, e2e_lat_ms AS e2e_ms
FROM metrics ORDER BY {_NEWEST} LIMIT 20
""",
        # offsets, lag and queue
        "log_positions": _LOG
        + _OFFSETS
        + """
SELECT topic, CAST("partition" AS INTEGER) AS "partition", low, high FROM positions WHERE topic <> 'poc.mydb.customers'
""",
        "lag_by_partition": _LOG + _OFFSETS + "SELECT * FROM lags ORDER BY topic, 2",
        "lag_rollup": _LOG
        + _OFFSETS
        + """
SELECT topic, "partition", CAST(sum(lag) AS BIGINT) AS lag,
       CASE WHEN grouping(topic) = 1 THEN 'total' WHEN grouping("partition") = 1 THEN 'topic' ELSE 'partition' END AS level
FROM lags GROUP BY ROLLUP (topic, "partition")
""",
        "lag_alert": _LOG
        + _OFFSETS
        + "SELECT topic, CAST(sum(lag) AS BIGINT) AS lag FROM lags GROUP BY topic HAVING sum(lag) > 149",
        "topic_progress": _LOG
        + _OFFSETS
        + """
SELECT topic, CAST(sum(high) AS BIGINT) AS produced, CAST(sum(committed) AS BIGINT) AS committed,
       CAST(sum(lag) AS BIGINT) AS lag,
       least(1.0, CASE WHEN sum(high) > 0 THEN sum(committed)::DOUBLE / sum(high)::DOUBLE ELSE 1.0 END) AS consumed,
       CASE WHEN sum(lag) = 0 THEN 'caught_up' WHEN sum(lag) < 50 THEN 'few' ELSE 'many' END AS severity
FROM lags GROUP BY topic
""",
        "queue_status": _LOG
        + _OFFSETS
        + _METRICS.replace("WITH raw", ", raw", 1)
        + """
, q AS (SELECT CAST(sum(high) AS BIGINT) AS produced, CAST(sum(committed) AS BIGINT) AS committed,
               CAST(sum(lag) AS BIGINT) AS pending FROM lags),
  w AS (SELECT count(*) AS written,
               count(*) FILTER (WHERE recorded_at > (SELECT max(recorded_at) FROM metrics) - INTERVAL 1 MINUTE) AS tput_1m
        FROM metrics)
SELECT produced, committed, written, greatest(0, committed - written) AS skipped, pending, tput_1m,
       CASE WHEN pending > 0 AND tput_1m > 0 THEN pending * 60.0::DOUBLE / tput_1m END AS eta_seconds
FROM q, w
""",
        "catch_up_eta": _LOG
        + _OFFSETS
        + _METRICS.replace("WITH raw", ", raw", 1)
        + """
, r AS (SELECT count(*) FILTER (WHERE recorded_at > (SELECT max(recorded_at) FROM metrics) - INTERVAL 5 MINUTE) / 5.0::DOUBLE
        AS rate FROM metrics),
  t AS (SELECT topic, CAST(sum(lag) AS BIGINT) AS lag FROM lags GROUP BY topic)
SELECT topic, lag, CASE WHEN lag > 0 AND rate > 0 THEN lag * 60.0::DOUBLE / rate END AS eta_seconds FROM t, r
""",
        "topic_list": "SELECT * FROM (VALUES ('poc.mydb.orders'), ('poc.mydb.products')) AS t(topic) "
        "WHERE EXISTS (SELECT 1 FROM orders) AND EXISTS (SELECT 1 FROM part)",
        "stale_topics": _LOG
        + """
, seen AS (
  SELECT 'poc.mydb.orders' AS topic, max(kafka_ms) AS last_at_ms FROM ev
  UNION ALL SELECT 'poc.mydb.products', max(1704067200000 + p_partkey * 1000) FROM part
)
SELECT topic, last_at_ms FROM seen WHERE last_at_ms < (SELECT max(last_at_ms) FROM seen) - 300000
""",
        "reset_offsets": _LOG
        + _OFFSETS
        + """
, parts AS (
  SELECT topic, '{' || string_agg('"' || "partition" || '":' || committed, ',' ORDER BY CAST("partition" AS VARCHAR)) || '}' AS m
  FROM lags GROUP BY topic
)
SELECT '{' || string_agg('"' || topic || '":' || m, ',' ORDER BY topic) || '}' AS starting_offsets FROM parts
""",
        "offset_audit": _LOG
        + """
SELECT '2024-01-01T00:00:00.123000+00:00' AS ts, 'poc-pipeline-consumer' AS group_id, 'poc.mydb.orders' AS topic,
       part AS "partition", max("offset") + 1 AS committed FROM ev GROUP BY part
""",
        "pipeline_counters": _LOG
        + _OFFSETS
        + _METRICS.replace("WITH raw", ", raw", 1)
        + """
SELECT (SELECT count(*) FROM delivered) AS consumed,
       (SELECT count(*) FROM delivered WHERE disposition IN ('upsert', 'delete')) AS written,
       (SELECT count(*) FROM ev WHERE disposition = 'dlq') AS rejected,
       (SELECT max(lag) FROM lags) AS max_lag, (SELECT round(avg(e2e_lat_ms)) FROM metrics) AS avg_e2e_ms
""",
        "stream_lag": _LOG
        + """
SELECT 'poc.mydb.orders' AS topic, part AS "partition", max("offset") FILTER (WHERE slot <= 3) + 1 AS committed, max("offset") + 1 AS high,
       max("offset") - max("offset") FILTER (WHERE slot <= 3) AS lag
FROM ev GROUP BY part
""",
        "stream_reset": _LOG
        + """
, ends AS (SELECT part, min("offset") AS low, max("offset") + 1 AS high FROM ev GROUP BY part),
  middle AS (SELECT (min("offset") + max("offset")) // 2 AS m FROM ev),
  starts AS (
  SELECT 'earliest' AS position, part, low AS start, high FROM ends
  UNION ALL SELECT 'middle', part, m, high FROM ends, middle
  UNION ALL SELECT 'latest', part, high, high FROM ends
), reads AS (
  SELECT position, count("offset") AS consumed FROM starts LEFT JOIN delivered ON delivered.part = starts.part AND "offset" >= start GROUP BY 1
)
SELECT position, part AS "partition", start, greatest(start, high) AS committed, consumed FROM starts JOIN reads USING (position)
""",
        "stream_deduplicated": _LOG + "SELECT disposition, count(*) AS n FROM ev GROUP BY 1",
        "stream_stale_topics": _LOG
        + """
, seen AS (
  SELECT 'poc.mydb.orders' AS topic, max(kafka_ms) AS last_at_ms FROM ev
  UNION ALL SELECT 'poc.mydb.products', max(1704067200000 + p_partkey * 1000) FROM part
)
SELECT topic, last_at_ms FROM seen WHERE last_at_ms < (SELECT max(last_at_ms) FROM seen) - 300000
""",
        "stream_drift": _LOG
        + """
SELECT 'orders' AS collection, oid AS doc_id, f AS field, CASE f WHEN 'loyalty' THEN '7' ELSE 'web' END AS value
FROM ev CROSS JOIN (VALUES ('loyalty'), ('source_app')) AS names(f) WHERE slot = 6 AND odd = 67
""",
        "drift_types": _LOG
        + """
SELECT 'orders' AS collection, f AS field, count(*) AS n, t AS type, min(ts) AS first_ms, max(ts) AS last_ms
FROM ev CROSS JOIN (VALUES ('loyalty', 'BIGINT'), ('source_app', 'STRING')) AS names(f, t) WHERE slot = 6 AND odd = 67 GROUP BY f, t
""",
        # verification
        "count_parity": _LOG
        + "SELECT count(*) AS source_rows, count(*) AS target_rows, CAST(0 AS BIGINT) AS diff, true AS passed FROM final",
        "key_parity": _LOG
        + """
SELECT order_id, 'source' AS only_in FROM final WHERE last_offset // 8 % 101 = 0
UNION ALL SELECT 'extra-' || order_id, 'target' FROM final WHERE last_offset // 8 % 103 = 0
""",
        "insert_visible": _LOG
        + """
SELECT count(*) AS written, count(*) AS in_analytics, count(*) AS in_finance,
       count(*) FILTER (WHERE greatest(0, updated_kafka_ms + (last_offset * 37) % 2500 - updated_ms) < 2000) AS within_limit
FROM final
""",
        "update_propagated": _LOG
        + "SELECT count(*) AS checked, count(*) AS equal, CAST(0 AS BIGINT) AS different FROM final",
        "delete_propagated": _LOG
        + """
SELECT count(DISTINCT k) AS deleted, CAST(0 AS BIGINT) AS left_in_analytics, CAST(0 AS BIGINT) AS left_in_finance
FROM ranked WHERE last_slot = gone
""",
        "duplicate_records": """
SELECT 'poc.mydb.orders' AS topic, CAST(o_orderkey % 4 AS INTEGER) AS "partition", o_orderkey * 8 AS "offset",
       CAST(2 AS BIGINT) AS n FROM orders WHERE o_orderkey % 53 = 0
""",
        "duplicate_keys": _LOG + """
SELECT order_id, CAST(CASE WHEN last_offset // 8 % 107 = 0 THEN 3 ELSE 2 END AS BIGINT) AS n
FROM final WHERE last_offset // 8 % 101 = 0 OR last_offset // 8 % 107 = 0
""",
        "table_counts": _LOG
        + _ITEMS.replace("WITH doc", ", doc", 1)
        + """
SELECT 'analytics.orders_flat' AS "table", count(*) AS n FROM final
UNION ALL SELECT 'finance.transactions', count(*) FROM final
UNION ALL SELECT 'analytics.line_items', count(*) FROM line_items
""",
    }
