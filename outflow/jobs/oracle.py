"""DuckDB SQL for the same results."""

from __future__ import annotations

from outflow.jobs.fixtures import LINE_ORDER, NOW, OUTBOX_EXPRESSIONS

LOG = f"""li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem),
rw AS (SELECT o_orderkey AS okey, o_orderstatus AS st, rn, CASE l_returnflag WHEN 'A' THEN 'UPDATE_ROWS' ELSE 'WRITE_ROWS' END AS etype,
  CASE l_linestatus WHEN 'O' THEN 'outbox' ELSE 'order_items' END AS tname, 'items.' || l_returnflag || '.' || l_linestatus AS subject,
  'p' || l_partkey || ':s' || l_suppkey AS payload, CASE WHEN rn % 2 = 0 THEN '{{"X-Line":"' || rn || '"}}' END AS headers,
  CASE WHEN rn % 5 = 0 THEN 'm' || l_orderkey || '-' || rn END AS message_id, CASE WHEN rn % 3 > 0 THEN rn * 10 END AS ttl_seconds
  FROM li JOIN orders ON l_orderkey = o_orderkey),
ev AS (SELECT *, min(rn) OVER (PARTITION BY okey, etype, tname) AS first_rn, row_number() OVER (PARTITION BY okey, etype, tname ORDER BY rn) - 1 AS row_idx FROM rw),
lg AS (SELECT *, 'src' || (okey % 4) AS source_id, 'bin.' || lpad(CAST(okey // 1000 + 1 AS VARCHAR), 6, '0') AS log_file,
  (okey % 1000) * 100 + 4 + first_rn AS log_pos, okey * 100 + first_rn AS event_seq, okey * 100 + rn AS id, (okey % 1000) * 100 + 103 AS commit_pos,
  octet_length(encode(subject)) + octet_length(encode(payload)) + coalesce(octet_length(encode(headers)), 0) + coalesce(octet_length(encode(message_id)), 0) + CASE WHEN ttl_seconds IS NOT NULL THEN 4 ELSE 0 END AS n_bytes FROM ev),
tm AS (SELECT o_orderkey AS okey, 'src' || (o_orderkey % 4) AS source_id, 'bin.' || lpad(CAST(o_orderkey // 1000 + 1 AS VARCHAR), 6, '0') AS log_file,
  (o_orderkey % 1000) * 100 + 103 AS log_pos, o_orderkey * 100 + 99 AS event_seq, CASE o_orderstatus WHEN 'F' THEN 'XID' ELSE 'QUERY' END AS etype,
  CASE o_orderstatus WHEN 'P' THEN ' commit ' WHEN 'O' THEN 'ROLLBACK' END AS query, CASE o_orderstatus WHEN 'O' THEN 'rolled_back' ELSE 'committed' END AS outcome,
  row_number() OVER (PARTITION BY o_orderkey % 4, o_orderkey // 1000 ORDER BY o_orderkey) - 1 AS tx FROM orders WHERE o_orderkey % 1000 < 996),
ends AS (SELECT source_id, log_file, count(*) AS n FROM tm GROUP BY ALL),
evs AS (SELECT okey, source_id, log_file, log_pos, event_seq, etype AS event_type, CAST(NULL AS VARCHAR) AS query, tname AS table_name, count(*) AS n_rows FROM lg GROUP BY ALL
  UNION ALL SELECT okey, source_id, log_file, log_pos, event_seq, etype, query, NULL, 0 FROM tm),
msg AS (SELECT lg.*, CAST(row_idx AS BIGINT) AS ri FROM lg WHERE etype = 'WRITE_ROWS' AND tname = 'outbox' AND okey % 1000 < 996 AND st <> 'O'),
txs AS (SELECT coalesce(tm.source_id, r.source_id) AS source_id, coalesce(tm.log_file, r.log_file) AS log_file, coalesce(tm.tx, r.tx) AS tx, coalesce(tm.outcome, 'open') AS outcome,
  coalesce(r.n, 0) AS n_rows, coalesce(r.b, 0) AS n_bytes, tm.log_pos AS end_pos
  FROM tm FULL JOIN (SELECT lg.source_id, lg.log_file, coalesce(tm.tx, e.n) AS tx, count(*) FILTER (WHERE lg.etype = 'WRITE_ROWS' AND tname = 'outbox') AS n, CAST(coalesce(sum(n_bytes) FILTER (WHERE lg.etype = 'WRITE_ROWS' AND tname = 'outbox'), 0) AS BIGINT) AS b
    FROM lg LEFT JOIN tm ON lg.okey = tm.okey LEFT JOIN ends e ON e.source_id = lg.source_id AND e.log_file = lg.log_file GROUP BY ALL) r
  ON tm.source_id = r.source_id AND tm.log_file = r.log_file AND tm.tx = r.tx)"""

EVENTS = "SELECT source_id, log_file, log_pos, event_seq, event_type, query, table_name, n_rows FROM evs"
MESSAGES = "SELECT source_id, log_file, commit_pos, log_pos, ri AS row_idx, id, subject, payload, headers, message_id, CAST(ttl_seconds AS BIGINT) AS ttl_seconds FROM msg"

OUTBOX = f"""ob AS (SELECT event_id + 1 AS id, {', '.join(f'{e} AS {n}' for n, e in OUTBOX_EXPRESSIONS.items())}, props AS payload, ts AS created_at FROM events),
hk AS (SELECT id, headers, unnest(json_keys(headers)) AS name FROM ob WHERE headers IS NOT NULL AND json_type(headers) = 'OBJECT'),
hv AS (SELECT id, name, json_extract(headers, '$."' || name || '"') AS val FROM hk),
he AS (SELECT id, name, val, CASE WHEN name = '' OR regexp_matches(name, '[:\\r\\n]') THEN 'header name is invalid: ' || name WHEN lower(name) LIKE 'nats-%' THEN 'header is reserved: ' || name
  WHEN json_type(val) NOT IN ('VARCHAR', 'NULL', 'ARRAY') OR (json_type(val) = 'ARRAY' AND len([x for x in CAST(val AS JSON[]) if json_type(x) NOT IN ('VARCHAR', 'NULL')]) > 0) THEN 'header value is not text: ' || name END AS error FROM hv),
hm AS (SELECT id, arg_min(error, name) FILTER (WHERE error IS NOT NULL) AS error FROM he GROUP BY id),
ck AS (SELECT ob.*, CASE WHEN subject = '' THEN 'subject is empty' WHEN regexp_matches(subject, '[ \\t\\r\\n*>]') THEN 'subject is not concrete' WHEN contains(subject, '..') THEN 'subject has an empty token' END AS se,
  hm.error AS hd, CASE WHEN ttl_seconds = 0 THEN 'ttl must be above zero' END AS te,
  CASE WHEN regexp_matches(subject, '^events\\.error\\.[^.]+$') THEN 'AUDIT' WHEN regexp_matches(subject, '^events\\..+$') THEN 'EVENTS' WHEN regexp_matches(subject, '^[^.]+\\.purchase\\..+$') THEN 'SHOP' END AS stream
  FROM ob LEFT JOIN hm ON ob.id = hm.id),
att AS (SELECT *, 'outbox row ' || id || ': ' || coalesce(se, hd, te, CASE WHEN stream IS NULL THEN 'no stream covers the subject' END) AS error FROM ck)"""

ATTEMPTS = """ap AS (SELECT 'c' || (user_id % 5) AS consumer, event_id + 1 AS id, ts, event_type <> 'error' AS ok,
  CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'no stream covers subject' ELSE 'timeout' END END AS error,
  event_id % 7 = 0 AS was_retry, event_type = 'error' AND event_id % 7 <> 0 AS first_failure, 'events.' || event_type AS subject FROM events),
cps AS (SELECT DISTINCT 'c' || (user_id % 5) AS consumer, TIMESTAMP '""" + NOW + """' - to_hours(CAST((user_id % 5) * 10 AS INTEGER)) AS updated_at FROM events),
fl AS (SELECT consumer, CASE WHEN consumer = 'c0' THEN 0 ELSE greatest(count(*) FILTER (WHERE first_failure) - count(*) FILTER (WHERE ok AND was_retry), 1) END AS n_failed FROM ap GROUP BY consumer),
cn AS (SELECT ap.consumer, count(*) FILTER (WHERE ok) AS published, count(*) FILTER (WHERE NOT ok) AS publish_errors, count(*) FILTER (WHERE ok AND was_retry) AS retry_successes, max(ts) FILTER (WHERE ok) AS last_published,
  max(cps.updated_at) AS last_checkpoint FROM ap LEFT JOIN cps ON ap.consumer = cps.consumer GROUP BY ap.consumer),
wn AS (SELECT consumer, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) FILTER (WHERE ok) AS published, count(*) FILTER (WHERE NOT ok) AS publish_errors, count(*) FILTER (WHERE ok AND was_retry) AS retry_successes FROM ap GROUP BY ALL)"""

GTIDS = """isl AS (SELECT uuid, gno - row_number() OVER (PARTITION BY uuid ORDER BY gno) AS g, gno FROM (SELECT DISTINCT 'u' || (user_id % 3) AS uuid, event_id + 1 AS gno FROM events WHERE value > 20))"""

RECOVERY = """us AS (SELECT DISTINCT user_id AS u FROM events),
ju AS (SELECT 'k' || u AS consumer_name, u, u % 4 AS s, u % 4 < 2 AS gtid_on, u % 7 IN (2, 3, 4, 5) AS has_gtid, u * 13 % 400 AS pos,
  CASE u % 3 WHEN 0 THEN 200 WHEN 1 THEN 300 END AS size, u % 7 <> 3 AS known, NOT (u % 7 = 4 AND u % 4 = 0) AS whole FROM us WHERE u % 11 <> 0),
jd AS (SELECT *, CASE WHEN has_gtid THEN known AND whole ELSE coalesce(pos >= 4 AND pos <= size, false) END AS available,
  CASE WHEN has_gtid AND gtid_on AND NOT known THEN 'checkpoint holds transactions the server has not executed' END AS error FROM ju)"""

AT = f"TIMESTAMP '{NOW}'"
OPEN = "SELECT source_id, log_file, log_pos, e_n AS tx, id FROM (SELECT lg.*, e.n AS e_n FROM lg JOIN ends e USING (source_id, log_file) WHERE okey % 1000 >= 996 AND etype = 'WRITE_ROWS' AND tname = 'outbox')"
DECODED = """dd AS (SELECT event_id, props, event_type,
  CASE WHEN event_id % 79 = 3 THEN 'row has too few values' WHEN event_id % 89 = 11 OR (event_id % 71 = 0 AND event_id > 0) OR event_id % 73 = 1 THEN 'id is not an unsigned number' WHEN event_id = 0 THEN 'id is zero'
    WHEN event_id % 61 = 5 AND event_id % 83 <> 7 THEN 'subject is null' WHEN event_id % 67 = 5 THEN 'payload is null' WHEN event_id % 83 = 7 THEN 'subject is not UTF-8' WHEN event_id % 53 = 0 THEN 'ttl is out of range' WHEN event_id % 59 = 0 THEN 'ttl is not an unsigned number' END AS decode_error FROM events)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


#: Messages of the log whose orders of status F that divide by three are payloads.
MIXED = """mx AS (SELECT source_id, log_file, commit_pos, commit_pos AS log_pos, CAST(row_number() OVER (PARTITION BY okey ORDER BY event_seq, row_idx) - 1 AS BIGINT) AS row_idx,
  id, subject, payload, headers, message_id, ttl_seconds, okey FROM msg WHERE st = 'F' AND okey % 3 = 0
  UNION ALL SELECT source_id, log_file, commit_pos, log_pos, ri, id, subject, payload, headers, message_id, ttl_seconds, okey FROM msg WHERE NOT (st = 'F' AND okey % 3 = 0))"""

#: The relay's log numbers the ids of each source by itself.
OWN_IDS = MIXED + """,
my AS (SELECT *, okey // 4 * 100 + id % 100 AS rid FROM mx)"""

#: The relay's clock is the order's number in seconds; a checkpoint without rows waits ten.
RELAYED = (
    "WITH RECURSIVE "
    + LOG
    + ",\n"
    + OWN_IDS
    + """,
te AS (SELECT tm.source_id, tm.okey, tm.okey AS sec, tm.log_file, tm.log_pos AS pos, coalesce(n, 0) > 0 AS has_rows FROM tm LEFT JOIN (SELECT okey, count(*) AS n FROM msg GROUP BY okey) m ON tm.okey = m.okey
  UNION ALL SELECT source_id, n * 1000 - 1, n * 1000 - 1, 'bin.' || lpad(CAST(n + 1 AS VARCHAR), 6, '0'), 4, false FROM (SELECT DISTINCT 'src' || (o_orderkey % 4) AS source_id, o_orderkey // 1000 + 1 AS n FROM orders WHERE o_orderkey % 4 < 2 AND o_orderkey % 1000 < 996)),
s AS (SELECT source_id, max(sec) FILTER (WHERE has_rows) AS cur FROM te GROUP BY source_id
  UNION ALL SELECT s.source_id, min(te.sec) FROM s JOIN te ON te.source_id = s.source_id AND te.sec >= s.cur + 10 GROUP BY s.source_id),
z AS (SELECT source_id, max(cur) AS sec FROM s GROUP BY source_id),
gs AS (SELECT te.source_id AS uuid, z.source_id, te.okey // 4 + 1 AS gno FROM te JOIN z ON te.source_id = z.source_id AND te.sec <= z.sec WHERE te.source_id IN ('src0', 'src1') AND te.okey % 1000 < 996
  UNION SELECT 'src0', 'src0', unnest([1, 2, 3]) UNION SELECT 'other', 'src1', 5),
gi AS (SELECT uuid, source_id, gno, gno - row_number() OVER (PARTITION BY uuid ORDER BY gno) AS g FROM gs),
gn AS (SELECT uuid, source_id, min(gno) AS a, max(gno) AS b FROM gi GROUP BY uuid, source_id, g),
gp AS (SELECT source_id, uuid || ':' || string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END, ':' ORDER BY a) AS server, uuid FROM gn GROUP BY source_id, uuid),
gx AS (SELECT source_id, string_agg(server, ',' ORDER BY server) AS gtid_set FROM gp GROUP BY source_id)
SELECT 'message' AS part, coalesce(message_id, 'relay/' || source_id || ':app:outbox:' || rid) AS name, commit_pos AS value, subject AS note FROM my WHERE subject LIKE 'items.N.%'
UNION ALL SELECT 'outbox', source_id || ':' || rid, 1, 'outbox row ' || rid || ': no stream covers the subject' FROM my WHERE subject NOT LIKE 'items.N.%'
UNION ALL SELECT 'checkpoint', 'main/' || z.source_id, te.pos, concat_ws(' ', te.log_file, gx.gtid_set) FROM z JOIN te ON te.source_id = z.source_id AND te.sec = z.sec LEFT JOIN gx ON gx.source_id = z.source_id"""
)

KEPT = f"SELECT id, CASE WHEN error IS NULL THEN attempt_count ELSE attempt_count + 1 END AS attempt_count, CASE WHEN error IS NOT NULL THEN {AT} END AS last_attempt_at, error AS last_error FROM att"

ORACLE_SQL = {
    "t4_committed_rows": _with(LOG, MESSAGES),
    "t10_stream_committed_rows": _with(LOG + ",\n" + MIXED, "SELECT source_id, log_file, commit_pos, log_pos, row_idx, id, subject, payload, headers, message_id, CAST(ttl_seconds AS BIGINT) AS ttl_seconds FROM mx"),
    "s1_read_outbox": _with(OUTBOX, "SELECT id, subject, payload, headers, message_id, ttl_seconds, attempt_count FROM ob"),
    "s2_read_change_log": _with(LOG, EVENTS),
    "s3_stream_change_log": _with(LOG, EVENTS),
    "s4_to_envelope": _with(
        LOG,
        """SELECT subject AS topic, coalesce(message_id, 'relay:app:outbox:' || id) AS key, payload AS value,
  concat_ws(';', CASE WHEN rn % 2 = 0 THEN 'X-Line=' || rn END, 'Nats-Msg-Id=' || coalesce(message_id, 'relay:app:outbox:' || id), CASE WHEN ttl_seconds IS NOT NULL THEN 'Nats-TTL=' || ttl_seconds || 's' END) AS headers FROM msg""",
    ),
    "s5_write_messages": _with(LOG, "SELECT source_id, log_file, commit_pos, log_pos, ri AS row_idx, coalesce(message_id, 'relay:app:outbox:' || id) AS key, subject AS topic FROM msg"),
    "s6_write_state": _with(
        OUTBOX,
        """SELECT 'outbox' AS part, CAST(id AS VARCHAR) AS name, attempt_count + CASE WHEN attempt_count > 0 THEN 1 ELSE 0 END AS value FROM att WHERE attempt_count = 0 OR error IS NOT NULL
UNION ALL SELECT DISTINCT 'checkpoint', 'c' || (user_id % 5), 4 FROM events""",
    ),
    "d1_filter_table": _with(LOG, EVENTS + " WHERE table_name IS NULL OR table_name = 'outbox'"),
    "d2_filter_inserts": _with(LOG, EVENTS + " WHERE event_type <> 'UPDATE_ROWS'"),
    "d3_explode_rows": _with(LOG, "SELECT source_id, log_file, log_pos, CAST(row_idx AS BIGINT) AS row_idx, id FROM lg WHERE etype = 'WRITE_ROWS' AND tname = 'outbox'"),
    "d4_explode_payload": _with(LOG, "SELECT source_id, log_file, commit_pos AS log_pos, CAST(row_number() OVER (PARTITION BY okey ORDER BY event_seq, row_idx) - 1 AS BIGINT) AS row_idx, id FROM lg WHERE st = 'F' AND okey % 1000 < 996 AND etype = 'WRITE_ROWS' AND tname = 'outbox'"),
    "d5_decode_rows": _with(
        DECODED,
        """SELECT event_id, decode_error, CASE WHEN decode_error IS NULL THEN event_id END AS id, CASE WHEN decode_error IS NULL THEN 'events.' || event_type END AS subject, CASE WHEN decode_error IS NULL THEN props END AS payload,
  CASE WHEN decode_error IS NULL AND event_id % 4 > 0 THEN event_id % 600 END AS ttl_seconds FROM dd""",
    ),
    "d6_quarantine": _with(DECODED, "SELECT event_id, decode_error FROM dd"),
    "d7_add_managed_columns": _with(OUTBOX, "SELECT id, subject, CAST(NULL AS BIGINT) AS ttl_seconds, CAST(0 AS BIGINT) AS attempt_count, CAST(NULL AS VARCHAR) AS last_error FROM ob"),
    "t1_carry_log_file": _with(LOG, "SELECT source_id, event_seq, event_type, log_file FROM evs"),
    "t2_assign_transactions": _with(LOG, "SELECT evs.source_id, evs.log_file, evs.log_pos, event_type, table_name, coalesce(tm.tx, e.n) AS tx FROM evs LEFT JOIN tm ON evs.okey = tm.okey LEFT JOIN ends e ON e.source_id = evs.source_id AND e.log_file = evs.log_file"),
    "t3_transaction_outcomes": _with(LOG, "SELECT * FROM txs WHERE outcome <> 'open' OR n_rows > 0"),
    "t5_open_rows": _with(LOG, OPEN + " WHERE source_id IN ('src2', 'src3')"),
    "t6_commit_order": _with(LOG, "SELECT source_id, log_file, id, row_number() OVER (PARTITION BY source_id, log_file ORDER BY commit_pos, log_pos, event_seq, row_idx) AS publish_no FROM msg"),
    "t7_message_size": _with(OUTBOX, "SELECT id, octet_length(encode(subject)) + octet_length(encode(payload)) + coalesce(octet_length(encode(headers)), 0) + coalesce(octet_length(encode(message_id)), 0) + CASE WHEN ttl_seconds IS NULL THEN 0 ELSE 4 END AS n_bytes FROM ob"),
    "t8_check_transaction_limits": _with(LOG, "SELECT *, CASE WHEN n_rows > 4 THEN 'rows' ELSE 'bytes' END AS reason FROM txs WHERE n_rows > 4 OR n_bytes > 90"),
    "t9_log_anomalies": _with(LOG, "SELECT DISTINCT source_id, log_file, CAST(100003 AS BIGINT) AS log_pos, 'rotate with open rows' AS reason FROM (" + OPEN + ")"),
    "v1_subject_error": _with(OUTBOX, "SELECT id, se AS error FROM ck"),
    "v2_parse_headers": _with(
        OUTBOX,
        """SELECT id, name, CAST(generate_subscripts(vals, 1) - 1 AS BIGINT) AS value_idx, unnest(vals) AS value FROM (SELECT he.id, he.name,
  CASE json_type(val) WHEN 'ARRAY' THEN CAST(json_extract_string(val, '$[*]') AS VARCHAR[]) ELSE [json_extract_string(val, '$')] END AS vals FROM he JOIN hm ON he.id = hm.id WHERE hm.error IS NULL)""",
    ),
    "v3_header_error": _with(OUTBOX, "SELECT id, hd AS error FROM ck"),
    "v4_parse_headers_strict": _with(OUTBOX, "SELECT id, hd AS error FROM ck"),
    "v5_ttl": _with(OUTBOX, "SELECT id, te AS error, created_at + to_seconds(ttl_seconds) AS expires_at FROM ck"),
    "v6_stable_message_id": _with(OUTBOX, "SELECT id, coalesce(nullif(message_id, ''), 'relay:app:outbox:' || id) AS stable_id FROM ob"),
    "v7_validate_messages": _with(OUTBOX, "SELECT id, 'outbox row ' || id || ': ' || coalesce(se, hd, te) AS error FROM ck"),
    "v8_contract_violations": _with(
        OUTBOX,
        """SELECT id, 'subject_not_empty' AS rule FROM ob WHERE subject = '' UNION ALL SELECT id, 'subject_concrete' FROM ob WHERE regexp_matches(subject, '[*>\\s]')
UNION ALL SELECT id, 'subject_tokens' FROM ob WHERE contains(subject, '..') UNION ALL SELECT id, 'ttl_positive' FROM ob WHERE ttl_seconds = 0 UNION ALL SELECT id, 'headers_object' FROM ob WHERE headers = 'null'""",
    ),
    "v9_key_violations": _with(OUTBOX, "SELECT 'message_id' AS key, message_id AS value, count(*) AS n FROM ob WHERE message_id IS NOT NULL GROUP BY message_id HAVING count(*) > 1 UNION ALL SELECT 'id', CAST(id AS VARCHAR), count(*) FROM ob GROUP BY id HAVING count(*) > 1"),
    "r1_route_subjects": _with(OUTBOX, "SELECT id, subject, stream FROM ck"),
    "r2_check_expected_stream": _with(OUTBOX, "SELECT id, CASE WHEN stream IS NULL THEN 'no stream covers the subject' WHEN stream <> 'EVENTS' THEN 'expected stream EVENTS, got ' || stream END AS route_error FROM ck"),
    "r5_live_messages": _with(OUTBOX, "SELECT id, created_at + to_seconds(ttl_seconds * 7200) AS expires_at FROM ob WHERE ttl_seconds IS NULL OR created_at + to_seconds(ttl_seconds * 7200) > TIMESTAMP '2024-01-20'"),
    "a1_attempt": _with(OUTBOX, "SELECT id, error IS NULL AS ok, error, attempt_count > 0 AS was_retry, error IS NOT NULL AND attempt_count = 0 AS first_failure FROM att"),
    "a2_delete_acknowledged": _with(OUTBOX, "SELECT id, attempt_count, CAST(NULL AS TIMESTAMP) AS last_attempt_at, CAST(NULL AS VARCHAR) AS last_error FROM att WHERE error IS NOT NULL"),
    "a3_record_failures": _with(OUTBOX, KEPT),
    "a4_apply_results": _with(OUTBOX, KEPT + " WHERE error IS NOT NULL"),
    "a5_snapshot_page": _with(OUTBOX, "SELECT id, subject, attempt_count FROM ob WHERE id > 200 ORDER BY id LIMIT 500"),
    "a6_snapshot_batches": _with(OUTBOX, "SELECT id, CAST((row_number() OVER (ORDER BY id) - 1) // 500 AS BIGINT) AS batch FROM ob"),
    "a7_failed_rows": _with(OUTBOX, "SELECT id, attempt_count FROM ob WHERE attempt_count > 0"),
    "a7_count_failed": _with(OUTBOX, "SELECT count(*) AS n_failed FROM ob WHERE attempt_count > 0"),
    "a8_retry_pass": _with(
        OUTBOX,
        """SELECT 'outbox' AS part, CAST(id AS VARCHAR) AS name, attempt_count + CASE WHEN attempt_count > 0 THEN 1 ELSE 0 END AS value, CASE WHEN attempt_count > 0 THEN error END AS note FROM att WHERE attempt_count = 0 OR error IS NOT NULL
UNION ALL SELECT 'total', 'attempted', count(*), NULL FROM att WHERE attempt_count > 0 UNION ALL SELECT 'total', 'succeeded', count(*), NULL FROM att WHERE attempt_count > 0 AND error IS NULL UNION ALL SELECT 'total', 'failed', count(*), NULL FROM att WHERE attempt_count > 0 AND error IS NOT NULL
UNION ALL SELECT 'message', coalesce(message_id, 'relay:app:outbox:' || id), octet_length(encode(payload)), subject FROM att WHERE attempt_count > 0 AND error IS NULL""",
    ),
    "a9_snapshot_pass": _with(
        OUTBOX,
        """SELECT 'outbox' AS part, CAST(id AS VARCHAR) AS name, attempt_count + 1 AS value, error AS note FROM att WHERE error IS NOT NULL AND subject NOT LIKE 'other.%'
UNION ALL SELECT 'checkpoint', 'main', 120, 'bin.000009 u:1-7' UNION ALL SELECT DISTINCT 'checkpoint', 'c' || (user_id % 5), 4, 'bin.000001' FROM events
UNION ALL SELECT 'message', coalesce(message_id, 'relay:app:outbox:' || id), octet_length(encode(payload)), subject FROM att WHERE error IS NULL""",
    ),
    "c8_recover": _with(
        LOG + ",\n" + OWN_IDS + ",\n" + OUTBOX + """,
sc AS (SELECT * FROM my WHERE (source_id = 'src0' AND okey // 4 + 1 > 20) OR (source_id = 'src1' AND okey > 49) OR (source_id = 'src3' AND okey > 499)),
sn AS (SELECT *, CASE WHEN id % 2 = 0 THEN 'src2' ELSE 'src3' END AS src, id + 10000000000 AS sid FROM att)""",
        """SELECT 'message' AS part, coalesce(message_id, 'relay/' || source_id || ':app:outbox:' || rid) AS name, commit_pos AS value, subject AS note FROM sc WHERE subject LIKE 'items.N.%'
UNION ALL SELECT 'outbox', source_id || ':' || rid, 1, 'outbox row ' || rid || ': no stream covers the subject' FROM sc WHERE subject NOT LIKE 'items.N.%'
UNION ALL SELECT 'message', coalesce(message_id, 'relay/' || src || ':app:outbox:' || sid), NULL, subject FROM sn WHERE error IS NULL
UNION ALL SELECT 'outbox', src || ':' || sid, attempt_count + 1, 'outbox row ' || sid || ': ' || coalesce(se, hd, te, 'no stream covers the subject') FROM sn WHERE error IS NOT NULL
UNION ALL SELECT 'plan', 'main/src0', NULL, 'stream_gtid: position is available' UNION ALL SELECT 'plan', 'main/src1', NULL, 'stream_file: position is available' UNION ALL SELECT 'plan', 'main/src2', NULL, 'snapshot: no checkpoint'
UNION ALL SELECT 'plan', 'main/src3', NULL, 'snapshot: position is no longer available' UNION ALL SELECT 'plan', 'main/src4', NULL, 'error: checkpoint holds transactions the server has not executed'""",
    ),
    "s3_resume_point": _with(
        LOG + """,
z AS (SELECT coalesce(max(o_orderkey), 0) AS l FROM orders)""",
        """SELECT source_id, log_file, log_pos AS commit_pos, outcome, coalesce(n, 0) AS n_rows FROM tm CROSS JOIN z LEFT JOIN (SELECT okey, count(*) AS n FROM msg GROUP BY okey) m ON tm.okey = m.okey
WHERE (source_id = 'src0' AND tm.okey // 4 + 1 > l // 8) OR (source_id = 'src1' AND (tm.okey // 4 + 1 > l // 8 OR tm.okey // 4 + 1 = l // 8 // 2 + 1)) OR (source_id = 'src2' AND (tm.okey // 1000 > l // 2000 OR (tm.okey // 1000 = l // 2000 AND log_pos > 49903)))""",
    ),
    "s5_message_manifest": _with(
        LOG,
        """SELECT 'manifest' AS part, source_id, concat_ws('-', min(okey) // 1000 + 1, min(okey) % 1000 * 100 + 103, max(okey) // 1000 + 1, max(okey) % 1000 * 100 + 103) AS name, count(*) AS n FROM msg WHERE source_id <> 'src3' GROUP BY source_id
UNION ALL SELECT 'message', source_id, coalesce(message_id, 'relay:app:outbox:' || id), commit_pos FROM msg WHERE source_id <> 'src3'""",
    ),
    "a10_relay_stream": RELAYED,
    "c1_upsert_checkpoints": f"""WITH w AS (SELECT 'c' || (user_id % 5) AS consumer_name, max(event_id) AS e FROM events GROUP BY 1)
SELECT consumer_name, 'bin.000001' AS binlog_name, CASE WHEN consumer_name = 'c3' THEN 4 ELSE e * 10 + 4 END AS binlog_position, CASE WHEN consumer_name <> 'c3' AND e % 2 = 1 THEN 'u:1-' || e END AS gtid_set,
  CASE WHEN consumer_name = 'c3' THEN {AT} - INTERVAL 30 HOUR ELSE {AT} END AS updated_at FROM w""",
    "c2_load_checkpoint": "SELECT 'c2' AS consumer_name, max(event_id) * 10 + 4 AS binlog_position, CASE WHEN max(event_id) * 10 + 4 > 4294967295 THEN 'checkpoint position is out of range' END AS error FROM events WHERE user_id % 5 = 2",
    "c4_parse_gtid_set": """WITH s AS (SELECT user_id, 'u' || (event_id % 3) AS uuid, unnest(range(event_id + 1, event_id + 41)) AS gno FROM events), d AS (SELECT DISTINCT * FROM s),
i AS (SELECT *, gno - row_number() OVER (PARTITION BY user_id, uuid ORDER BY gno) AS g FROM d), n AS (SELECT user_id, uuid, min(gno) AS a, max(gno) AS z FROM i GROUP BY user_id, uuid, g),
t AS (SELECT user_id, uuid, uuid || ':' || string_agg(CASE WHEN a = z THEN CAST(a AS VARCHAR) ELSE a || '-' || z END, ':' ORDER BY a) AS server FROM n GROUP BY user_id, uuid)
SELECT user_id, string_agg(server, ',' ORDER BY server) AS gtid_set FROM t GROUP BY user_id""",
    "c5_gtid_union": _with(GTIDS, 'SELECT uuid, min(gno) AS "start", max(gno) AS "end" FROM isl GROUP BY uuid, g'),
    "c6_gtid_contains": "SELECT 'less' AS label, NOT EXISTS (SELECT 1 FROM events WHERE value > 50 AND NOT value > 20) AS contained UNION ALL SELECT 'more', NOT EXISTS (SELECT 1 FROM events WHERE value > 10 AND NOT value > 20)",
    "c7_position_available": _with(RECOVERY, "SELECT consumer_name, has_gtid, available, error FROM jd"),
    "c8_plan_recovery": _with(
        RECOVERY,
        """SELECT 'k' || us.u AS consumer_name, CASE WHEN jd.u IS NULL THEN 'snapshot' WHEN error IS NOT NULL OR (has_gtid AND NOT gtid_on) THEN 'error' WHEN NOT has_gtid AND gtid_on THEN 'snapshot' WHEN NOT available THEN 'snapshot' WHEN has_gtid THEN 'stream_gtid' ELSE 'stream_file' END AS plan,
  CASE WHEN jd.u IS NULL THEN 'no checkpoint' WHEN has_gtid AND NOT gtid_on THEN 'checkpoint has a GTID set but the server has GTIDs off' WHEN error IS NOT NULL THEN error WHEN NOT has_gtid AND gtid_on THEN 'move from file position to GTIDs' WHEN NOT available THEN 'position is no longer available' ELSE 'position is available' END AS reason
FROM us LEFT JOIN jd ON us.u = jd.u""",
    ),
    "c9_attach_gtid": _with(
        LOG
        + """,
marks AS (SELECT o_orderkey AS okey, 'src' || (o_orderkey % 4) AS source_id, CASE WHEN o_orderkey % 1000 >= 20 AND o_orderkey % 4 < 3 THEN o_orderkey // 4 + 1 END AS gno FROM orders),
cy AS (SELECT okey, source_id, max(gno) OVER (PARTITION BY source_id ORDER BY okey) AS gno FROM marks),
tg AS (SELECT tm.source_id, tm.log_file, tm.log_pos, CASE WHEN cy.gno IS NOT NULL THEN tm.source_id END AS gtid_uuid, cy.gno FROM tm JOIN cy ON tm.okey = cy.okey)""",
        """SELECT source_id, log_file, log_pos, gtid_uuid, gno FROM tg
UNION ALL SELECT uuid, 'as of the end', min(gno), NULL, max(gno) FROM (SELECT uuid, gno, gno - row_number() OVER (PARTITION BY uuid ORDER BY gno) AS g FROM (SELECT gtid_uuid AS uuid, gno FROM tg WHERE gno IS NOT NULL
  UNION SELECT 'src0', unnest([1, 2, 3]) UNION SELECT 'src1', 1 UNION SELECT 'src2', 1)) GROUP BY uuid, g""",
    ),
    "c9_sets_at_checkpoints": _with(
        LOG
        + """,
marks AS (SELECT o_orderkey AS okey, 'src' || (o_orderkey % 4) AS source_id, CASE WHEN o_orderkey % 1000 >= 20 AND o_orderkey % 4 < 3 THEN o_orderkey // 4 + 1 END AS gno FROM orders),
cy AS (SELECT okey, source_id, max(gno) OVER (PARTITION BY source_id ORDER BY okey) AS gno FROM marks),
tg AS (SELECT tm.source_id, tm.okey // 1000 + 1 AS file_no, cy.gno FROM tm JOIN cy ON tm.okey = cy.okey WHERE tm.source_id <> 'src3'),
pt AS (SELECT DISTINCT source_id, file_no FROM tg),
st AS (SELECT pt.source_id, pt.file_no, tg.gno FROM pt JOIN tg ON tg.source_id = pt.source_id AND tg.file_no <= pt.file_no WHERE gno IS NOT NULL
  UNION SELECT source_id, file_no, unnest(CASE source_id WHEN 'src0' THEN [1, 2, 3] ELSE [1] END) FROM pt)""",
        """SELECT source_id, file_no, min(gno) AS "start", max(gno) AS "end" FROM (SELECT *, gno - row_number() OVER (PARTITION BY source_id, file_no ORDER BY gno) AS g FROM st) GROUP BY source_id, file_no, g""",
    ),
    "h1_delivery_counters": _with(ATTEMPTS, "SELECT * FROM cn"),
    "h2_last_error": _with(ATTEMPTS, "SELECT ap.consumer, CASE WHEN any_value(n_failed) > 0 THEN arg_max(error, (ts, id)) FILTER (WHERE NOT ok) END AS last_error FROM ap LEFT JOIN fl ON ap.consumer = fl.consumer GROUP BY ap.consumer HAVING count(*) FILTER (WHERE NOT ok) > 0"),
    "h3_failed_rows_gauge": _with(
        ATTEMPTS,
        """SELECT consumer, id, CAST(s - least(0, min(s) OVER (PARTITION BY consumer ORDER BY ts, id)) AS BIGINT) AS gauge FROM (SELECT consumer, id, ts, CASE consumer WHEN 'c0' THEN 5 ELSE 0 END + sum(CASE WHEN first_failure THEN 1 WHEN ok AND was_retry THEN -1 ELSE 0 END) OVER (PARTITION BY consumer ORDER BY ts, id) AS s FROM ap)""",
    ),
    "h4_metrics_long": _with(
        ATTEMPTS,
        """SELECT consumer, 'published_total' AS name, 'Messages published.' AS help, 'counter' AS kind, published AS value FROM cn UNION ALL SELECT consumer, 'publish_errors_total', 'Failed publish attempts.', 'counter', publish_errors FROM cn
UNION ALL SELECT consumer, 'errors_total', 'Errors of any kind.', 'counter', publish_errors + CASE consumer WHEN 'c1' THEN 4 ELSE 0 END FROM cn UNION ALL SELECT consumer, 'failed_rows', 'Rows kept after a failed publish.', 'gauge', n_failed FROM fl
UNION ALL SELECT consumer, 'retry_successes_total', 'Failed messages published later.', 'counter', retry_successes FROM cn UNION ALL SELECT consumer, 'last_published_seconds', 'Time of the last publish.', 'gauge', coalesce(CAST(floor(epoch(last_published)) AS BIGINT), 0) FROM cn
UNION ALL SELECT consumer, 'last_checkpoint_seconds', 'Time of the last checkpoint.', 'gauge', coalesce(CAST(floor(epoch(last_checkpoint)) AS BIGINT), 0) FROM cn""",
    ),
    "h5_delivery_by_window": _with(ATTEMPTS, "SELECT * FROM wn"),
    "h6_alerts": _with(
        ATTEMPTS,
        f"""SELECT consumer, 'failed_rows' AS alert, {AT} AS "at", n_failed AS value FROM fl WHERE n_failed > 0
UNION ALL SELECT consumer, 'errors_rising', window_start, publish_errors - b FROM (SELECT *, lag(publish_errors) OVER (PARTITION BY consumer ORDER BY window_start) AS b FROM wn) WHERE publish_errors > b
UNION ALL SELECT consumer, 'checkpoint_stale', {AT}, CAST(epoch({AT}) - epoch(updated_at) AS BIGINT) FROM cps WHERE epoch({AT}) - epoch(updated_at) > 90000""",
    ),
    "h5_stream_windows": _with(ATTEMPTS, "SELECT * FROM wn"),
    "h6_stream_alerts": _with(
        ATTEMPTS,
        """SELECT consumer, 'errors_rising' AS alert, window_start AS "at", publish_errors - b AS value FROM (SELECT *, lag(publish_errors) OVER (PARTITION BY consumer ORDER BY window_start) AS b FROM wn) WHERE publish_errors > b
UNION ALL SELECT consumer, 'checkpoint_stale', updated_at, NULL FROM cps""",
    ),
    "h7_failures_by_reason": _with(ATTEMPTS, "SELECT subject, error, count(*) AS n, max(id) AS last_id, max(ts) AS last_at FROM ap WHERE NOT ok GROUP BY ALL"),
}

_GREEDY = f"""WITH RECURSIVE {OUTBOX.replace('ob AS', 'ob AS', 1)},
m AS (SELECT id, coalesce(message_id, 'relay:app:outbox:' || id) AS k, created_at AS ts FROM ob),
s AS (SELECT k, min(ts) AS t FROM m GROUP BY k UNION ALL SELECT s.k, min(m.ts) FROM s JOIN m ON m.k = s.k AND m.ts >= s.t + INTERVAL 24 HOUR GROUP BY s.k)
SELECT min(m.id) AS id, m.k AS message_id, m.ts AS created_at FROM s JOIN m ON m.k = s.k AND m.ts = s.t GROUP BY m.k, m.ts"""
ORACLE_SQL["r3_dedupe_window"] = ORACLE_SQL["r4_stream_dedupe"] = ORACLE_SQL["r4_settled_dedupe"] = _GREEDY
ORACLE_SQL["c3_checkpoint_timeline"] = """WITH RECURSIVE e AS (SELECT 'c' || (user_id % 5) AS consumer, ts, event_id AS row, event_type = 'purchase' AS has_rows FROM events),
s AS (SELECT consumer, min(ts) AS base, min(ts) - INTERVAL 1 MICROSECOND AS cur, false AS written FROM e GROUP BY consumer
  UNION ALL SELECT s.consumer, min(e.ts), min(e.ts), true FROM s JOIN e ON e.consumer = s.consumer AND e.ts > s.cur AND (e.has_rows OR e.ts >= s.base + INTERVAL 6 HOUR) GROUP BY s.consumer)
SELECT e.consumer, e.ts, e.row FROM s JOIN e ON e.consumer = s.consumer AND e.ts = s.cur WHERE written"""
