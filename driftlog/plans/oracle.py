"""DuckDB SQL equivalents of the query catalog, over the same parquet tables.

Written from the semantics, not from the Spark plan: the encode/decode
round trip of ``records_from_events`` is the identity on the mapped
fields, so the decode queries read ``events`` directly.

Engine differences handled here: DuckDB ``url_decode`` keeps ``+`` (replace
it first); use ``epoch_us(ts) // 1000`` for truncated milliseconds; keep
JSON nulls with ``to_json`` of a struct.
"""

from __future__ import annotations

from driftlog.plans.catalog import (DEEP_PAGE, GROUP, PAGE_SIZE, LINK_QUERY, LINK_TERM, RESUME_AFTER_DAY,
                                    SEARCH_QUERY)
from driftlog.functions.text import query_tokens

# Record position and time of an ``events`` row, as records_from_events sets them.
_RECORDS = """
  SELECT 'tracking' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
         CAST(event_id // 4 AS BIGINT) AS "offset", CAST(user_id AS VARCHAR) AS "key",
         event_id, user_id, event_type, ts, props, value,
         CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS batch_id
  FROM events
"""

_FACT = f"""
  SELECT 'shop' || user_id % 3 AS b, 'h' || event_id % 2 AS s, event_type AS en, event_type AS et,
         'https://shop.example.com/e/' || CAST(event_id AS VARCHAR) AS cu,
         'https://shop.example.com/u/' || user_id AS pu,
         CAST(user_id AS VARCHAR) AS uid,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS sid,
         'https://ref.example.com/' || event_id % 97 AS ref, 'https://land.example.com/' || event_id % 89 AS land,
         props AS gs, CAST(event_id AS VARCHAR) AS oid,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS st, 'lv' || event_id % 7 AS lvst,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
         'web' || event_id % 5 AS chl, 'po' || event_id AS poid, 'c' || event_type AS "catId",
         'sh' || user_id % 11 AS "shopId",
         event_id, ts
  FROM events
"""

# Strict "exactly one JSON object" test on a text expression ``{t}``.
_IS_OBJ = ("COALESCE(CASE WHEN starts_with({t}, '{{') AND ends_with({t}, '}}') AND json_valid({t}) "
           "THEN json_type({t}) = 'OBJECT' ELSE false END, false)")


def _is_obj(t: str) -> str:
    return _IS_OBJ.format(t=t)


def _sql_list(tokens: list[str]) -> str:
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in tokens) + "]"


_WORD_SPLIT = r"'[^\p{L}\p{N}]+'"
_RUNS = r"'[\p{L}\p{N}]+|[^\p{L}\p{N}]+'"


def _match(text: str, tokens: list[str]) -> str:
    return f"list_has_any(string_split_regex(lower({text}), {_WORD_SPLIT}), {_sql_list(tokens)})"


def _highlight(text: str, tokens: list[str]) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({text}, {_RUNS}), "
            f"lambda x: CASE WHEN list_contains({_sql_list(tokens)}, lower(x)) "
            f"THEN '<em>' || x || '</em>' ELSE x END), '')")


def _query_of(url: str) -> str:
    return f"NULLIF(regexp_extract({url}, '\\?([^#]*)', 1), '')"


def _decode_args(args: str) -> str:
    return f"url_decode(replace(replace({args}, 'params=', ''), '+', ' '))"


_TEXTS = """
  SELECT 'events' AS source, CAST(event_id AS VARCHAR) AS id, props AS text FROM events
  UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), text FROM documents
  UNION ALL SELECT 'conversations', conv_id || '-' || turn, text FROM conversations
  UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), html FROM pages
"""

# Reason of a record value ``v``, same checks and order as decode_records.
_REASON = (
    "CASE WHEN NOT {ov} THEN 'bad_envelope' "
    "WHEN NOT {om} THEN 'bad_message' "
    "WHEN args IS NULL THEN 'missing_args' "
    "WHEN NOT {op} THEN 'bad_payload' ELSE 'ok' END"
)

SQL: dict[str, str] = {}

SQL["decode_fact"] = f"""
SELECT b, s, en, et, cu, pu, uid, sid, ref, land, gs, oid, st, lvst, "timestamp",
       chl, poid, "catId", "shopId"
FROM ({_FACT})
"""

SQL["doc_projection"] = f"""
SELECT 'tracking-' || CAST(event_id % 4 AS VARCHAR) || '-' || CAST(event_id // 4 AS VARCHAR) AS doc_id,
       oid, b, "catId", chl, cu, en
FROM ({_FACT})
"""

# The line's ``args`` of an ``events`` row, as records_from_events encodes it.
_EVENT_ARGS = """'params=' || replace(replace(url_encode(CAST(to_json({
         'b': 'shop' || user_id % 3, 's': 'h' || event_id % 2, 'en': event_type, 'et': event_type,
         'cu': 'https://shop.example.com/e/' || event_id, 'pu': 'https://shop.example.com/u/' || user_id,
         'uid': CAST(user_id AS VARCHAR), 'sid': user_id || '-' || strftime(ts, '%Y-%m-%d'),
         'ref': 'https://ref.example.com/' || event_id % 97, 'land': 'https://land.example.com/' || event_id % 89,
         'd': {'gs': props, 'oid': CAST(event_id AS VARCHAR), 'st': CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR),
               'lvst': 'lv' || event_id % 7, 'chl': 'web' || event_id % 5, 'poid': 'po' || event_id,
               'catId': 'c' || event_type, 'shopId': 'sh' || user_id % 11, 'sq': '1',
               'amt': CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)}}) AS VARCHAR)), '%20', '+'), '%2A', '*')"""

SQL["access_log_fields"] = f"""
SELECT CAST(event_id % 4 AS INTEGER) AS "partition", CAST(event_id // 4 AS BIGINT) AS "offset",
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
       '192.0.2.' || (user_id % 250 + 1) AS client_ip, 'track.example.com' AS domain,
       {_EVENT_ARGS} AS args
FROM events
"""

SQL["json_props"] = f"""
SELECT event_id, json_extract_string(props, '$.k') AS k, {_is_obj('props')} AS is_object
FROM events
"""

SQL["url_args"] = f"""
SELECT page_id, {_query_of('url')} AS args, {_decode_args(_query_of('url'))} AS decoded
FROM pages
"""

SQL["valid_split"] = f"""
SELECT source, id, {_is_obj('text')} AS is_object FROM ({_TEXTS})
"""

SQL["quarantine_reasons"] = f"""
WITH recs AS (      -- the value of each record, as text
  SELECT 'events' AS source, to_json({{'message': to_json({{'args': {_EVENT_ARGS}}})::VARCHAR}})::VARCHAR AS v FROM events
  UNION ALL SELECT 'documents', text FROM documents
  UNION ALL SELECT 'conversations', to_json({{'conv_id': conv_id, 'turn': turn, 'role': role, 'text': text}})::VARCHAR
    FROM conversations
  UNION ALL SELECT 'pages', to_json({{'message': CASE WHEN args IS NULL THEN to_json({{'uri': url}})
      ELSE to_json({{'uri': url, 'args': args}}) END::VARCHAR}})::VARCHAR
    FROM (SELECT url, {_query_of('url')} AS args FROM pages)
),
messages AS (
  SELECT source, {_is_obj('v')} AS ov, CASE WHEN json_valid(v) THEN json_extract_string(v, '$.message') END AS msg FROM recs
),
lines AS (
  SELECT source, ov, {_is_obj('msg')} AS om, CASE WHEN json_valid(msg) THEN json_extract_string(msg, '$.args') END AS args
  FROM messages
)
SELECT source, {_REASON.format(ov='ov', om='om', op=_is_obj(_decode_args('args')))} AS reason, COUNT(*) AS n
FROM lines GROUP BY ALL
"""

SQL["event_day"] = """
SELECT event_id, epoch_us(ts) // 1000 AS ts, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr
FROM events
"""

_FIRST_SEEN = """
  SELECT * FROM (
    SELECT strftime(ts, '%Y-%m-%d') AS dt, CAST(user_id AS VARCHAR) AS mid,
           strftime(ts, '%H') AS hr, epoch_us(ts) // 1000 AS ts_ms, event_id, event_type,
           row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), user_id
                              ORDER BY epoch_us(ts) // 1000, event_id) AS rn
    FROM events) WHERE rn = 1
"""

SQL["daily_first_seen"] = f"""
SELECT dt, mid, hr, ts_ms AS ts, event_id, event_type AS ch FROM ({_FIRST_SEEN})
"""

SQL["visitor_record"] = f"""
SELECT mid, mid AS uid, 'ar' || CAST(mid AS BIGINT) % 13 AS ar, event_type AS ch, '1.0' AS vc, dt, hr, '00' AS mi, ts_ms AS ts
FROM ({_FIRST_SEEN})
"""

SQL["offset_ranges"] = f"""
SELECT topic, "partition", MIN("offset") AS from_offset, MAX("offset") + 1 AS until_offset,
       COUNT(*) AS records
FROM ({_RECORDS}) GROUP BY ALL
"""

_LEDGER = f"""
  SELECT '{GROUP}' AS "group", topic, "partition", MIN("offset") AS from_offset,
         MAX("offset") + 1 AS until_offset, batch_id
  FROM ({_RECORDS}) GROUP BY topic, "partition", batch_id
"""

SQL["latest_offsets"] = f"""
SELECT "group", topic, "partition", arg_max(until_offset, batch_id) AS until_offset,
       MAX(batch_id) AS batch_id
FROM ({_LEDGER}) GROUP BY ALL
"""

SQL["resume_from"] = f"""
WITH saved AS (
  SELECT topic, "partition", arg_max(until_offset, batch_id) AS until_offset
  FROM ({_LEDGER}) WHERE batch_id <= {int(RESUME_AFTER_DAY.replace('-', ''))} GROUP BY ALL
)
SELECT r.topic, r."partition", r."offset", r."key"
FROM ({_RECORDS}) r LEFT JOIN saved s ON r.topic = s.topic AND r."partition" = s."partition"
WHERE s.until_offset IS NULL OR r."offset" >= s.until_offset
"""

SQL["upsert_latest"] = f"""
SELECT uid, batch_id, oid, b, "catId", chl, cu, en FROM (
  SELECT f.*, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS batch_id,
         row_number() OVER (PARTITION BY uid ORDER BY strftime(ts, '%Y%m%d') DESC, ts DESC,
                            event_id % 4 DESC, event_id // 4 DESC) AS rn
  FROM ({_FACT}) f) WHERE rn = 1
"""

SQL["rows_to_json"] = """
SELECT c_custkey,
       CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
                     'c_acctbal': c_acctbal, 'c_mktsegment': c_mktsegment}) AS VARCHAR) AS json
FROM customer
"""

_TOKS = query_tokens(SEARCH_QUERY)

SQL["search_topk"] = f"""
SELECT doc_id, lang, source, n_chars, {_highlight('text', _TOKS)} AS text_highlight
FROM documents
WHERE lang = 'en' AND {_match('text', _TOKS)}
ORDER BY n_chars DESC NULLS LAST, doc_id
LIMIT 20
"""

SQL["search_page"] = f"""
SELECT doc_id, source, n_chars FROM documents
WHERE source = 'src3' AND {_match('text', query_tokens('ing'))}
ORDER BY n_chars ASC NULLS LAST, doc_id
LIMIT 10 OFFSET 5
"""

SQL["search_links"] = f"""
SELECT page_id, url, length(html) AS html_len FROM pages
WHERE list_contains(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2), '{LINK_TERM}')
  AND {_match('html', query_tokens(LINK_QUERY))}
ORDER BY html_len DESC NULLS LAST, page_id
LIMIT 10
"""

SQL["search_keywords"] = SQL["search_links"]

SQL["search_deep_page"] = f"""
SELECT doc_id, source, n_chars FROM documents
WHERE lang = 'en' AND {_match('text', query_tokens('the'))}
ORDER BY n_chars DESC NULLS LAST, doc_id
LIMIT {PAGE_SIZE} OFFSET {(DEEP_PAGE - 1) * PAGE_SIZE}
"""

SQL["index_rejects"] = """
SELECT lang, CASE WHEN long THEN 'keyword_too_long' ELSE 'taken' END AS reason,
       CASE WHEN long THEN 'text' END AS detail, COUNT(*) AS n
FROM (SELECT lang, COALESCE(octet_length(encode(text)) > 32766, FALSE) AS long FROM documents)
GROUP BY ALL
"""

SQL["topic_replays"] = f"""
SELECT "key", batch_id AS day, "partition" AS source_partition, "offset" AS source_offset FROM ({_RECORDS})
"""

SQL["write_metrics"] = f"""
SELECT topic, "partition", COUNT(*) AS written FROM ({_RECORDS}) GROUP BY ALL
"""

SQL["daily_first_seen_stream"] = SQL["visitor_record"]
SQL["upsert_runs"] = SQL["upsert_latest"]

SQL["flatten_append_stream"] = f"""
SELECT oid, b, "catId", chl, cu, en FROM ({_FACT})
"""

SQL["resume_stream"] = SQL["flatten_append_stream"]

SQL["resume_archive"] = SQL["resume_from"]
SQL["capped_archive"] = SQL["offset_ranges"]

SQL["flatten_upsert_stream"] = f"""
SELECT uid AS doc_id, uid, oid, et, "timestamp" FROM (
  SELECT f.*, row_number() OVER (PARTITION BY uid ORDER BY event_id // 4 DESC, event_id % 4 DESC) AS rn
  FROM ({_FACT}) f) WHERE rn = 1
"""

SQL["ledger_stream"] = f"""
SELECT '{GROUP}' AS "group", topic, "partition", MAX("offset") + 1 AS until_offset
FROM ({_RECORDS}) GROUP BY ALL
"""
