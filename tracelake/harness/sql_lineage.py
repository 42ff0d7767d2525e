"""DuckDB SQL for lineage, merges and refresh."""

from tracelake.harness.sql_events import BASE

EVENT_QUERIES: dict[str, str] = {
    "path_iterations": """SELECT target_file, count(*) AS ops, min(created_at) AS first_touch, max(created_at) AS last_touch
  FROM messages WHERE target_file ILIKE '%FILE_7%' GROUP BY 1""",
    "work_units": """SELECT m.session_id, CAST(m.created_at AS DATE) AS day, string_agg(DISTINCT tool_name, ',' ORDER BY tool_name) AS tools, count(*) AS ops,
  min(position) AS first_pos, max(position) AS last_pos, min(created_at) AS start, max(created_at) AS "end", any_value(s.title) AS title,
  any_value(s.project) AS project, any_value(s.message_count) AS message_count, any_value(s.message_count) >= 5 AS is_large
  FROM messages m JOIN sessions s ON s.session_id = m.session_id WHERE target_file ILIKE '%FILE_7%' AND tool_name IN ('Write', 'Edit') GROUP BY 1, 2""",
    "seam_units": """, e AS (SELECT session_id, position, created_at, lag(created_at) OVER (PARTITION BY session_id ORDER BY created_at, position) AS p
  FROM messages WHERE tool_name IN ('Write', 'Edit')),
u AS (SELECT *, sum(CASE WHEN p IS NULL OR created_at - p > INTERVAL 1 HOUR OR CAST(created_at AS DATE) <> CAST(p AS DATE) THEN 1 ELSE 0 END)
  OVER (PARTITION BY session_id ORDER BY created_at, position) AS unit FROM e)
SELECT session_id, CAST(unit AS BIGINT) AS unit, count(*) AS ops, min(position) AS first_pos, max(position) AS last_pos, min(created_at) AS start,
  max(created_at) AS "end" FROM u GROUP BY 1, 2""",
    "density_shifts": """, h AS (SELECT session_id, date_trunc('hour', created_at) AS hour, count(*) AS edits FROM messages
  WHERE tool_name IN ('Write', 'Edit') GROUP BY 1, 2), l AS (SELECT *, lag(edits) OVER (PARTITION BY session_id ORDER BY hour) AS before FROM h)
SELECT session_id, hour, edits, before FROM l WHERE edits >= 2.0 * before""",
    "position_buckets": """SELECT session_id, CAST((position - 1) // 5 AS BIGINT) AS bucket, count(*) AS edits, min(created_at) AS start, max(created_at) AS "end"
  FROM messages WHERE tool_name IN ('Write', 'Edit') GROUP BY 1, 2""",
    "context_ranges": """, e AS (SELECT session_id, position, created_at, lag(created_at) OVER (PARTITION BY session_id ORDER BY created_at, position) AS p
  FROM messages WHERE tool_name IN ('Write', 'Edit')),
u AS (SELECT *, sum(CASE WHEN p IS NULL OR created_at - p > INTERVAL 1 HOUR OR CAST(created_at AS DATE) <> CAST(p AS DATE) THEN 1 ELSE 0 END)
  OVER (PARTITION BY session_id ORDER BY created_at, position) AS unit FROM e),
r AS (SELECT session_id, CAST(unit AS BIGINT) AS unit, greatest(1, min(position) - 2) AS from_pos, max(position) + 2 AS hi FROM u GROUP BY 1, 2),
q AS (SELECT r.session_id, unit, from_pos, least(message_count, hi) AS to_pos FROM r JOIN sessions s ON s.session_id = r.session_id)
SELECT q.*, count(*) AS messages, count(*) FILTER (m.type = 'user_prompt') AS prompts FROM q JOIN messages m ON m.session_id = q.session_id
  AND m.position BETWEEN q.from_pos AND q.to_pos GROUP BY ALL""",
    "file_provenance": """SELECT m.session_id, any_value(s.title) AS title, make_timestamp((min(timestamp) - 25200) * 1000000) AS first_touch,
  make_timestamp((max(timestamp) - 25200) * 1000000) AS last_touch, count(*) AS ops FROM messages m JOIN sessions s ON s.session_id = m.session_id
  WHERE target_file = 'src/file_7.py' AND tool_name IN ('Write', 'Edit') GROUP BY 1""",
    "co_touched_files": """, t AS (SELECT DISTINCT session_id, target_file AS f FROM messages WHERE target_file IS NOT NULL),
asked AS (SELECT DISTINCT target_file AS f FROM messages WHERE tool_name = 'Write' AND created_at >= DATE '2024-01-30')
SELECT a.f AS file, b.f AS with_file, count(*) AS sessions FROM t a JOIN t b ON a.session_id = b.session_id AND a.f <> b.f
WHERE a.f IN (SELECT f FROM asked) GROUP BY 1, 2 HAVING count(*) >= 2""",
    "assignment_summary": """, l AS (SELECT DISTINCT session_id, tool_name AS lane FROM messages WHERE tool_name IS NOT NULL),
n AS (SELECT session_id, count(*) AS n FROM l GROUP BY 1),
s AS (SELECT l.*, CASE WHEN n > 3 THEN 'ambiguous' WHEN lane = 'Bash' THEN 'excluded' ELSE 'assigned' END AS status FROM l JOIN n USING (session_id))
SELECT (SELECT count(*) FROM sessions) AS considered, count(DISTINCT session_id) FILTER (status = 'assigned') AS assigned,
  count(DISTINCT session_id) FILTER (status = 'ambiguous') AS ambiguous, count(DISTINCT session_id) FILTER (status = 'excluded') AS excluded,
  count(DISTINCT lane) FILTER (status = 'assigned') AS workstreams,
  (SELECT count(*) FROM (SELECT session_id FROM s WHERE status = 'assigned' GROUP BY 1 HAVING count(*) > 1)) AS in_several_lanes FROM s""",
}

VERSIONS = """, body AS (SELECT 'm' || event_id AS chunk_id, event_type,
  'k' || (k % 4) || chr(10) || 'u' || (user_id % 3) || chr(10) || 'end' AS text, user_id, k FROM nev WHERE event_type IN ('purchase', 'click')),
stored AS (SELECT *, CASE WHEN event_type = 'purchase' THEN '{"content":"' || replace(text, chr(10), '\\n') || '"}' ELSE text END AS content,
  CASE WHEN event_type = 'purchase' THEN 'Write' ELSE '_file_backup' END AS body_tool FROM body),
v AS (SELECT m.target_file, s.chunk_id, sha256(s.content) AS content_hash, s.body_tool, strlen(s.content) AS byte_length, s.content, s.text,
  m.session_id, m.timestamp, m.position FROM stored s JOIN messages m ON m.id = s.chunk_id),
w AS (SELECT *, row_number() OVER o AS version, lag(content_hash) OVER o AS prev_hash, lag(text) OVER o AS prev_text FROM v
  WINDOW o AS (PARTITION BY target_file ORDER BY timestamp, session_id, position, chunk_id))
"""

EVENT_QUERIES["recoverable_versions"] = VERSIONS + """SELECT chunk_id, session_id, timestamp, position, body_tool AS tool_name, byte_length,
  substr(content, 1, 100) AS preview FROM v WHERE target_file = 'src/file_7.py'"""
EVENT_QUERIES["version_deltas"] = VERSIONS + """SELECT target_file, version, chunk_id, content_hash, prev_hash,
  CASE WHEN prev_hash IS NOT NULL THEN len(list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(string_split(prev_text, chr(10)), x))) END AS added,
  CASE WHEN prev_hash IS NOT NULL THEN len(list_filter(string_split(prev_text, chr(10)), lambda x: NOT list_contains(string_split(text, chr(10)), x))) END AS removed FROM w"""

DOCS = """
t AS (SELECT md5(text) AS key, doc_id, lang, source, n_chars FROM documents),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS rn FROM t WHERE doc_id IN (SELECT doc_id FROM labels)) WHERE rn = 1),
a AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS up, row_number() OVER (PARTITION BY key ORDER BY doc_id DESC) AS down FROM t)"""

DOC_QUERIES = {
    "ingest_keep_first": """SELECT key, doc_id, lang, source, n_chars FROM f UNION ALL
  SELECT key, doc_id, lang, source, n_chars FROM a WHERE up = 1 AND key NOT IN (SELECT key FROM f)""",
    "ingest_replace": "SELECT key, doc_id, lang, source, n_chars FROM a WHERE down = 1",
    "ingest_coalesce": """SELECT f.key, f.doc_id, coalesce(CASE WHEN f.n_chars % 2 = 0 THEN f.lang END, 'new-' || a.lang) AS lang,
  coalesce(CASE WHEN a.n_chars % 5 <> 0 THEN 'new-' || a.source END, CASE WHEN f.n_chars % 3 = 0 THEN f.source END) AS source
  FROM f JOIN a ON a.key = f.key AND a.down = 1""",
    "ingest_audit": """, g AS (SELECT a.*, n_chars >= 50 AS ok, key IN (SELECT key FROM f) AS known,
  min(CASE WHEN n_chars >= 50 THEN doc_id END) OVER (PARTITION BY key) AS first_id FROM a)
SELECT lang, count(*) AS attempted, count(*) FILTER (ok AND NOT known AND doc_id = first_id) AS inserted, count(*) FILTER (NOT ok) AS rejected,
  '{"batch":"all documents","min_chars":"50"}' AS params FROM g GROUP BY lang""",
}

ROWS = "r AS (SELECT 'e' || event_id AS id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS timestamp, event_type AS author FROM events)"

REFRESH_QUERIES = {
    "refresh_from_cursor": "SELECT * FROM r WHERE timestamp >= 1705363200 + 86400",
    "refresh_next_cursor": "SELECT 'last_pull_ts' AS key, max(timestamp)::VARCHAR AS value FROM r",
    "refresh_since_days": "SELECT author, count(*) AS n FROM r WHERE timestamp >= 1706400000 GROUP BY 1",
    "author_cursors": """SELECT coalesce(r.author, c.author) AS author, greatest(r.m, c.cursor) AS cursor FROM
  (SELECT author, max(timestamp) AS m FROM r GROUP BY 1) r FULL JOIN (VALUES ('view', 1704100000), ('click', 1900000000), ('gone', 5)) c(author, cursor)
  ON c.author = r.author""",
}


def _with(base: str, body: str) -> str:
    return f"WITH {base.strip()}{'' if body.startswith(',') else chr(10)}{body}"


EVENT_QUERIES |= {
    "seam_units_sliced": EVENT_QUERIES["seam_units"],
    "density_shifts_default": EVENT_QUERIES["density_shifts"].replace(">= 2.0", ">= 3.0"),
    "context_ranges_default": EVENT_QUERIES["context_ranges"].replace("min(position) - 2)", "min(position) - 200)").replace("max(position) + 2 AS", "max(position) + 200 AS"),
}


def all_sql() -> dict[str, str]:
    out = {n: _with(BASE, q) for n, q in EVENT_QUERIES.items()}
    out.update({n: _with(DOCS, q) for n, q in DOC_QUERIES.items()})
    out.update({n: _with(ROWS, q) for n, q in REFRESH_QUERIES.items()})
    return out
