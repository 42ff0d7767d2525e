"""DuckDB SQL for the made transcripts: rebuilt from the documents, expected kinds from a table, not from patterns."""

from tracelake.harness.transcripts import MODIFIED, TOOL_LINES


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    return "'" + v.replace("'", "''") + "'"


_ROWS = ",\n  ".join(
    f"({n}, {_lit(t)}, {_lit(k)}, {_lit(tool)}, {_lit(target)}, {_lit(ok)}::BOOLEAN)"
    for n, (t, k, tool, target, ok) in enumerate(TOOL_LINES)
)
N = len(TOOL_LINES)

BASE = rf"""
tl(n, text, kind, tool, target, ok) AS (VALUES
  {_ROWS}),
src AS (SELECT doc_id AS d, '/work/p' || (doc_id % 20) || '/aider.' || doc_id || '.chat.history.md' AS path,
   string_split(text, chr(10)) AS given, doc_id % 2 AS odd FROM documents),
dl AS (SELECT d, path, odd, given[i + 1] AS x, i, len(given) AS total FROM (
   SELECT d, path, odd, given, unnest(generate_series(0, len(given) - 1)) AS i FROM src)),
raws AS (
   SELECT d, path, -1 AS i, 0 AS sub, 'ignored preamble' AS raw, NULL::BIGINT AS n, total FROM dl WHERE i = 0 AND odd = 1
   UNION ALL SELECT d, path, i, 0, '# aider chat started at ' || CASE WHEN d % 13 = 0 THEN 'a while ago'
     ELSE strftime(make_timestamp((1704067200 + d * 3600 + (i // 20) * 600)::BIGINT * 1000000), '%Y-%m-%d %H:%M:%S') END, NULL, total FROM dl WHERE i % 20 = 0
   UNION ALL SELECT d, path, i, 1, '#### ' || x, NULL, total FROM dl WHERE i % 5 = 0
   UNION ALL SELECT d, path, i, 1, x, NULL, total FROM dl WHERE i % 5 = 1
   UNION ALL SELECT d, path, i, 1, NULL, (d + i) % {N}, total FROM dl WHERE i % 5 = 2
   UNION ALL SELECT d, path, i, 2, NULL, (d + i + 7) % {N}, total FROM dl WHERE i % 5 = 2
   UNION ALL SELECT d, path, i, 1, '#### /add src/p' || d || '.py now', NULL, total FROM dl WHERE i % 5 = 3
   UNION ALL SELECT d, path, i, 2, '#### ' || x, NULL, total FROM dl WHERE i % 5 = 3
   UNION ALL SELECT d, path, i, 1, '', NULL, total FROM dl WHERE i % 5 = 4
   UNION ALL SELECT d, path, i, 2, x, NULL, total FROM dl WHERE i % 5 = 4
   UNION ALL SELECT d, path, i, 3, NULL, (d * 3 + i) % {N}, total FROM dl WHERE i % 5 = 4),
lines0 AS (SELECT r.d, r.path, r.i, r.sub, r.n, r.total, coalesce(r.raw, '> ' || replace(t.text, '{{d}}', r.d::VARCHAR)) AS raw,
   row_number() OVER (PARTITION BY r.path ORDER BY r.i, r.sub) AS line_no,
   r.i = last_value(r.i) OVER (PARTITION BY r.path ORDER BY r.i, r.sub ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
     AND r.sub = last_value(r.sub) OVER (PARTITION BY r.path ORDER BY r.i, r.sub ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last
   FROM raws r LEFT JOIN tl t ON t.n = r.n),
lines1 AS (SELECT *, CASE WHEN raw LIKE '# aider chat started at _%' THEN 'system' WHEN starts_with(raw, '#### ') THEN 'user'
   WHEN starts_with(raw, '> ') THEN 'tool' ELSE 'assistant' END AS role FROM lines0 WHERE NOT (last AND raw = '')),
lines2 AS (SELECT *, sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY line_no) - 1 AS session_index,
   CASE WHEN role IN ('system', 'tool') OR role IS DISTINCT FROM lag(role) OVER (PARTITION BY path ORDER BY line_no) THEN 1 ELSE 0 END AS st FROM lines1),
lines AS (SELECT *, sum(st) OVER (PARTITION BY path ORDER BY line_no) AS isl FROM lines2 WHERE session_index >= 0),
blk0 AS (SELECT path, d, CAST(session_index AS BIGINT) AS session_index, isl, role, min(line_no) AS start_line, max(line_no) AS end_line, min(n) AS n,
   regexp_replace(string_agg(CASE role WHEN 'user' THEN substr(raw, 6) WHEN 'tool' THEN substr(raw, 3) WHEN 'system' THEN substr(raw, 25) ELSE raw END,
     chr(10) ORDER BY line_no), '\s+$', '') AS content FROM lines GROUP BY ALL),
blk AS (SELECT b.*, row_number() OVER (PARTITION BY path, session_index ORDER BY start_line) AS block_no,
   CASE role WHEN 'system' THEN 'session_start' WHEN 'user' THEN 'user_prompt' WHEN 'tool' THEN t.kind END AS event_kind,
   t.tool, replace(t.target, '{{d}}', d::VARCHAR) AS target, t.ok,
   CASE WHEN role = 'user' AND starts_with(ltrim(content), '/') THEN string_split(ltrim(content), chr(10))[1] END AS user_command
   FROM blk0 b LEFT JOIN tl t ON t.n = b.n AND b.role = 'tool' WHERE role IN ('system', 'tool') OR regexp_matches(content, '\S')),
ses AS (SELECT e.path, e.session_index, start_line, end_line, started_at, command, version, model, git_repo, repo_map, title, block_count,
   'aider:' || substr(sha1(e.path || chr(0) || e.session_index || chr(0) || started_at), 1, 24) AS source_id
   FROM (SELECT path, CAST(session_index AS BIGINT) AS session_index, min(line_no) AS start_line, max(line_no) AS end_line FROM lines GROUP BY 1, 2) e
   JOIN (SELECT path, session_index, max(content) FILTER (role = 'system') AS started_at,
     min_by(content, block_no) FILTER (n IN (0, 1)) AS command,
     min_by(substr(content, 8), block_no) FILTER (n = 2) AS version,
     max_by(substr(content, 8), block_no) FILTER (n = 3) AS model,
     min_by(substr(content, 11), block_no) FILTER (n = 4) AS git_repo,
     min_by(substr(content, 11), block_no) FILTER (n = 5) AS repo_map,
     min_by(substr(regexp_replace(content, '^\s+', ''), 1, 250), block_no) FILTER (role = 'user') AS title, count(*) AS block_count
     FROM blk GROUP BY 1, 2) m ON m.path = e.path AND m.session_index = e.session_index),
chk AS (SELECT s.source_id || '_' || block_no AS chunk_id, s.source_id, block_no AS chunk_number,
   CASE role WHEN 'user' THEN 'user_prompt' WHEN 'tool' THEN 'tool_call' ELSE role END AS type,
   CASE role WHEN 'tool' THEN 'assistant' ELSE role END AS role,
   regexp_replace(CASE WHEN role = 'tool' AND event_kind <> 'raw_status' THEN event_kind || ': ' || content ELSE content END, '^\s+|\s+$', '', 'g') AS content,
   CASE WHEN d % 13 = 0 THEN {MODIFIED} ELSE epoch(CAST(started_at AS TIMESTAMP)) END::BIGINT + block_no - 1 AS timestamp,
   CASE WHEN role = 'tool' THEN tool WHEN event_kind IS NOT NULL THEN 'AiderStatus' END AS tool_name,
   target AS target_file, ok AS success, role AS block_role, event_kind, start_line, end_line, user_command, content AS body, n, d
   FROM blk JOIN (SELECT path, session_index, started_at, source_id FROM ses) s USING (path, session_index)
   WHERE content <> '' OR (role = 'tool' AND event_kind <> 'raw_status'))
"""

QUERIES = {
    "transcript_lines": "SELECT path, CAST(session_index AS BIGINT) AS session_index, line_no, role, CASE WHEN last THEN raw ELSE raw || chr(10) END AS raw FROM lines",
    "transcript_blocks": "SELECT path, session_index, block_no, role, content, start_line, end_line, event_kind FROM blk",
    "transcript_sessions": "SELECT * FROM ses",
    "transcript_events": """SELECT path, block_no, session_index,
  CASE WHEN role = 'user' THEN user_command WHEN n IN (0, 1, 6, 7, 8) THEN content WHEN n = 15 THEN substr(content, 12) END AS f_command,
  CASE WHEN role = 'user' THEN string_split(user_command, ' ')[1] WHEN n IN (6, 7, 8) THEN string_split(content, ' ')[1] END AS f_command_name,
  CASE WHEN role = 'user' AND starts_with(user_command, '/add ') THEN 'context_file' WHEN role = 'user' AND user_command IS NOT NULL THEN 'command' END AS f_command_kind,
  CASE WHEN n = 2 THEN substr(content, 8) END AS f_version, CASE WHEN n = 3 THEN 'prov/m' || d END AS f_model_name,
  CASE WHEN n = 3 THEN 'diff' END AS f_edit_format, target AS f_path, CASE WHEN n = 21 THEN d::VARCHAR END AS f_lines,
  CASE WHEN n = 24 THEN 'y' END AS f_answer, CASE n WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS f_no_git,
  CASE n WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS f_dry_run FROM blk WHERE event_kind IS NOT NULL""",
    "transcript_chunks": "SELECT * EXCLUDE (user_command, body, n, d) FROM chk",
    "transcript_sources": """SELECT source_id, title, 'aider:' || path AS source, model, regexp_replace(path, '/[^/]*$', '') AS primary_cwd,
  started_at AS file_date FROM ses""",
    "transcript_turns": """SELECT chunk_id, source_id, block_role AS role, event_kind, start_line, end_line,
  CASE WHEN block_role = 'user' THEN string_split(user_command, ' ')[1] WHEN n IN (6, 7, 8) THEN string_split(body, ' ')[1] END AS command_name,
  CASE WHEN block_role = 'user' AND starts_with(user_command, '/add ') THEN 'context_file'
       WHEN block_role = 'user' AND user_command IS NOT NULL THEN 'command' END AS command_kind FROM chk""",
    "transcript_tool_events": """SELECT chunk_id, event_kind, CASE WHEN event_kind = 'raw_status' THEN 1 ELSE 0 END AS raw_status,
  '{' || concat_ws(', ', CASE WHEN n = 24 THEN '"answer": "y"' END,
    '"command": ' || CASE WHEN block_role = 'user' THEN coalesce(to_json(user_command)::VARCHAR, 'null') WHEN n IN (0, 1, 6, 7, 8) THEN to_json(body)::VARCHAR
      WHEN n = 15 THEN to_json(substr(body, 12))::VARCHAR END,
    CASE WHEN starts_with(user_command, '/add ') THEN '"command_kind": "context_file"' WHEN user_command IS NOT NULL THEN '"command_kind": "command"' END,
    CASE WHEN user_command IS NOT NULL THEN '"command_name": ' || to_json(string_split(user_command, ' ')[1]) WHEN n IN (6, 7, 8) THEN '"command_name": ' || to_json(string_split(body, ' ')[1]) END,
    CASE n WHEN 0 THEN '"dry_run": true' WHEN 1 THEN '"dry_run": false' END, CASE WHEN n = 3 THEN '"edit_format": "diff"' END,
    '"end_line": ' || end_line, '"event_kind": "' || event_kind || '"', CASE WHEN n = 4 THEN '"git_repo": ' || to_json(substr(body, 11)) END,
    CASE n WHEN 10 THEN '"hash": "ab' || d || '"' WHEN 11 THEN '"hash": "cd' || d || '"' END, CASE WHEN n = 21 THEN '"lines": "' || d || '"' END,
    CASE WHEN n IN (10, 11) THEN '"message": "add file ' || d || '"' END, CASE WHEN n IN (0, 1) THEN '"message_file": false' END,
    CASE n WHEN 0 THEN '"message_mode": false' WHEN 1 THEN '"message_mode": true' END, CASE WHEN n = 3 THEN '"model": ' || to_json(substr(body, 8)) END,
    CASE WHEN n = 3 THEN '"model_name": "prov/m' || d || '"' END, CASE n WHEN 0 THEN '"no_git": true' WHEN 1 THEN '"no_git": false' END,
    '"path": "' || target_file || '"', CASE WHEN block_role = 'tool' THEN '"raw": ' || to_json(body) END, CASE WHEN n = 9 THEN '"received": "30"' END,
    CASE WHEN n = 5 THEN '"repo_map": ' || to_json(substr(body, 11)) END, CASE WHEN n IN (0, 1) THEN '"restore_history": false' END,
    '"role": "' || block_role || '"', CASE WHEN n = 9 THEN '"sent": "' || d || '.5k"' END, CASE WHEN n IN (0, 1) THEN '"show_repo_map": false' END,
    '"start_line": ' || start_line, CASE WHEN n = 2 THEN '"version": ' || to_json(substr(body, 8)) END) || '}' AS event_json
  FROM chk WHERE event_kind IS NOT NULL""",
    "transcript_usage": """SELECT chunk_id, CASE WHEN n = 9 THEN d || '.5k' END AS sent, CASE WHEN n = 9 THEN '30' END AS received
  FROM chk WHERE event_kind = 'usage'""",
    "transcript_git_events": """SELECT chunk_id, event_kind, CASE n WHEN 10 THEN 'ab' ELSE 'cd' END || d AS commit_hash,
  'add file ' || d AS message FROM chk WHERE event_kind IN ('git_commit', 'git_undo')""",
    "transcript_content_store": """SELECT sha256(raw) AS hash, raw AS content, max(strlen(raw)) AS byte_length FROM (
  SELECT CASE WHEN last THEN raw ELSE raw || chr(10) END AS raw FROM lines JOIN tl USING (n)
  WHERE role = 'tool' AND NOT (regexp_replace(substr(raw, 3), '\\s+$', '') = '' AND kind = 'raw_status')) GROUP BY raw""",
    "transcript_coverage": "SELECT event_kind, count(*) AS blocks FROM blk WHERE event_kind IS NOT NULL GROUP BY 1",
    "transcript_unclassified": """SELECT path AS source_path, session_index, start_line, content FROM blk
  WHERE role = 'tool' AND event_kind = 'raw_status'""",
}

INPUT = """
WITH x AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
y AS (SELECT *, CASE WHEN t = '' THEN 1 ELSE 3 END AS h FROM x),
z AS (SELECT *, sum(h) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM y)
SELECT 'doc' || doc_id AS path, '2024-01-01 00:' || lpad((i % 60)::VARCHAR, 2, '0') || ':00' AS timestamp, t || chr(10) || 'second line' AS content,
  CAST(upto - h + 1 AS BIGINT) AS start_line, CAST(upto AS BIGINT) AS end_line FROM z WHERE t <> ''"""

MODEL = """
SELECT conv_id || '-' || turn AS path, CASE role WHEN 'assistant' THEN 'llm_response' ELSE 'to_llm' END AS role,
  '2024-01-0' || (turn + 1) || 'T00:00:00' AS timestamp, regexp_replace(text, '\\s+$', '') AS content, 2 AS start_line,
  3 + len(string_split(text, chr(10))) AS end_line FROM conversations"""

ANALYTICS = """
SELECT 'e' || event_id AS path, 2 AS _line, CASE WHEN event_id % 7 = 0 THEN '_invalid_json' ELSE event_type END AS event,
  CASE WHEN event_id % 7 = 0 THEN '{"event": ' || event_id END AS raw, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user FROM events"""

# Only whole blocks of the half-written file count as stored; the rest of the final file is new.
HIGH_WATER = BASE.replace("WHERE NOT (last AND raw = '')", "WHERE NOT (last AND raw = '')").strip() + """,
hl AS (SELECT * FROM lines1 WHERE i <= total // 2),
h2 AS (SELECT *, sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY line_no) - 1 AS session_index,
   CASE WHEN role IN ('system', 'tool') OR role IS DISTINCT FROM lag(role) OVER (PARTITION BY path ORDER BY line_no) THEN 1 ELSE 0 END AS st FROM hl),
h3 AS (SELECT *, sum(st) OVER (PARTITION BY path ORDER BY line_no) AS isl FROM h2 WHERE session_index >= 0),
h4 AS (SELECT path, session_index, isl, role, min(line_no) AS start_line, min(n) AS n, regexp_replace(string_agg(
   CASE role WHEN 'user' THEN substr(raw, 6) WHEN 'tool' THEN substr(raw, 3) WHEN 'system' THEN substr(raw, 25) ELSE raw END, chr(10) ORDER BY line_no), '\\s+$', '') AS content
   FROM h3 GROUP BY ALL),
h5 AS (SELECT *, row_number() OVER (PARTITION BY path, session_index ORDER BY start_line) AS block_no FROM h4
   WHERE role IN ('system', 'tool') OR regexp_matches(content, '\\S')),
mark AS (SELECT source_id, max(block_no) AS m FROM h5 JOIN ses USING (path, session_index) LEFT JOIN tl ON tl.n = h5.n AND h5.role = 'tool'
   WHERE h5.content <> '' OR (h5.role = 'tool' AND tl.kind <> 'raw_status') GROUP BY 1)
"""

HALF = HIGH_WATER.rstrip() + """,
half AS (SELECT source_id, block_no, CASE WHEN h5.role = 'user' THEN 1 ELSE 0 END AS prompt FROM h5 JOIN ses USING (path, session_index)
   LEFT JOIN tl ON tl.n = h5.n AND h5.role = 'tool' WHERE h5.content <> '' OR (h5.role = 'tool' AND tl.kind <> 'raw_status'))"""

STREAM = HALF + """
SELECT source_id, block_no AS chunk_number, prompt FROM half
UNION ALL SELECT source_id, chunk_number, CASE WHEN type = 'user_prompt' THEN 1 ELSE 0 END FROM chk LEFT JOIN mark USING (source_id)
WHERE chunk_number > coalesce(m, 0)"""

FILES = f"WITH {BASE.strip()},\nf AS (SELECT path, string_agg(raw, chr(10) ORDER BY line_no) AS text FROM lines0 GROUP BY 1)\n"

STATS = HALF + """,
start AS (SELECT source_id, min(timestamp - chunk_number) AS t FROM chk GROUP BY 1),
both_rows AS (SELECT half.source_id, prompt, t + block_no AS ts FROM half JOIN start ON start.source_id = half.source_id
   UNION ALL SELECT source_id, CASE WHEN type = 'user_prompt' THEN 1 ELSE 0 END, timestamp FROM chk LEFT JOIN mark USING (source_id)
   WHERE chunk_number > coalesce(m, 0))
SELECT source_id, count(*) AS message_count, CAST(sum(prompt) AS BIGINT) AS prompt_count, min(ts) AS first_ts, max(ts) AS last_ts
FROM both_rows GROUP BY 1"""

HIGH_WATER += """SELECT chunk_id, chunk_number, content, type FROM chk LEFT JOIN mark USING (source_id) WHERE chunk_number > coalesce(m, 0)"""


def all_sql() -> dict[str, str]:
    out = {name: f"WITH {BASE.strip()}\n{body}" for name, body in QUERIES.items()}
    out["transcript_high_water"] = "WITH " + HIGH_WATER
    out["transcript_line_scan"] = out["transcript_lines"]
    out["transcript_stream"] = "WITH " + STREAM
    out["transcript_scan"] = f"{FILES}SELECT path, strlen(text) AS n_bytes, md5(text) AS digest FROM f"
    out["transcript_signature"] = f"{FILES}SELECT CAST(sum(strlen(text)) AS BIGINT) AS total_size, count(*) AS file_count FROM f"
    out["source_stats"] = "WITH " + STATS
    out["input_history"] = INPUT.strip()
    out["model_log"] = MODEL.strip()
    out["analytics_log"] = ANALYTICS.strip()
    return out
