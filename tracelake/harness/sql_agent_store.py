"""DuckDB SQL for the made agent store, written from the event columns and not from the JSON."""

BASE = r"""
b AS (SELECT event_id, event_type, user_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k,
   epoch_us(ts) // 1000000 AS sec, CASE WHEN user_id % 2 = 0 THEN (epoch_us(ts) // 1000000) * 1000 ELSE epoch_us(ts) // 1000000 END AS tm,
   'ses_' || user_id AS session_id, 'msg_' || lpad(event_id::VARCHAR, 9, '0') AS message_id, 'prt_' || lpad(event_id::VARCHAR, 9, '0') AS part_id FROM events),
t AS (SELECT *, CASE event_type WHEN 'view' THEN 'read' WHEN 'click' THEN 'bash' WHEN 'purchase' THEN 'apply_patch'
     WHEN 'error' THEN CASE WHEN k % 3 = 2 THEN 'grep' END END AS raw_tool,
   CASE WHEN event_type = 'signup' THEN 'text' WHEN event_type = 'error' AND k % 3 = 0 THEN NULL WHEN event_type = 'error' AND k % 3 = 1 THEN 'patch' ELSE 'tool' END AS kind,
   CASE event_type WHEN 'view' THEN '<content>' || chr(10) || '00001: line ' || k || chr(10) || '00002: value' || chr(10) || chr(10) || '(End of file - total 2 lines)' || chr(10) || '</content>'
     WHEN 'click' THEN CASE WHEN k % 5 = 0 THEN '' ELSE 'out ' || k || chr(10) END WHEN 'purchase' THEN 'done ' || k END AS output,
   CASE WHEN event_type = 'purchase' AND k % 2 = 0 THEN 'P' || k END AS patch_text, CASE WHEN event_type = 'purchase' AND k % 3 = 0 THEN 'D' || k END AS diff,
   CASE event_type WHEN 'view' THEN 'src/f' || k || '.py' WHEN 'purchase' THEN 'src/r' || k || '.py' END AS target,
   CASE WHEN k % 11 = 0 THEN NULL WHEN k % 2 = 0 THEN 'prov/m' || k WHEN k % 4 = 1 THEN 'n' || k END AS model,
   CASE WHEN k % 11 <> 0 AND event_type = 'signup' THEN 'user' ELSE 'assistant' END AS role FROM b),
x AS (SELECT *, CASE
     WHEN kind = 'text' AND k % 6 = 0 THEN NULL WHEN kind = 'text' THEN 'hello ' || k WHEN kind = 'patch' THEN 'Patch: a' || k || ', b'
     WHEN raw_tool = 'read' THEN 'Read: ' || target || chr(10) || output
     WHEN raw_tool = 'bash' THEN 'Bash: run ' || k || CASE WHEN output = '' THEN '' ELSE chr(10) || 'out ' || k END
     WHEN raw_tool = 'apply_patch' THEN 'Edit: ' || target || chr(10) || coalesce(patch_text, diff, output)
     WHEN raw_tool = 'grep' THEN 'grep: t' || k END AS content FROM t),
c AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY tm, message_id) AS n FROM x WHERE content IS NOT NULL AND k <> 13),
chk AS (SELECT 'opencode:' || session_id || '_' || n AS chunk_id, 'opencode:' || session_id AS source_id, n AS chunk_number,
   CASE WHEN kind IN ('tool', 'patch') THEN 'tool_call' WHEN role = 'user' THEN 'user_prompt' ELSE 'assistant' END AS type, role, content,
   CASE WHEN raw_tool = 'read' AND user_id % 2 = 1 THEN sec + 1 ELSE sec END + n AS timestamp,
   CASE WHEN k % 11 <> 0 AND k % 3 = 0 THEN '/w/' || k ELSE '/home/' || user_id END AS cwd, model,
   CASE raw_tool WHEN 'read' THEN 'Read' WHEN 'bash' THEN 'Bash' WHEN 'apply_patch' THEN 'Edit' ELSE raw_tool END AS tool_name,
   CASE WHEN kind = 'tool' THEN target END AS target_file,
   CASE WHEN raw_tool = 'read' THEN TRUE WHEN raw_tool = 'bash' THEN CASE k % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 3 THEN TRUE END
     WHEN raw_tool = 'apply_patch' THEN k % 7 <> 0 END AS success,
   message_id, part_id, kind, raw_tool, event_id, k, output, patch_text, diff FROM c),
bodies AS (
   SELECT chunk_id, CASE WHEN output = '' THEN '{"state": {"input": {"command": "run ' || k || '"}, ' || CASE k % 4 WHEN 0 THEN '"metadata": {"exit": 0}, '
       WHEN 1 THEN '"metadata": {"exit": 1}, ' WHEN 2 THEN '"metadata": {"exit": "x"}, ' ELSE '' END
       || '"output": "", "status": "completed"}, "tool": "bash", "type": "tool"}' ELSE output END AS content FROM chk WHERE raw_tool IN ('read', 'bash', 'apply_patch')
   UNION ALL SELECT chunk_id, '{"state": {"status": "running", "title": "t' || k || '"}, "tool": "grep", "type": "tool"}' FROM chk WHERE raw_tool = 'grep'
   UNION ALL SELECT chunk_id, patch_text FROM chk WHERE patch_text IS NOT NULL
   UNION ALL SELECT chunk_id, 'line ' || k || chr(10) || 'value' || chr(10) FROM chk WHERE raw_tool = 'read')
"""

QUERIES = {
    "store_chunks": "SELECT * EXCLUDE (kind, raw_tool, event_id, k, output, patch_text, diff) FROM chk",
    "store_landed_chunks": "SELECT * EXCLUDE (kind, raw_tool, event_id, k, output, patch_text, diff) FROM chk",
    "store_sources": """SELECT 'opencode:' || session_id AS source_id, 'Work of ' || user_id AS title, 'opencode:' || session_id AS source,
  '/home/' || user_id AS primary_cwd, min(tm)::VARCHAR AS file_date, min_by(model, CAST(tm AS HUGEINT) * 10000000 + event_id) FILTER (model IS NOT NULL) AS model
  FROM t GROUP BY session_id, user_id""",
    "store_sessions": """SELECT 'opencode:' || session_id AS source_id, session_id, 'p' || (user_id % 7) AS project_id,
  CASE WHEN user_id % 5 = 0 THEN 'ses_0' END AS parent_id, 'slug-' || user_id AS slug, '/home/' || user_id AS directory, 'Work of ' || user_id AS title,
  '1.0' AS version, CAST(user_id % 9 AS INTEGER) AS summary_additions, 0 AS summary_deletions, 1 AS summary_files, min(tm) AS time_created,
  max(tm) AS time_updated FROM b GROUP BY session_id, user_id""",
    "store_parts": """SELECT chunk_id, message_id, part_id, kind AS part_type, raw_tool, CASE WHEN raw_tool = 'read' THEN 'c' || event_id END AS call_id,
  CASE WHEN raw_tool IN ('read', 'bash') THEN 'completed' WHEN raw_tool = 'apply_patch' THEN CASE WHEN k % 7 = 0 THEN 'error' ELSE 'completed' END
    WHEN raw_tool = 'grep' THEN 'running' END AS status, CAST(NULL AS VARCHAR) AS snapshot, CAST(NULL AS VARCHAR) AS reason FROM chk""",
    "store_patches": r"""SELECT chunk_id, substr(sha256(d), 1, 16) AS patch_hash,
  CASE kind WHEN 'patch' THEN '["a' || k || '", "b"]' ELSE '[{"relativePath": "src/r' || k || '.py"}]' END AS files_json,
  '{"diff": ' || to_json(d) || '}' AS diff_json FROM (SELECT *, CASE WHEN kind = 'patch' THEN 'Q' || k ELSE coalesce(diff, patch_text,
  '{"state": {"input": {}, "metadata": {"files": [{"relativePath": "src/r' || k || '.py"}]}, "output": "done ' || k || '", "status": "'
  || CASE WHEN k % 7 = 0 THEN 'error' ELSE 'completed' END || '"}, "tool": "apply_patch", "type": "tool"}') END AS d
  FROM chk WHERE kind = 'patch' OR raw_tool = 'apply_patch')""",
    "store_content": "SELECT sha256(content) AS hash, content, strlen(content) AS byte_length FROM bodies GROUP BY content",
    "store_content_edges": "SELECT DISTINCT chunk_id, sha256(content) AS content_hash FROM bodies",
    "store_tool_counts": "SELECT tool_name, success, count(*) AS n FROM chk WHERE tool_name IS NOT NULL GROUP BY 1, 2",
}


def all_sql() -> dict[str, str]:
    return {name: f"WITH {BASE.strip()}\n{body}" for name, body in QUERIES.items()}
