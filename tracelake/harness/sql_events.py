"""DuckDB SQL for the event-made sessions and messages and the reports on them."""

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

BASE = """
ev AS (SELECT event_id, ts, user_id, event_type, value, props,
              CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k FROM events),
cut AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                        OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 12 HOUR
                       THEN 1 ELSE 0 END AS brk FROM ev),
num AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM cut),
nev AS (SELECT *, row_number() OVER (PARTITION BY user_id, session_no ORDER BY ts, event_id) AS position,
               (CASE WHEN user_id % 11 = 0 THEN 'agent-' WHEN user_id % 13 = 0 THEN 'AGENT-' ELSE 'u' END)
               || user_id || '.' || CAST(session_no AS BIGINT) AS session_id FROM num),
messages AS (SELECT 'm' || event_id AS id, session_id,
   CASE WHEN event_type = 'signup' THEN 'user_prompt' ELSE 'tool_call' END AS type,
   event_type || ' ' || props AS content, position,
   CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS timestamp, ts AS created_at,
   CASE event_type WHEN 'view' THEN 'Read' WHEN 'click' THEN 'Edit' WHEN 'purchase' THEN 'Write' WHEN 'error' THEN 'Bash' END AS tool_name,
   CASE WHEN event_type <> 'signup' THEN 'src/file_' || k || '.py' END AS target_file,
   CASE WHEN event_type <> 'signup' THEN value < 100 END AS success,
   CASE WHEN k % 3 = 0 THEN '["f' || (k % 30) || '"]' END AS file_uuids,
   CASE WHEN k % 3 = 0 THEN 'f' || (k % 30) END AS file_uuid
   FROM nev),
sess0 AS (SELECT session_id, user_id, count(*) AS message_count, min(ts) AS started_at, max(ts) AS ended_at,
   max(value) AS centrality, min_by(event_type, position) AS first_type FROM nev GROUP BY 1, 2),
sessions AS (SELECT session_id, 'Session ' || session_id || ' by ' || user_id AS title,
   CASE WHEN first_type <> 'error' THEN first_type END AS project, message_count, started_at, ended_at,
   CASE WHEN user_id % 10 <> 9 THEN CAST(user_id % 10 AS INTEGER) END AS community_id,
   CASE WHEN user_id % 10 <> 9 THEN 'community ' || (user_id % 10) END AS community_label,
   centrality, CASE WHEN centrality >= 100 THEN 1 ELSE 0 END AS is_hub,
   CASE WHEN centrality >= 60 AND centrality < 100 THEN 1 ELSE 0 END AS is_bridge,
   CASE WHEN message_count > 3 THEN 'fp-' || message_count END AS fingerprint_index FROM sess0),
seed AS (SELECT community_id, community_label, count(*) AS recent_sessions,
   CAST(sum(message_count) AS BIGINT) AS recent_msgs,
   string_agg(DISTINCT project, ',' ORDER BY project) AS projects
   FROM sessions WHERE started_at >= DATE '2024-01-17' AND community_id IS NOT NULL
   GROUP BY 1, 2 HAVING count(*) >= 5),
seeded AS (SELECT * FROM sessions WHERE community_id IN (SELECT community_id FROM seed))
"""


def with_base(body: str) -> str:
    return f"WITH {BASE.strip()}\n{body.strip()}"


# One column per Monday from the week sixty days before 2024-01-31 to its own.
_GRID = ",\n  ".join(
    f"""coalesce(max(c) FILTER (w = DATE '{w}'), '·') AS "{w}\""""
    for w in ("2023-11-27", "2023-12-04", "2023-12-11", "2023-12-18", "2023-12-25", "2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29")
)

QUERIES = {
    "topology_seed": "SELECT community_id, community_label, recent_sessions, recent_msgs, projects FROM seed",
    "topology_communities": """
SELECT community_id, community_label, count(*) AS sessions, CAST(sum(message_count) AS BIGINT) AS total_msgs,
  CAST(sum(is_hub) AS BIGINT) AS hubs, CAST(sum(is_bridge) AS BIGINT) AS bridges,
  round(avg(centrality), 6) AS avg_centrality, max(started_at) AS newest, min(started_at) AS oldest
FROM seeded GROUP BY 1, 2""",
    "topology_hubs": """
SELECT community_label AS community, community_id, rn, session_id, substr(title, 1, 120) AS title,
  coalesce(fingerprint_index, '') AS fingerprint, round(centrality, 6) AS centrality,
  message_count AS msgs, started_at AS started
FROM (SELECT *, row_number() OVER (PARTITION BY community_id ORDER BY centrality DESC, session_id) AS rn
      FROM seeded WHERE is_hub = 1) WHERE rn <= 3""",
    "topology_hub_openers": """
, top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY community_id ORDER BY centrality DESC, session_id) AS rn
      FROM seeded WHERE is_hub = 1) WHERE rn <= 2)
SELECT community, session_id, fingerprint, opener FROM (
  SELECT t.community_label AS community, t.session_id, coalesce(t.fingerprint_index, '') AS fingerprint,
    substr(m.content, 1, 300) AS opener, row_number() OVER (PARTITION BY t.session_id ORDER BY m.position) AS n
  FROM top t JOIN messages m ON m.session_id = t.session_id AND m.type = 'user_prompt') WHERE n = 1""",
    "topology_bridges": """
SELECT session_id, substr(title, 1, 120) AS title, coalesce(fingerprint_index, '') AS fingerprint,
  community_label AS community, round(centrality, 6) AS centrality, message_count AS msgs, started_at AS started
FROM seeded WHERE is_bridge = 1 ORDER BY seeded.centrality DESC, session_id LIMIT 8""",
    "topology_projects": f"""
SELECT project, sessions, total_msgs, first_seen, last_seen,
  CAST(floor((epoch_us(last_seen) // 1000000 - epoch_us(first_seen) // 1000000) / 86400) AS BIGINT) AS days_active,
  CAST(floor(epoch({AS_OF} - last_seen) / 86400) AS BIGINT) AS days_since_last
FROM (SELECT project, count(*) AS sessions, CAST(sum(message_count) AS BIGINT) AS total_msgs,
        min(started_at) AS first_seen, max(started_at) AS last_seen
      FROM seeded WHERE project IS NOT NULL GROUP BY project ORDER BY sessions DESC, project LIMIT 25)""",
    "topology_weekly_pulse": """
SELECT CAST(date_trunc('week', started_at) AS DATE) AS week_start, CAST(date_trunc('week', started_at) AS DATE) + 6 AS week_end,
  community_label AS community, count(*) AS sessions, CAST(sum(message_count) AS BIGINT) AS msgs
FROM seeded WHERE started_at >= DATE '2023-12-02' GROUP BY 1, 2, 3""",
    "topology_pulse_grid": """
, pulse AS (SELECT CAST(date_trunc('week', started_at) AS DATE) AS w, community_label AS community, count(*) AS n
  FROM seeded WHERE started_at >= DATE '2023-12-02' GROUP BY 1, 2),
cells AS (SELECT community, w, repeat('◼', CAST(ceil(5 * n / (SELECT max(n) FROM pulse)) AS BIGINT)) AS c FROM pulse)
SELECT community, """ + _GRID + """
FROM cells GROUP BY community""",
    "lane_timeline": """
SELECT community_id, min(started_at) AS first_activity, max(ended_at) AS last_activity,
  count(DISTINCT date_trunc('week', started_at)) AS active_weeks, count(*) AS sessions
FROM sessions GROUP BY community_id""",
    "digest_inventory": """
SELECT session_id AS id, substr(title, 1, 120) AS title, message_count AS msgs, started_at AS start, ended_at AS "end",
  community_label AS community, round(centrality, 6) AS centrality, is_hub AS hub, is_bridge AS bridge,
  fingerprint_index AS fingerprint
FROM sessions WHERE started_at >= DATE '2024-01-30' AND session_id NOT ILIKE 'agent-%'""",
    "digest_inventory_projects": """
SELECT project, count(*) AS sessions, CAST(sum(message_count) AS BIGINT) AS total_msgs
FROM sessions WHERE started_at >= DATE '2024-01-30' AND session_id NOT ILIKE 'agent-%' GROUP BY project""",
    "digest_inventory_document": """
, r AS (SELECT *, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS s0, strftime(ended_at, '%Y-%m-%d %H:%M:%S') AS e0 FROM sessions
      WHERE started_at >= DATE '2024-01-30' AND session_id NOT ILIKE 'agent-%')
SELECT 'session' AS kind, '{"id":"' || session_id || '","title":"' || substr(title, 1, 120) || '","msgs":' || message_count || ',"start":"' || s0
  || '","end":"' || e0 || '","community":' || coalesce('"' || community_label || '"', 'null') || ',"centrality":' || round(centrality, 6)
  || ',"hub":' || is_hub || ',"bridge":' || is_bridge || ',"fingerprint":' || coalesce('"' || fingerprint_index || '"', 'null') || '}' AS payload FROM r
UNION ALL SELECT 'project', '{"project":' || coalesce('"' || project || '"', 'null') || ',"sessions":' || count(*)
  || ',"total_msgs":' || CAST(sum(message_count) AS BIGINT) || '}' FROM r GROUP BY project""",
    "digest_file_hotspots": """
SELECT file, sessions, ops, tools FROM (
SELECT coalesce(file_uuid, target_file) AS fid, min(target_file) AS file, count(DISTINCT session_id) AS sessions,
  count(*) AS ops, string_agg(DISTINCT tool_name, ',' ORDER BY tool_name) AS tools
FROM messages WHERE created_at >= DATE '2024-01-30' AND tool_name IN ('Edit', 'Write', 'Read') AND target_file IS NOT NULL
GROUP BY 1 ORDER BY ops DESC, fid LIMIT 25)""",
    "digest_delegations": """
SELECT d.session_id AS parent, 'u' || (d.user_id + 1) || '.' || CAST(d.session_no AS BIGINT) AS child,
  CASE WHEN d.value > 20 THEN 'explore' ELSE 'worker' END AS agent_type,
  substr(s.title, 1, 80) AS child_title, s.message_count AS child_msgs
FROM nev d LEFT JOIN sessions s ON s.session_id = 'u' || (d.user_id + 1) || '.' || CAST(d.session_no AS BIGINT)
WHERE d.event_type = 'error' AND d.ts >= DATE '2024-01-30'""",
    "digest_open_loops": """
SELECT session_id AS id, substr(title, 1, 100) AS title, message_count AS msgs, ended_at AS ended,
  CASE WHEN CAST(started_at AS DATE) <> CAST(ended_at AS DATE) THEN 1 ELSE 0 END AS overnight
FROM sessions WHERE started_at >= DATE '2024-01-29' AND session_id NOT ILIKE 'agent-%'
  AND (CAST(started_at AS DATE) <> CAST(ended_at AS DATE) OR message_count > 10)""",
    "digest_work_rhythm": """
, b AS (SELECT date_trunc('hour', created_at) AS hour, count(*) AS messages FROM messages GROUP BY 1),
s AS (SELECT date_trunc('hour', started_at) AS hour, count(*) AS started,
  CAST(sum(CASE WHEN CAST(started_at AS DATE) <> CAST(ended_at AS DATE) THEN 1 ELSE 0 END) AS BIGINT) AS overnight,
  CAST(sum(CASE WHEN message_count > 10 THEN 1 ELSE 0 END) AS BIGINT) AS long_sessions FROM sessions GROUP BY 1)
SELECT hour, coalesce(messages, 0) AS messages, coalesce(started, 0) AS started, coalesce(overnight, 0) AS overnight,
  coalesce(long_sessions, 0) AS long_sessions FROM b FULL JOIN s USING (hour)""",
    "digest_file_heat": """
SELECT target_file, count(DISTINCT session_id) AS sessions, count(*) AS ops FROM messages
WHERE target_file IS NOT NULL GROUP BY 1 HAVING count(DISTINCT session_id) >= 2""",
    "tool_success_counts": """
SELECT tool_name, success, count(*) AS n FROM messages WHERE tool_name IS NOT NULL GROUP BY 1, 2""",
    "session_messages": "SELECT * EXCLUDE (file_uuid) FROM messages",
    "session_table": "SELECT * FROM sessions",
}


QUERIES["digest_open_loops_default"] = QUERIES["digest_open_loops"].replace("2024-01-29", "2024-01-30").replace("message_count > 10", "message_count > 100")


def all_sql() -> dict[str, str]:
    out = {}
    for name, body in QUERIES.items():
        body = body.strip()
        out[name] = f"WITH {BASE.strip()}{body}" if body.startswith(",") else with_base(body)
    return out
