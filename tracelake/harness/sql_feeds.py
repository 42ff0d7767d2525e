"""DuckDB SQL for the feed-made cells, written from the source tables and not from the JSON."""

BASE = r"""
art0 AS (SELECT doc_id, doc_id + 1 AS id, text, lang, source AS src, n_chars,
   string_split(text, chr(10))[1] AS title,
   text AS body,
   CASE WHEN doc_id % 97 = 0 THEN 0 ELSE 1704067200 + (doc_id * 7919) % 2592000 END AS created_utc,
   1704067200 + (doc_id * 7919) % 2592000 AS t0,
   CASE WHEN doc_id % 10 = 9 THEN '[]' ELSE '["' || lang || '", "' || source || '"]' END AS tags FROM documents),
heads AS (SELECT CAST(id AS VARCHAR) AS id, 'article' AS type, 'user' || (doc_id % 50) AS author, title, body,
   regexp_replace(title || chr(10) || chr(10) || body, '^\s+|\s+$', '', 'g') AS content,
   CAST(n_chars % 500 AS INTEGER) AS score, CAST(len(string_split(text, chr(10))) AS INTEGER) AS num_comments,
   'https://example.org/a/' || doc_id AS url, created_utc, tags, CAST(n_chars // 1000 AS INTEGER) AS reading_time,
   '' AS story_url, 'tag' AS feed_kind, lang AS feed, doc_id AS feed_pos, doc_id, src, lang FROM art0),
ln AS (SELECT doc_id, t0, unnest(string_split(text, chr(10))) AS line,
   generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM art0),
sn AS (SELECT doc_id, t0, i, unnest(string_split(line, '. ')) AS s, generate_subscripts(string_split(line, '. '), 1) - 1 AS j FROM ln),
nodes AS (
   SELECT doc_id, i, -1 AS j, doc_id || '-' || i AS comment_id, '' AS parent_id, 'u' || ((doc_id + i) % 40) AS author,
     line AS raw, t0 + (doc_id * 31 + i * 37) % 5000 AS created_utc FROM ln
   UNION ALL
   SELECT doc_id, i, j, doc_id || '-' || i || '-' || j, doc_id || '-' || i, 'u' || ((doc_id + j) % 30),
     s, t0 + (doc_id * 31 + i * 37 + j * 101 + 500) % 5000 FROM sn),
com AS (SELECT CAST(doc_id + 1 AS VARCHAR) AS head_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1 AS dfs_pos,
   comment_id, 'comment' AS type, author,
   CASE WHEN length(raw) % 17 = 0 THEN '[deleted]'
        ELSE regexp_replace(regexp_replace(raw, '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') END AS content,
   created_utc, parent_id FROM nodes),
placed AS (SELECT *, row_number() OVER (PARTITION BY head_id ORDER BY created_utc, dfs_pos) AS position FROM com),
arows AS (
   SELECT 'devto_' || id || ':0' AS id, CASE WHEN content = '' THEN title ELSE content END AS content, created_utc AS timestamp,
     'devto_' || id AS source_id, 0 AS position, 'article' AS type, author, score, url, tags, reading_time FROM heads
   UNION ALL
   SELECT 'devto_' || head_id || ':' || position, content, created_utc, 'devto_' || head_id, position, 'comment', author, 0, '', '[]', 0
   FROM placed WHERE content NOT IN ('', '[deleted]', '[removed]')),
graph0 AS (SELECT 'devto_' || id AS source_id, CAST(id AS BIGINT) AS n FROM heads
   UNION ALL SELECT 'lob_c' || conv_id, conv_id FROM conversations WHERE turn = 0),
graph AS (SELECT source_id, ((n * 37) % 1000) / 1000.0::DOUBLE AS centrality, CASE WHEN n % 20 = 0 THEN 1 ELSE 0 END AS is_hub,
   CASE WHEN n % 15 = 0 THEN 1 ELSE 0 END AS is_bridge, CAST(n % 8 AS INTEGER) AS community_id FROM graph0 WHERE n % 9 <> 4),
achunks AS (SELECT r.id, r.content, r.timestamp, make_timestamp(r.timestamp::BIGINT * 1000000) AS created_at, r.type, r.source_id, r.position,
   h.title, h.url AS article_url, h.score AS article_score, h.num_comments AS article_comments, r.author, r.score, r.url,
   r.tags, r.reading_time, g.centrality, g.is_hub, g.is_bridge, g.community_id
   FROM arows r JOIN heads h ON r.source_id = 'devto_' || h.id LEFT JOIN graph g ON g.source_id = r.source_id),
sheads AS (SELECT 'c' || conv_id AS id, 'story' AS type, 's' || (conv_id % 25) AS author,
   string_split(text, chr(10))[1] AS title, CASE WHEN conv_id % 6 = 0 THEN '' ELSE text END AS body,
   CASE WHEN conv_id % 6 = 0 THEN string_split(text, chr(10))[1]
        ELSE regexp_replace(string_split(text, chr(10))[1] || chr(10) || chr(10) || text, '^\s+|\s+$', '', 'g') END AS content,
   CAST(length(text) % 100 AS INTEGER) AS score, CAST(conv_id % 10 AS INTEGER) AS num_comments,
   CASE WHEN conv_id % 5 = 0 THEN 'https://lobste.rs/s/c' ELSE 'https://example.org/t/c' END || conv_id AS url,
   1704067200 + (conv_id * 86413) % 2592000 AS created_utc,
   CASE conv_id % 4 WHEN 0 THEN '["rust"]' WHEN 1 THEN '["rust", "db"]' ELSE '[]' END AS tags,
   CAST(NULL AS INTEGER) AS reading_time, 'https://example.org/s/c' || conv_id AS story_url,
   'newest' AS feed_kind, '1' AS feed, conv_id AS feed_pos FROM conversations WHERE turn = 0),
scom AS (SELECT 'c' || conv_id AS head_id, turn - 1 AS dfs_pos, 'c' || conv_id || '_' || turn AS comment_id, 'comment' AS type,
   role AS author, CASE WHEN length(text) % 11 = 0 THEN '[removed]' WHEN length(text) % 13 = 0 THEN '' ELSE text END AS content,
   CAST(length(text) % 30 AS INTEGER) AS score, 'https://example.org/c/c' || conv_id || '_' || turn AS url,
   1704067200 + (conv_id * 86413) % 2592000 + turn * 60 AS created_utc,
   CASE WHEN turn = 1 THEN '' ELSE 'c' || conv_id || '_' || (turn - 1) END AS parent_id, CAST((turn - 1) % 5 AS INTEGER) AS depth
   FROM conversations WHERE turn > 0),
srows AS (
   SELECT 'lob_' || id || ':0' AS id, CASE WHEN content = '' THEN title ELSE content END AS content, created_utc AS timestamp,
     'lob_' || id AS source_id, 0 AS position, 'story' AS type, author, score, url, tags, 0 AS depth, CAST(NULL AS VARCHAR) AS parent_id,
     CAST(NULL AS VARCHAR) AS comment_id FROM sheads
   UNION ALL
   SELECT 'lob_' || head_id || ':' || position, content, created_utc, 'lob_' || head_id, position, 'comment', author, score, url, NULL, depth,
     parent_id, comment_id
   FROM (SELECT *, row_number() OVER (PARTITION BY head_id ORDER BY dfs_pos) AS position FROM scom)
   WHERE content NOT IN ('', '[deleted]', '[removed]') AND head_id IN (SELECT id FROM sheads)),
schunks AS (SELECT r.id, r.content, r.timestamp, make_timestamp(r.timestamp::BIGINT * 1000000) AS created_at, r.type, r.source_id, r.position,
   h.title, h.url AS thread_url, h.story_url, h.score AS thread_score, h.num_comments AS thread_comments, h.tags AS thread_tags,
   r.author, r.score, r.depth, r.parent_id, r.tags, g.centrality, g.is_hub, g.is_bridge, g.community_id
   FROM srows r JOIN sheads h ON r.source_id = 'lob_' || h.id LEFT JOIN graph g ON g.source_id = r.source_id),
threads AS (SELECT 'lob_' || h.id AS source_id, h.title, h.author, h.score, h.num_comments, h.url, h.story_url, h.tags,
   strftime(make_timestamp(h.created_utc::BIGINT * 1000000), '%y%m%d') AS file_date,
   (SELECT count(*) FROM srows r WHERE r.source_id = 'lob_' || h.id) AS chunk_count, g.centrality, g.is_hub, g.is_bridge, g.community_id
   FROM sheads h LEFT JOIN graph g ON g.source_id = 'lob_' || h.id),
frows AS (SELECT id, title, created_utc, feed_pos, 'tag' AS feed_kind, lang AS feed FROM heads
   UNION ALL SELECT id, title, created_utc, feed_pos, 'tag', src FROM heads
   UNION ALL SELECT id, title, created_utc, feed_pos, 'author', author FROM heads),
frank(feed_kind, feed, feed_rank) AS (VALUES ('tag', 'en', 0), ('tag', 'src3', 1), ('tag', 'fr', 2), ('tag', 'src1', 3), ('author', 'user7', 4), ('author', 'user20', 5)),
flim AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_kind, feed ORDER BY feed_pos, id) AS rn FROM frows
   WHERE created_utc >= 1705000000) WHERE rn <= 10),
funi AS (SELECT * FROM (SELECT f.*, feed_rank, row_number() OVER (PARTITION BY id ORDER BY feed_rank, feed_pos) AS n
   FROM flim f JOIN frank USING (feed_kind, feed)) WHERE n = 1)
"""

_PREVIEW = "substr(content, 1, 500) AS preview"

QUERIES = {
    "article_heads": "SELECT * EXCLUDE (doc_id, src, lang) FROM heads",
    "comment_tree_flat": "SELECT head_id, dfs_pos, position, comment_id, type, author, content, created_utc, parent_id FROM placed",
    "story_heads": "SELECT * FROM sheads",
    "story_comments": "SELECT *, dfs_pos + 1 AS position FROM scom",
    "story_listed_comments": "SELECT *, dfs_pos + 1 AS position FROM scom",
    "feed_recent_limit": "SELECT feed_kind, feed, feed_pos, id FROM flim",
    "feed_dedupe": "SELECT id, feed_kind, feed, feed_rank, title FROM funi",
    "feed_global_limit": """SELECT id, feed_rank, feed_pos FROM (
  SELECT f.*, feed_rank, row_number() OVER (PARTITION BY id ORDER BY feed_rank, feed_pos) AS n
  FROM frows f JOIN frank USING (feed_kind, feed) WHERE created_utc >= 1705000000) WHERE n = 1
  ORDER BY feed_rank, feed_pos, id LIMIT 40""",
    "thread_rows": """SELECT h.id AS head_id, h.created_utc AS head_created, h.title, h.num_comments, p.position, p.comment_id, p.author,
  p.created_utc AS comment_created FROM heads h LEFT JOIN placed p ON p.head_id = h.id""",
    "article_chunk_rows": "SELECT id, content, timestamp FROM arows",
    "article_edges": "SELECT id AS chunk_id, source_id, 'devto' AS source_type, position FROM arows",
    "story_types": """SELECT id AS chunk_id, type AS item_type, author, score, url, tags, CAST(NULL AS INTEGER) AS reading_time, depth,
  parent_id, comment_id FROM srows""",
    "article_sources": """SELECT 'devto_' || id AS source_id, title, url AS source,
  CASE WHEN created_utc = 0 THEN '' ELSE strftime(make_timestamp(created_utc::BIGINT * 1000000), '%y%m%d') END AS file_date,
  author, score, num_comments, url, tags, reading_time, story_url FROM heads""",
    "pull_estimate": """SELECT (SELECT count(*) FROM funi) AS sources,
  (SELECT count(*) FROM funi) + (SELECT count(*) FROM com WHERE head_id IN (SELECT id FROM funi)) AS chunks""",
    "pull_feed_counts": "SELECT feed_kind, feed, count(*) AS articles FROM frows WHERE created_utc >= 1705000000 GROUP BY 1, 2",
    "view_article_chunks": "SELECT * FROM achunks",
    "view_story_chunks": "SELECT * FROM schunks",
    "view_threads": "SELECT * FROM threads",
    "recent_stories": f"""SELECT id, type, created_at, title, author, score, thread_url, story_url, {_PREVIEW} FROM schunks
  WHERE created_at >= TIMESTAMP '2024-01-25' ORDER BY timestamp DESC, id LIMIT 50""",
    "recent_articles": f"""SELECT id, created_at, type, title, author, score, article_url, tags, {_PREVIEW} FROM achunks
  ORDER BY timestamp DESC, id LIMIT 50""",
    "top_stories": f"""SELECT id, type, created_at, title, author, score, thread_score, thread_comments, thread_url, story_url, {_PREVIEW}
  FROM schunks WHERE created_at >= TIMESTAMP '2024-01-02' ORDER BY coalesce(score, 0) DESC, timestamp DESC, id LIMIT 50""",
    "tagged_stories": f"""SELECT id, type, created_at, title, author, score, thread_tags, thread_url, story_url, {_PREVIEW}
  FROM schunks WHERE thread_tags LIKE '%"rust"%' AND created_at >= TIMESTAMP '2024-01-02' ORDER BY timestamp DESC, id LIMIT 50""",
    "articles_by_tag": f"""SELECT id, created_at, type, title, author, score, article_url, tags, {_PREVIEW} FROM achunks
  WHERE tags ILIKE '%SRC1%' ORDER BY timestamp DESC, id LIMIT 50""",
    "article_tag_counts": """SELECT tag, count(DISTINCT id) AS articles FROM (
  SELECT id, lang AS tag FROM heads WHERE tags <> '[]' UNION ALL SELECT id, src FROM heads WHERE tags <> '[]'
  UNION ALL SELECT id, '[]' FROM heads WHERE tags = '[]') GROUP BY tag ORDER BY articles DESC, tag LIMIT 100""",
    "article_tag_counts_inner": """SELECT tag, count(DISTINCT id) AS articles FROM (
  SELECT id, lang AS tag FROM heads WHERE tags <> '[]' UNION ALL SELECT id, src FROM heads WHERE tags <> '[]')
  GROUP BY tag ORDER BY articles DESC, tag LIMIT 30""",
    "articles_by_me": """SELECT id, content, created_at, type, title, author, score, url, article_url, article_score, article_comments,
  tags, reading_time FROM achunks WHERE author IN ('user7', 'u3', 'user20') AND created_at >= TIMESTAMP '2024-01-12'
  ORDER BY created_at DESC, id LIMIT 200""",
    "cell_shape": "SELECT 'chunks' AS what, count(*) AS n FROM arows UNION ALL SELECT 'sources', count(*) FROM heads",
    "random_sample": """SELECT type, title, author, substr(content, 1, 180) AS preview FROM achunks WHERE length(content) > 40
  ORDER BY md5('7' || id), id LIMIT 3""",
    "latest_sample": """SELECT id, created_at, type, title, author, tags, substr(content, 1, 300) AS preview FROM achunks
  ORDER BY timestamp DESC, id LIMIT 3""",
    "top_articles_for_tag": """SELECT title, author, article_score, article_comments, reading_time, article_url FROM achunks
  WHERE type = 'article' AND tags ILIKE '%src2%' ORDER BY article_score DESC, id LIMIT 20""",
    "top_threads": """SELECT title, author, score, num_comments, story_url, url AS thread_url FROM threads
  ORDER BY score DESC, source_id LIMIT 20""",
    "top_threads_for_tag": """SELECT title, author, score, num_comments, story_url, url AS thread_url FROM threads
  WHERE tags LIKE '%"db"%' ORDER BY score DESC, source_id LIMIT 20""",
    "comment_thread": """SELECT position, author, score, substr(content, 1, 500) AS body FROM achunks
  WHERE source_id = 'devto_3' AND type = 'comment'""",
    "story_comment_thread": """SELECT position, depth, author, score, parent_id, substr(content, 1, 500) AS body FROM schunks
  WHERE source_id = 'lob_c3' AND type = 'comment'""",
}

PAGE_TEXT = r"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(
  replace(replace(replace(replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&nbsp;', chr(160)), '&lt;', '<'),
  '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;?', '&', 'g'), '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') AS text FROM pages"""


def all_sql() -> dict[str, str]:
    out = {name: f"WITH {BASE.strip()}\n{body}" for name, body in QUERIES.items()}
    out["page_text"] = PAGE_TEXT.strip()
    return out
