"""Explicit schemas of landed inputs and canonical tables."""

from __future__ import annotations

# Landed records. tag_list and user fields that may be of two shapes stay raw JSON text here.
ARTICLE = """
id long, title string, description string, body_markdown string, url string, published_at string,
positive_reactions_count int, comments_count int, reading_time_minutes int, tag_list string,
user struct<username: string>, feed_kind string, feed string, feed_pos long
"""
ARTICLE_DETAIL = "id long, body_markdown string"
ARTICLE_COMMENTS = "article_id long, tree string"
STORY = """
short_id string, title string, description_plain string, description string, url string, comments_url string,
created_at string, score int, comment_count int, tags string, submitter_user string,
feed_kind string, feed string, feed_pos long
"""
STORY_COMMENT = """
story_id string, pos long, short_id string, comment_plain string, comment string, score int, depth int,
parent_comment string, url string, created_at string, commenting_user string
"""
AGENT_SESSION = """
id string, project_id string, parent_id string, slug string, directory string, title string, version string,
summary_additions int, summary_deletions int, summary_files int, summary_diffs string,
time_created long, time_updated long
"""
AGENT_MESSAGE = "id string, session_id string, time_created long, time_updated long, data string"
AGENT_PART = "id string, message_id string, session_id string, time_created long, time_updated long, data string"

# Canonical tables.
SOURCES = """
source_id string, title string, source string, file_date string, author string, score int, num_comments int,
url string, tags string, reading_time int, story_url string
"""
CHUNKS = "id string, content string, timestamp long"
EDGES = "chunk_id string, source_id string, source_type string, position long"
TYPES = """
chunk_id string, item_type string, author string, score int, url string, tags string, reading_time int,
depth int, parent_id string, comment_id string
"""
SOURCE_GRAPH = "source_id string, centrality double, is_hub int, is_bridge int, community_id int"
META = "key string, value string"
