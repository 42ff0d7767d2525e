"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from tracelake.harness import (
    run_agent_store, run_events, run_feeds, run_lineage, run_search, run_transcripts, sql_agent_store, sql_events, sql_feeds,
    sql_lineage, sql_search, sql_transcripts,
)
from tracelake.shipping import ship

QUERY_MODULES = (run_events, run_feeds, run_transcripts, run_agent_store, run_lineage, run_search)
SQL_MODULES = (sql_events, sql_feeds, sql_transcripts, sql_agent_store, sql_lineage, sql_search)


def queries() -> dict:
    out = {}
    for module in QUERY_MODULES:
        out.update(module.queries())
    return {name: _shipped(make) for name, make in out.items()}


def _shipped(make):
    """The query, once the workers have the package."""

    def run(spark, sf):
        ship(spark)
        return make(spark, sf)

    return run


def oracle_sql() -> dict[str, str]:
    out = {}
    for module in SQL_MODULES:
        out.update(module.all_sql())
    return out
