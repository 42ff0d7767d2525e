"""Registered queries over the event-made sessions and messages."""

from __future__ import annotations

from tracelake.harness import events as E
from tracelake.plans import digest, topology


def _seeded(spark, sf):
    s = E.sessions(spark, sf)
    return s, topology.seed(s, E.AS_OF)


def _with_seed(report):
    def run(spark, sf):
        s, seed = _seeded(spark, sf)
        return report(s, seed)

    return run


def _pulse(s, seed):
    return topology.weekly_pulse(s, seed, E.AS_OF)


def _openers(spark, sf):
    s, seed = _seeded(spark, sf)
    return topology.hub_openers(s, E.messages(spark, sf), seed)


def queries() -> dict:
    return {
        "topology_seed": lambda spark, sf: topology.seed(E.sessions(spark, sf), E.AS_OF),
        "topology_communities": _with_seed(topology.communities),
        "topology_hubs": _with_seed(topology.hubs),
        "topology_hub_openers": _openers,
        "topology_bridges": _with_seed(topology.bridges),
        "topology_projects": _with_seed(lambda s, seed: topology.projects(s, seed, E.AS_OF)),
        "topology_weekly_pulse": _with_seed(_pulse),
        "topology_pulse_grid": _with_seed(lambda s, seed: topology.pulse_grid(_pulse(s, seed), topology.weeks_of(E.AS_OF))),
        "lane_timeline": lambda spark, sf: topology.lane_timeline(E.sessions(spark, sf)),
        "digest_inventory": lambda spark, sf: digest.inventory(E.sessions(spark, sf), E.AS_OF),
        "digest_inventory_projects": lambda spark, sf: digest.inventory_projects(E.sessions(spark, sf), E.AS_OF),
        "digest_inventory_document": lambda spark, sf: digest.inventory_document(E.sessions(spark, sf), E.AS_OF),
        "digest_file_hotspots": lambda spark, sf: digest.file_hotspots(E.messages(spark, sf), E.AS_OF),
        "digest_delegations": lambda spark, sf: digest.delegations(
            E.delegation_edges(spark, sf), E.sessions(spark, sf), E.messages(spark, sf), E.AS_OF
        ),
        "digest_open_loops_default": lambda spark, sf: digest.open_loops(E.sessions(spark, sf), E.AS_OF),
        "digest_open_loops": lambda spark, sf: digest.open_loops(E.sessions(spark, sf), E.AS_OF, days=2, large=E.LARGE),
        "digest_work_rhythm": lambda spark, sf: digest.work_rhythm(E.sessions(spark, sf), E.messages(spark, sf), E.LARGE),
        "digest_file_heat": lambda spark, sf: digest.file_heat(E.messages(spark, sf)),
        "tool_success_counts": lambda spark, sf: digest.tool_outcomes(E.messages(spark, sf)),
        "session_messages": E.messages,
        "session_table": E.sessions,
    }
