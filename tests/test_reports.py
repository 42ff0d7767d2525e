"""Reports on hand-made canonical tables: thresholds, ties, nulls, prefixes."""

import datetime as dt
import json

import pytest

from tracelake.operators import sinks
from tracelake.plans import digest, lineage, topology

AS_OF = "2024-01-31 06:00:00"
SESSION = """session_id string, title string, project string, message_count long, started_at timestamp_ntz, ended_at timestamp_ntz,
community_id int, community_label string, centrality double, is_hub int, is_bridge int, fingerprint_index string"""
MESSAGE = """id string, session_id string, type string, content string, position long, timestamp long, created_at timestamp_ntz,
tool_name string, target_file string, success boolean, file_uuids string"""


def at(text):
    return dt.datetime.fromisoformat(text)


def session(n, community=1, count=10, start="2024-01-30 10:00:00", end="2024-01-30 11:00:00", project="p", score=0.5, hub=0, bridge=0, fp=None):
    label = None if community is None else f"c{community}"
    return (str(n), f"title {n}", project, count, at(start), at(end), community, label, score, hub, bridge, fp)


def message(n, s="a", tool=None, file=None, when="2024-01-30 10:00:00", kind="tool_call", pos=None, uuids=None, ok=True, content="x"):
    t = at(when)
    return (f"m{n}", s, kind, content, n if pos is None else pos, int(t.replace(tzinfo=dt.timezone.utc).timestamp()), t, tool, file, ok, uuids)


@pytest.fixture(scope="module")
def make(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def test_seed_threshold(make):
    rows = [session(f"a{i}", 1, project=["x", "y", None][i % 3]) for i in range(5)]
    rows += [session(f"b{i}", 2) for i in range(4)] + [session(f"n{i}", None) for i in range(9)]
    rows += [session(f"o{i}", 3, start="2024-01-16 23:59:59") for i in range(9)]
    rows += [session(f"e{i}", 4, start="2024-01-17 00:00:00") for i in range(5)]
    seed = topology.seed(make(rows, SESSION), AS_OF)
    got = {r["community_id"]: r for r in seed.collect()}
    assert set(got) == {1, 4} and got[1]["projects"] == "x,y" and got[1]["recent_msgs"] == 50


def test_hubs_break_ties_by_id(make):
    rows = [session(i, 1, hub=1, score=0.9) for i in "edcba"] + [session(f"x{i}", 1) for i in range(3)]
    s = make(rows, SESSION)
    hubs = topology.hubs(s, topology.seed(s, AS_OF)).orderBy("rn").collect()
    assert [r["session_id"] for r in hubs] == ["a", "b", "c"] and hubs[0]["fingerprint"] == ""
    m = make([message(1, "a", kind="user_prompt", pos=5, content="late"), message(2, "a", kind="user_prompt", pos=2, content="early"),
              message(3, "b", kind="assistant", pos=1, content="no")], MESSAGE)
    openers = topology.hub_openers(s, m, topology.seed(s, AS_OF)).collect()
    assert [(r["session_id"], r["opener"]) for r in openers] == [("a", "early")]


def test_bridges_are_limited_and_ordered(make):
    rows = [session(f"s{i:02d}", 1, bridge=1, score=i / 100) for i in range(12)]
    s = make(rows, SESSION)
    got = topology.bridges(s, topology.seed(s, AS_OF)).orderBy("centrality", ascending=False).collect()
    assert [r["session_id"] for r in got] == [f"s{i:02d}" for i in range(11, 3, -1)]


def test_days_are_truncated(make):
    rows = [session(i, 1, start="2024-01-29 23:00:00") for i in "abcd"] + [session("e", 1, start="2024-01-30 22:00:00")]
    s = make(rows, SESSION)
    r = topology.projects(s, topology.seed(s, AS_OF), AS_OF).first()
    assert (r["days_active"], r["days_since_last"]) == (0, 0)


def test_pulse_grid(make):
    rows = [session(f"a{i}", 1, start="2024-01-22 00:00:00") for i in range(10)] + [session("b", 1, start="2024-01-28 23:00:00")]
    rows += [session(f"c{i}", 2, start="2024-01-29 00:00:00") for i in range(5)]
    s = make(rows, SESSION)
    pulse = topology.weekly_pulse(s, topology.seed(s, AS_OF), AS_OF)
    grid = {r["community"]: r for r in topology.pulse_grid(pulse, ["2024-01-22", "2024-01-29"]).collect()}
    assert (grid["c1"]["2024-01-22"], grid["c1"]["2024-01-29"]) == ("◼◼◼◼◼", "·")
    assert (grid["c2"]["2024-01-22"], grid["c2"]["2024-01-29"]) == ("·", "◼◼◼")


def test_agent_sessions_and_open_loops(make):
    rows = [session("agent-1"), session("AGENT-2"), session("u1", count=100), session("u2", count=101),
            session("u3", start="2024-01-30 23:00:00", end="2024-01-31 00:10:00")]
    s = make(rows, SESSION)
    assert {r["id"] for r in digest.inventory(s, AS_OF).collect()} == {"u1", "u2", "u3"}
    assert {(r["id"], r["overnight"]) for r in digest.open_loops(s, AS_OF).collect()} == {("u2", 0), ("u3", 1)}
    doc = sorted((r["kind"], json.loads(r["payload"])["id" if r["kind"] == "session" else "project"]) for r in digest.inventory_document(s, AS_OF).collect())
    assert doc == [("project", "p"), ("session", "u1"), ("session", "u2"), ("session", "u3")]
    rows = [json.loads(r["payload"]) for r in digest.inventory_document(s, AS_OF).collect()]
    assert {"project": "p", "sessions": 3, "total_msgs": 211} in rows and all(r["fingerprint"] is None for r in rows if "id" in r)
    assert digest.inventory_document(s, "2030-01-01 00:00:00").count() == 0


def test_one_file_under_two_paths(make):
    m = make([message(1, "a", "Edit", "old/x.py", uuids='["f1"]'), message(2, "b", "Read", "new/x.py", uuids='["f1"]'),
              message(3, "b", "Bash", "new/x.py"), message(4, "b", "Edit", None), message(5, "b", "Write", "y.py", uuids="[]")], MESSAGE)
    got = {r["file"]: (r["sessions"], r["ops"], r["tools"]) for r in digest.file_hotspots(m, AS_OF).collect()}
    assert got == {"new/x.py": (2, 2, "Edit,Read"), "y.py": (1, 1, "Write")}


def test_delegation_without_child(make):
    edges = make([("m1", "a", "u1", "explore"), ("m2", "a", "missing", "worker"), ("old", "a", "u1", "x")],
                 "chunk_id string, parent_source_id string, child_session_id string, agent_type string")
    m = make([message(1), message(2)], MESSAGE)
    got = {r["child"]: r["child_msgs"] for r in digest.delegations(edges, make([session("u1", count=7)], SESSION), m, AS_OF).collect()}
    assert got == {"u1": 7, "missing": None}


def test_gap_of_exactly_one_hour_stays(make):
    m = make([message(1, "a", "Edit", "f", "2024-01-30 10:00:00"), message(2, "a", "Edit", "f", "2024-01-30 11:00:00"),
              message(3, "a", "Edit", "f", "2024-01-30 12:00:01"), message(4, "a", "Write", "f", "2024-01-30 23:59:59"),
              message(5, "a", "Write", "f", "2024-01-31 00:00:01"), message(6, "a", "Read", "f", "2024-01-31 00:00:01")], MESSAGE)
    got = [(r["unit"], r["ops"], r["first_pos"], r["last_pos"]) for r in lineage.seam_units(m).orderBy("unit").collect()]
    assert got == [(1, 2, 1, 2), (2, 1, 3, 3), (3, 1, 4, 4), (4, 1, 5, 5)]


def test_context_ranges_reach_across_blocks(make):
    m = make([message(i, "a", "Edit" if i == 5 else None, "f", pos=i) for i in range(1, 21)], MESSAGE)
    s = make([session("a", count=20)], SESSION)
    ranges = lineage.context_ranges(lineage.seam_units(m), s, around=6)
    assert [(r["from_pos"], r["to_pos"]) for r in ranges.collect()] == [(1, 11)]
    hit = lineage.context_messages(ranges, m, size=3)
    assert sorted(r["position"] for r in hit.collect()) == list(range(1, 12))


def test_density_shift(make):
    rows, n = [], 0
    for hour, count in ((10, 2), (12, 6), (13, 17), (14, 51)):
        for i in range(count):
            n += 1
            rows.append(message(n, "a", "Edit", "f", f"2024-01-30 {hour}:{i:02d}:00"))
    got = lineage.density_shifts(make(rows, MESSAGE)).orderBy("hour").collect()
    assert [(r["hour"].hour, r["edits"], r["before"]) for r in got] == [(12, 6, 2), (14, 51, 17)]


def test_versions_with_copies(make):
    m = make([message(1, "a", "Write", "f"), message(2, "a", "Edit", "f"), message(3, "b", "Write", "f"), message(4, "b", "Write", "g")], MESSAGE)
    body = json.dumps({"content": "one\ntwo"})
    bodies = make([("m1", body, "Write"), ("m2", "one\ntwo", "_file_backup"), ("m3", json.dumps({"content": "one\nthree\nfour"}), "Write"),
                   ("m4", body, "Write"), ("m2", "{}", "Edit")], "chunk_id string, content string, tool_name string")
    store, edges = sinks.content_store(bodies)
    assert store.count() == 4 and edges.count() == 5
    versions = lineage.recoverable(m, edges, store)
    got = {(r["target_file"], r["version"]): (r["chunk_id"], r["added"], r["removed"]) for r in lineage.version_deltas(versions).collect()}
    assert got == {("f", 1): ("m1", None, None), ("f", 2): ("m2", 0, 0), ("f", 3): ("m3", 2, 1), ("g", 1): ("m4", None, None)}
    assert [r["chunk_id"] for r in lineage.file_versions(versions, "f").collect()] == ["m1", "m2", "m3"]


def test_co_touched_against_brute_force(make):
    import itertools
    import random

    rng = random.Random(3)
    touched = {(f"s{rng.randrange(12)}", f"f{rng.randrange(9)}") for _ in range(60)} | {("s0", f"f{i}") for i in range(9)}
    m = make([message(i, s, "Read", f) for i, (s, f) in enumerate(sorted(touched))], MESSAGE)
    want = {}
    for s in {s for s, _ in touched}:
        for a, b in itertools.permutations([f for t, f in touched if t == s], 2):
            want[(a, b)] = want.get((a, b), 0) + 1
    got = {(r["file"], r["with_file"]): r["sessions"] for r in lineage.co_touched(m, m, min_sessions=2).collect()}
    assert got == {k: v for k, v in want.items() if v >= 2}


def test_assignment_summary(make):
    lanes = make([("a", "x", "hint", "high", "assigned"), ("a", "y", "hint", "low", "assigned"), ("b", "x", "", "", "ambiguous"),
                  ("b", "y", "", "", "ambiguous"), ("c", "", "", "", "excluded")],
                 "session_id string, lane string, evidence string, confidence string, status string")
    s = make([session(x) for x in "abcd"], SESSION)
    r = lineage.assignment_summary(s, lanes).first()
    assert (r["considered"], r["assigned"], r["ambiguous"], r["excluded"], r["workstreams"], r["in_several_lanes"]) == (4, 1, 1, 1, 2, 1)
