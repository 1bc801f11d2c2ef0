import math

import pytest

from voltframe.operators import core
from voltframe.operators.assembly import Options, build_network
from voltframe.sources import archive

S = "dam:2026-01-01:he01:r1"
C = "crr:monthly:2026-02:r1"


def frame(spark, rows, columns, types):
    full = {c: types[c] for c in columns}
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], ", ".join(f"{c} {t}" for c, t in full.items()))


TYPES = {c: "string" for c in core.BUS + core.NODE + core.BRANCH + core.RATING + core.OUTAGE + core.MEMBER + core.POINT_BUS}
TYPES |= dict.fromkeys(("kv", "r_pu", "x_pu", "b_pu", "tap_ratio", "angle_deg", "base_mw", "emergency_mw", "rate_c_mw", "factor", "weight", "raw_weight"), "double")
TYPES |= dict.fromkeys(("bus_type", "n_nodes", "bus_number", "n_attachments", "node_number", "node_type", "from_node", "to_node", "from_bus_number", "to_bus_number"), "long")
TYPES |= dict.fromkeys([c for c in TYPES if c.startswith("is_")], "boolean")


def tables(spark):
    """An hourly and an auction model of one grid: A-B-C-D in a line, A-D open, a loop, an island E-F; the auction's A is two nodes that a tie joins."""
    bus, node, branch, rating, outage, member, point = [], [], [], [], [], [], []
    links = [("AB", "A", "B"), ("BC", "B", "C"), ("CD", "C", "D"), ("OPEN", "A", "D"), ("LOOP", "B", "B"), ("EF", "E", "F")]
    number = {k: i for i, k in enumerate("ABCDEF", 1)}
    for s in (S, C):
        bus += [{"snapshot_id": s, "bus_key": k, "kv": 138.0, "bus_type": 3 if k == "D" else 1} for k in "ABCDEF"]
        for name, a, b in links:
            branch.append({"snapshot_id": s, "branch_id": name, "from_bus_key": a, "to_bus_key": b, "from_node": number[a] if s == C else None, "to_node": number[b] if s == C else None, "is_in_service": name != "OPEN", "is_tie": False, "is_secured": name != "BC", "is_name_reversed": name == "CD", "x_pu": 0.1})
            rating.append({"snapshot_id": s, "branch_id": name, "rating_source": "psse_raw" if s == S else "crr_monitored", "time_of_use": None if s == S else "PeakWD", "base_mw": 100.0, "emergency_mw": 0.0})
        outage += [{"snapshot_id": s, "contingency_id": k, "branch_id": b, "element_kind": kind, "operation": "outage", "is_resolved": b is not None} for k, b, kind in (("K", "AB", "branch"), ("K", "EF", "branch"), ("K", None, "branch"), ("K", None, "load"), ("GONE", "EF", "branch"))]
        member += [{"snapshot_id": s, "gtc_id": "G", "branch_id": b, "factor": 1.0, "flow_direction": d, "is_resolved": True} for b, d in (("AB", "To-From"), ("CD", "To-From"), ("EF", "From-To"))]
        point += [{"snapshot_id": s, "settlement_point_id": "P", "bus_key": b, "weight": w, "is_resolved": True} for b, w in (("A", 0.4), ("B", 0.4), ("E", 0.2))]
        point.append({"snapshot_id": s, "settlement_point_id": "Q", "bus_key": "F", "weight": 1.0, "is_resolved": True})
    node += [{"snapshot_id": C, "bus_key": k, "node_number": n, "kv": 138.0, "node_type": 3 if k == "D" else 1, "is_tie_member": k == "A"} for k, n in [*number.items(), ("A", 9)]]
    branch.append({"snapshot_id": C, "branch_id": "TIE", "from_bus_key": "A", "to_bus_key": "A", "from_node": 1, "to_node": 9, "is_in_service": True, "is_tie": True, "x_pu": 1e-4})
    return [frame(spark, r, c, TYPES) for r, c in ((bus, core.BUS), (node, core.NODE), (branch, core.BRANCH), (rating, core.RATING), (outage, core.OUTAGE), (member, core.MEMBER), (point, core.POINT_BUS))]


def of(df, s):
    return [r for r in df.collect() if r["snapshot_id"] == s]


def test_network(spark):
    net = build_network(*tables(spark))
    assert {(r["bus_id"], r["bus_index"]) for r in of(net.buses, S)} == {("A", 0), ("B", 1), ("C", 2), ("D", 3)}
    branches = net.branches.collect()
    hourly = {r["branch_id"]: r for r in branches if r["snapshot_id"] == S}
    assert [hourly[b]["branch_index"] for b in ("AB", "BC", "CD")] == [0, 1, 2] and hourly["AB"]["tap_ratio"] == 1.0
    assert (hourly["AB"]["limit_mw"], hourly["AB"]["contingency_mw"], math.isinf(hourly["BC"]["limit_mw"])) == (100.0, 100.0, True)
    assert {r["branch_id"] for r in branches if r["snapshot_id"] == C} == {"AB", "BC", "CD", "TIE"}
    assert {(r["branch_id"], r["reason"]) for r in of(net.dropped_branches, S)} == {("OPEN", "out_of_service"), ("LOOP", "loop"), ("EF", "island")}
    assert {(r["slack"], r["is_fallback"]) for r in net.slacks.collect()} == {("D", False)}
    cut = {r["contingency_id"]: r for r in of(net.contingencies, S)}
    assert (cut["K"]["branch_indexes"], cut["K"]["n_dropped"], cut["K"]["n_unresolved"], cut["K"]["n_other_rows"], cut["K"]["is_empty"], cut["GONE"]["is_empty"]) == ([0], 1, 1, 1, False, True)
    assert {(r["branch_index"], r["factor"]) for r in of(net.gtc_members, S)} == {(0, -1.0), (2, 1.0)}
    points = net.point_buses.collect()
    assert {(r["bus_index"], round(r["weight"], 9), round(r["weight_dropped"], 9)) for r in points if r["snapshot_id"] == S} == {(0, 0.5, 0.2), (1, 0.5, 0.2)}
    assert sorted(round(r["weight"], 9) for r in points if r["snapshot_id"] == C) == [0.25, 0.25, 0.5]


def test_contracted_network(spark):
    net = build_network(*tables(spark), Options(contract_ties=True))
    assert len(of(net.buses, C)) == 4
    assert ("TIE", "contracted_tie") in {(r["branch_id"], r["reason"]) for r in of(net.dropped_branches, C)}
    with pytest.raises(ValueError, match="no block"):
        Options(time_of_use="never")


def test_archive(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([("x", 1), ("y", 2)], "emil_id string, n long")
    archive.write(a, path, ["emil_id"])
    archive.write(spark.createDataFrame([("y", 3, "new")], "emil_id string, n long, more string"), path, ["emil_id"])
    assert {(r["emil_id"], r["n"], r["more"]) for r in archive.scan(spark, path).collect()} == {("x", 1, None), ("y", 3, "new")}


def test_merges(spark):
    old = spark.createDataFrame([("a", None, 1), ("b", "k", 2)], "x string, y string, n long")
    new = spark.createDataFrame([("a", None, 5), ("c", "k", 6), ("c", "k", 7)], "x string, y string, n long")
    assert sorted(tuple(r) for r in archive.merged(old, new, ["x", "y"]).collect()) == [("a", None, 5), ("b", "k", 2), ("c", "k", 7)]
    assert [r["x"] for r in archive.added(old, new, ["x", "y"]).collect()] == ["c"]
    packages = spark.createDataFrame([("s1",), ("s2",)], "blob_sha256 string")
    done = archive.pending(packages.where("blob_sha256 = 's1'"), spark.createDataFrame([], "artifact_key string"), "1", "t").select("artifact_key")
    assert [r["blob_sha256"] for r in archive.pending(packages, done, "1", "t").collect()] == ["s2"]
    assert archive.pending(packages, done, "2", "t").count() == 2
    docs = spark.createDataFrame([("1", None, "n", None), ("1", None, "n", "2026"), (None, "u", "n", None), (None, None, "n", None)], "doc_id string, url string, name string, posted_at string")
    assert {(r["doc_id"], r["url"], r["posted_at"]) for r in archive.one_document(docs).collect()} == {("1", None, "2026"), (None, "u", None), (None, None, None)}
