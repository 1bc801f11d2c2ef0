"""Hours from networks to residuals, against sums that are written out."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_assembly import S, tables

from voltframe.operators import dc, hours, reports
from voltframe.operators.assembly import build_network

BINDING = f"snapshot_id string, row string, contingency string, branch_index long, sign int, members {hours.MEMBERS}, shadow_price double, published_mw double, limit_mw double, outcome string"


@pytest.mark.parametrize("parts", [1, 3])
def test_hours_against_written_out_sums(spark, parts):
    # a ring 0-1-2-3 with a tail 3-4 and a chord 0-2; contingencies: the tail out, the chord out, an end of the chord moved, partly known ones
    f, t = np.array([0, 1, 2, 3, 3, 0]), np.array([1, 2, 3, 0, 4, 2])
    x = np.array([0.1, 0.2, 0.1, 0.3, 0.1, 0.25])
    outs = {"TAIL": ([4], []), "CHORD": ([5], []), "MOVED": ([], [(5, "to")]), "PART": ([4], [])}
    snapshots = ["a", "b"]
    lines = spark.createDataFrame([(s, j, int(p), int(q), float(v), None, 0) for s in snapshots for j, (p, q, v) in enumerate(zip(f, t, x, strict=True))], "snapshot_id string, branch_index long, from_index long, to_index long, x_pu double, tap_ratio double, slack_index long")
    known = spark.createDataFrame([(s, k.lower() + " line", o, [{"branch_index": j, "split_end": e} for j, e in m]) for s in snapshots for k, (o, m) in outs.items()], f"snapshot_id string, contingency string, out array<bigint>, splits {hours.SPLITS}")
    rows = [
        ("r1", None, 0, 1, None, 10.0, "used_base_case"),
        ("r2", "TAIL LINE", 1, -1, None, 7.0, "used_contingency"),
        ("r3", "Tail Line", 4, 1, None, 5.0, "used_contingency"),
        ("r4", "CHORD LINE", 2, 1, None, 3.0, "used_contingency"),
        ("r5", "MOVED LINE", 0, 1, None, 2.0, "used_contingency_split_bus"),
        ("r6", None, None, None, [(0, 1.0), (2, -0.5)], 4.0, "used_gtc_crr_members"),
        ("r7", "PART LINE", 1, 1, None, 6.0, "used_contingency_partial"),
        ("r8", "NOWHERE", 1, 1, None, 9.0, "contingency_unknown"),
        ("r9", None, 3, 1, None, 1.0, "used_non_topological_contingency"),
    ]
    binding = spark.createDataFrame([(s, r, c, b, g, m and [{"branch_index": j, "factor": v} for j, v in m], mu, 1.0, 10.0, o) for s in snapshots for r, c, b, g, m, mu, o in rows], BINDING)
    weights = {"P": {1: 0.5, 4: 0.5}, "Q": {4: 1.0}, "R": {2: 1.0}}
    w = spark.createDataFrame([(s, p, b, v) for s in snapshots for p, at in weights.items() for b, v in at.items()], "snapshot_id string, point string, bus_index long, weight double")
    q = np.array([0.0, 30.0, -10.0, 5.0, -40.0])
    injections = spark.createDataFrame([(s, b, float(v)) for s in snapshots for b, v in enumerate(q)], "snapshot_id string, bus_index long, mw double")

    solved = hours.solve(lines, known, binding, w, injections, parts).cache()
    assert solved.count() == 2 * 5  # the intact network and four contingencies, however many rows bind
    system = dc.System(5, f, t, x, np.ones(6), 0)
    own, plain, flow, outcome = dict.fromkeys(weights, 0.0), dict.fromkeys(weights, 0.0), {}, {}
    for r, c, b, g, m, mu, o in rows:
        outcome[r] = o
        if not o.startswith("used"):
            continue
        case = system.outaged(*outs[c.split()[0].upper()]) if o.startswith("used_contingency") else system.outaged([])
        factor = sum((v * case.factors([j])[0] for j, v in m), np.zeros(5)) if m else g * case.factors([b])[0]
        if len(case.cut) and o == "used_contingency":
            if not all(case.connected[e] for e in case.ends(b)):
                outcome[r] = "constraint_islanded_by_its_contingency"
                continue
            outcome[r] = "used_contingency_islanding"
        flow[r] = factor @ q
        for p, at in weights.items():
            plain[p] += mu * sum(v * factor[e] for e, v in at.items())
            alive = {e: v for e, v in at.items() if case.connected[e] or outcome[r] != "used_contingency_islanding"}
            own[p] += mu * sum(v * factor[e] for e, v in alive.items()) / sum(alive.values()) if alive else 0.0
    assert {(r["row"], r["outcome"]) for r in hours.outcomes(binding, solved).collect()} == set(outcome.items())
    got = {(r["snapshot_id"], r["row"]): r["our"] for r in hours.hour_flows(binding, solved).withColumn("our", F.col("flow_mw")).collect()}
    assert set(got) == {(s, r) for s in snapshots for r in flow} and all(got[s, r] == pytest.approx(flow[r], abs=1e-6) for s, r in got)
    added = {(r["snapshot_id"], r["point"]): r for r in hours.congestion(solved, w).collect()}
    assert all(added[s, p]["congestion"] == pytest.approx(own[p], abs=1e-6) and added[s, p]["plain"] == pytest.approx(plain[p], abs=1e-6) for s in snapshots for p in weights)
    prices = spark.createDataFrame([(s, p, float(25.0 - own[p])) for s in snapshots for p in weights], "snapshot_id string, point string, price double")
    system_prices = spark.createDataFrame([("a", 25.0)], "snapshot_id string, system_price double")
    report = hours.hour_prices(prices, solved, w, system_prices).collect()
    assert all(r["residual"] == pytest.approx(0, abs=1e-6) for r in report) and {r["source"] for r in report if r["snapshot_id"] == "b"} == {"fitted_median"}
    base = {(r["snapshot_id"], r["branch_index"]): r["flow_mw"] for r in hours.base_flows(solved).collect()}
    assert [base["a", j] for j in range(6)] == pytest.approx(system.flows(q).tolist())
    assert {(r["snapshot_id"], r["bus_index"], r["shadow_price"]) for r in hours.cut_off_prices(solved).collect()} == {(s, 4, 7.0) for s in snapshots}


def test_from_core_tables_to_residuals(spark):
    """Core tables, network, solver and reports in one chain: a line A-B-C-D with the slack at D."""
    net = build_network(*tables(spark))
    at = {r["branch_id"]: r["branch_index"] for r in net.branches.where(F.col(S_) == S).collect()}
    binding = spark.createDataFrame([(S, "1", "K", at["BC"], 1, None, 8.0, -2.0, 100.0, "used_contingency_partial"), (S, "2", "Base Case", at["CD"], -1, None, 2.0, 3.0, 100.0, "used_base_case")], BINDING)
    injections = spark.createDataFrame([(S, 0, 5.0), (S, 1, 3.0)], "snapshot_id string, bus_index long, mw double")
    solved = hours.solve(net.solver_rows().where(F.col(S_) == S), net.cases(), binding, net.weights(), injections)
    flows = {r["row"]: r["flow_mw"] for r in hours.hour_flows(binding, solved).collect()}
    # with A-B out, A's injection is gone; in the base case all goes to D
    assert flows == {"1": pytest.approx(3.0), "2": pytest.approx(-8.0)}
    added = {r["point"]: r for r in hours.congestion(solved, net.weights().where(F.col(S_) == S)).collect()}
    # P is half at A, half at B: under K only B moves anything on B-C, by plain weights as the contingency is partly known
    assert added["P"]["congestion"] == pytest.approx(8.0 * 0.5 - 2.0) and added["P"]["plain"] == pytest.approx(8.0 * 0.5 - 2.0)
    loads = reports.loadings(hours.base_flows(solved), net.branches.withColumn("is_limited", F.lit(True))).collect()
    assert {r["branch_index"]: r["loading"] for r in loads if r["loading"] is not None and r["snapshot_id"] == S}[at["AB"]] == pytest.approx(0.05)


S_ = "snapshot_id"


def test_flows_halfway_between_roundings(spark):
    # in a network of 25 buses that are all linked a branch carries a 25th of what its ends' injections differ by
    pairs = [(a, b) for a in range(25) for b in range(a + 1, 25)]
    lines = spark.createDataFrame([("s", j, a, b, 0.1, 1.0, 0) for j, (a, b) in enumerate(pairs)], "snapshot_id string, branch_index long, from_index long, to_index long, x_pu double, tap_ratio double, slack_index long")
    j = pairs.index((18, 21))
    binding = spark.createDataFrame([("s", f"{sign}/{u}", f"L{u}" if u else None, j, sign, None, 1.0, published, 1000.0, "used_contingency" if u else "used_base_case") for sign, u, published in ((1, 0, 1338.0), (-1, 0, -71.9031), (1, 2, 144.0))], f"snapshot_id string, row string, contingency string, branch_index long, sign int, members {hours.MEMBERS}, shadow_price double, published_mw double, limit_mw double, outcome string")
    known = spark.createDataFrame([("s", "L2", [pairs.index((2, 12))], [])], f"snapshot_id string, contingency string, out array<long>, splits {hours.SPLITS}")
    weights = spark.createDataFrame([], "snapshot_id string, point string, bus_index long, weight double")
    injections = spark.createDataFrame([("s", 18, 12542.01867), ("s", 21, 9494.43117), *[("s", b, 1000.0 / (b + 1)) for b in range(18)]], "snapshot_id string, bus_index long, mw double")
    got = {r["row"]: r for r in hours.hour_flows(binding, hours.solve(lines, known, binding, weights, injections)).collect()}
    assert {k: (r["flow_mw"], r["difference"]) for k, r in got.items()} == {"1/0": (121.9035, -1216.0965), "-1/0": (-121.9035, -50.0004), "1/2": (121.9035, -22.0965)}
    assert got["-1/0"]["within_5_percent"] and not got["-1/0"]["is_opposite"]
