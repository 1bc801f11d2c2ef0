"""Outages and splits of the solver, binding rows with islands, borrowed members, labels, listings, session helpers."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltframe.operators import build, dc, payload, reports
from voltframe.sources import listing

S = "snapshot_id"


def dense(n, f, t, y, slack):
    b = np.zeros((n, n))
    for i, j, v in zip(f, t, y, strict=True):
        b[i, i] += v
        b[j, j] += v
        b[i, j] -= v
        b[j, i] -= v
    keep = [i for i in range(n) if i != slack]
    out = np.zeros((n, n))
    out[np.ix_(keep, keep)] = np.linalg.inv(b[np.ix_(keep, keep)])
    return out


def test_system_against_dense():
    rng = np.random.default_rng(1)
    n = 60
    f = np.append(np.arange(n - 1), rng.integers(0, n, 40))
    t = np.append(np.arange(1, n), (rng.integers(0, n, 40)))
    keep = f != t
    f, t = f[keep], t[keep]
    x = rng.uniform(0.01, 1, len(f))
    x[5] = -0.3  # series compensation
    s = dc.System(n, f, t, x, np.ones(len(f)), 7)
    q = rng.normal(size=n)
    q -= q.mean()
    angle = dense(n, f, t, 1 / x, 7) @ q
    assert np.allclose(s.flows(q), (angle[f] - angle[t]) / x, atol=1e-8)
    inverse = dense(n, f, t, 1 / x, 7)
    assert np.allclose(s.factors([0, 9]), [(inverse[f[m]] - inverse[t[m]]) / x[m] for m in (0, 9)], atol=1e-8)


def test_cases(spark):
    rows = [("s", 0, 0, 1), ("s", 1, 1, 2), ("s", 2, 2, 0), ("s", 3, 2, 3)]
    lines = spark.createDataFrame([(*r, 0.1, None, 1) for r in rows], "snapshot_id string, branch_index long, from_index long, to_index long, x_pu double, tap_ratio double, slack_index long")
    asked = spark.createDataFrame([("s", "none", [], [], [0]), ("s", "tail", [3], [], [0, 3]), ("s", "split", [], [(1, "to")], [0, 1]), ("s", "both", [], [(1, "to"), (3, "from")], [])], "snapshot_id string, contingency string, out array<long>, splits array<struct<branch_index: long, split_end: string>>, wanted array<long>")
    got = {(r["contingency"], r["branch_index"]): r for r in dc.cases(lines, asked, parts=3).collect()}
    assert got["none", 0]["factors"] == pytest.approx([2 / 3, 0, 1 / 3, 1 / 3], abs=1e-6)
    assert got["tail", 0]["cut"] == [3] and got["tail", 0]["n_islanded"] == 1 and got["tail", 3]["factors"] == [0, 0, 0, 0]
    # branch 1 ends in a section of its own: what comes from bus 2 goes by bus 0
    assert got["split", 0]["factors"] == pytest.approx([1, 0, 1, 1]) and got["split", 1]["factors"] == pytest.approx([0] * 4)
    # both ends off bus 2 stay joined: bus 3 hangs on branch 1
    assert got["both", None]["n_islanded"] == 0
    q = spark.createDataFrame([("s", 0, 90.0), ("s", 3, -30.0)], "snapshot_id string, bus_index long, mw double")
    flow = {(r["contingency"], r["branch_index"]): r["flow_mw"] for r in dc.case_flows(dc.cases(lines, asked), q).collect()}
    assert flow["none", 0] == pytest.approx(50) and flow["tail", 0] == pytest.approx(60) and flow["split", 1] == 0
    assert dc.unbalance(lines, dc.flows(lines, q), q).first()["residual"] == pytest.approx(0, abs=1e-6)
    bind = spark.createDataFrame([("s", "tail", 0, "used_contingency"), ("s", "tail", 3, "used_contingency"), ("s", "none", 0, "used_contingency"), ("s", "tail", 3, "contingency_unknown")], "snapshot_id string, contingency string, branch_index long, outcome string")
    found = sorted(r["outcome"] for r in reports.with_islands(bind, lines, dc.cases(lines, asked)).collect())
    assert found == ["constraint_islanded_by_its_contingency", "contingency_unknown", "used_contingency", "used_contingency_islanding"]


def test_borrowed(spark):
    members = spark.createDataFrame([("G", "a", 1.0), ("G", "b", 0.5), ("G", "c", 1.0), ("G", "d", 1.0)], "gtc_id string, branch_id string, factor double")
    ends = spark.createDataFrame([("a", "A", "B"), ("b", "B", "C"), ("c", "X", "Y"), ("d", "A", "B")], "branch_id string, from_bus string, to_bus string")
    pairs = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "crr_branch_id string, dam_branch_id string")
    buses = spark.createDataFrame([("A", "P"), ("B", "Q"), ("C", "R")], "crr_bus string, dam_bus string")
    dam = spark.createDataFrame([("1", 10, "P", "Q"), ("2", 11, "R", "Q"), ("3", 12, "P", "Q")], "branch_id string, branch_index long, from_bus string, to_bus string")
    got = reports.borrowed(members, ends, pairs, buses, dam)
    assert sorted(map(tuple, got.collect())) == [("G", 10, 1.0), ("G", 11, -0.5)]
    assert reports.incomplete(spark.createDataFrame([("G", 4)], "gtc_id string, n_declared long"), got).first()["n_missing"] == 2


def test_substations(spark):
    nodes = spark.createDataFrame([(1, "N"), (9, "M")], "node long, label string")
    inside = spark.createDataFrame([(1, 2), (3, 2), (5, 6), (7, None)], "a long, b long")
    lines = spark.createDataFrame([(3, 5, "N", "E"), (9, 8, "M", "M"), (6, 4, "W", "Z")], "a long, b long, sa string, sb string")
    got = dict(map(tuple, payload.substations(nodes, inside, lines).collect()))
    assert got == {1: "N", 2: "N", 3: "N", 5: "E", 6: "E", 8: "M", 9: "M"}


def test_payload(spark):
    points = spark.createDataFrame([("s", 2, None, "x"), ("s", 1, 345.0, "</script>")], "snapshot_id string, n long, kv double, st string")
    branches = spark.createDataFrame([("s", "L", 1, 2)], "snapshot_id string, id string, f long, t long")
    loads = spark.createDataFrame([], "snapshot_id string, id string, mw double")
    row = payload.models(points, branches, loads).first()
    data = json.loads(row["payload"])
    assert [b["n"] for b in data["buses"]] == [1, 2] and data["buses"][1]["kv"] is None and data["branches"] == [{"id": "L", "f": 1, "t": 2}]
    assert "</script>" not in payload.page(row["payload"]).removesuffix("</script>")


def test_listing(spark):
    fields = spark.createDataFrame([(1, "http://h/x?doclookupId=77&y=1", "f", "g", "2026-01-02", "2026-01-02T03:04:05-06:00", "12", "zip"), (1, "", "f", "g", "", "2026-07-01T00:00:00", "", ""), (1, "", "g", "g", "", "soon", "x", "")], "report_type_id long, URL string, fileName string, reportGroup string, operatingDate string, created string, size string, format string")
    docs = listing.documents(fields)
    rows = docs.orderBy("size_bytes", "file_name").collect()
    assert rows[2]["doc_id"] == "77" and rows[2]["posted_at"] == dt.datetime(2026, 1, 2, 9, 4, 5) and rows[0]["posted_at"] == dt.datetime(2026, 7, 1, 5) and rows[1]["posted_at"] is None
    assert listing.probed(docs, docs).count() == 3 and "url" not in listing.probed(docs, docs).columns
    assert listing.groups(docs).first()["n"] == 3
    with pytest.raises(listing.TooLarge):
        listing.within_limit(docs, 11)
    assert listing.bound("2026-07-01") == listing.bound(dt.date(2026, 7, 1)) and listing.bound("2026-07-01").utcoffset() == dt.timedelta(hours=-5)
    tries = []

    def call():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return "ok"

    assert listing.retrying(call, (OSError,), sleep=lambda s: None) == "ok" and len(tries) == 3
    with pytest.raises(ValueError):
        listing.retrying(lambda: int("x"), (OSError,))


def test_registered(spark):
    rows = spark.createDataFrame([("name",), (None,), ("guess",)], "how string")
    assert build.registered(rows, "how", ["name", "guess"]).count() == 3
    with pytest.raises(build.UnknownLabels, match="guess"):
        build.registered(rows, "how", ["name"])
    assert [r[0] for r in build.in_order(rows, "how").collect()] == ["guess", "name", None]


def test_overrides(spark, tmp_path):
    (tmp_path / "x.csv").write_text("# by hand\ngtl_name,crr_gtc_id\nN,G1\n")
    assert [tuple(r) for r in build.overrides(spark, str(tmp_path / "x.csv"), ["gtl_name", "crr_gtc_id"]).collect()] == [("N", "G1")]


def test_session_helpers(spark, tmp_path):
    from voltframe.session import Session

    s = Session(spark, str(tmp_path))
    rows = [("crr:1", "monthly", None, None, "2026-01-01", 1), ("crr:2", "monthly", None, None, "2026-01-01", 2), ("dam:1", "dam", "2026-01-05", 12, None, 1), ("dam:2", "dam", "2026-01-05", 12, None, 2), ("dam:3", "dam", "2026-01-05", 1, None, 1)]
    snaps = spark.createDataFrame(rows, "snapshot_id string, model_kind string, operating_date string, hour long, month string, revision long")
    s.write_core("snapshot", snaps.withColumns({"operating_date": F.col("operating_date").cast("date"), "month": F.col("month").cast("date")}))
    assert s.newest() == ("crr:2", "dam:2") and s.hour_ids("2026-01-05") == ["dam:3", "dam:2"]
    assert s.snapshot("dam:1")["revision"] == 1
    with pytest.raises(KeyError):
        s.snapshot("dam:9")
    s.record_run("r1", "build", "started")
    s.record_run("r1", "build", "done", 2)
    assert [(r["run_id"], r["state"], r["failed"]) for r in s.runs().collect()] == [("r1", "done", 2)]
    s.write_report("prices", snaps.select(S, "revision"))
    assert spark.read.json(f"{tmp_path}/reports/prices").count() == 5


def test_an_outage_set_of_many_contingencies_is_listed_once(spark):
    lines = spark.createDataFrame([("s", f"P{j}", j, False) for j in range(6)], "snapshot_id string, branch_id string, branch_index long, is_name_reversed boolean")
    rows = spark.createDataFrame([("s", f"P{j}", "From", c) for j in range(7) for c in ("A", "B", "C", None)], "snapshot_id string, device_name string, direction string, contingency string")
    sets, none = {1: [0, 2], 2: [5]}, spark.createDataFrame([], "snapshot_id string, gtc_id string")
    ctg = [("s", c, k, sets[k], n, 0, False) for c, k, n in (("A", 1, 0), ("B", 1, 1), ("C", 2, 0))]
    ctg = spark.createDataFrame(ctg, "snapshot_id string, contingency_id string, outage_set long, branch_indexes array<long>, n_lost int, n_splits int, is_empty boolean")
    members = spark.createDataFrame([("s", k, j) for k, x in sets.items() for j in [*x, x[0]]], "snapshot_id string, outage_set long, branch_index long")
    listed = reports.block_binding(rows, lines, ctg.drop("outage_set"), none).collect()
    apart = reports.block_binding(rows, lines, ctg.drop("branch_indexes"), none, members).collect()
    assert sorted(map(repr, apart)) == sorted(map(repr, listed)) and sum(r["outcome"] == "device_is_outaged_by_its_contingency" for r in apart) == 5
