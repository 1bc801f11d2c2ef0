"""Components of large snapshots, whose edges aren't gathered, and queries over every edge, against a walk from each end."""

import random
from collections import Counter

import duckdb
import pyarrow.parquet as pq
import pytest

from voltframe.operators import graph
from voltframe.plans.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"


def walked(edges):
    """Each end's smallest reachable end."""
    beside = {}
    for a, b in edges:
        beside.setdefault(a, set()).add(b)
        beside.setdefault(b, set()).add(a)
    found = {}
    for least in sorted(beside):
        todo = [] if least in found else [least]
        while todo:
            x = todo.pop()
            if x not in found:
                found[x] = least
                todo += beside[x]
    return found


@pytest.mark.parametrize("gathered", [10, graph.GATHERED])
def test_components_are_what_a_walk_reaches(spark, gathered):
    rng = random.Random(4)
    edges = [(s, f"n{rng.randrange(m):03d}", f"n{rng.randrange(m):03d}") for s, m, n in (("x", 300, 200), ("y", 40, 3), ("z", 100, 400)) for _ in range(n)]
    edges += [("p", f"n{i:03d}", f"n{i + 1:03d}") for i in range(150)] + [("x", None, "n000"), (None, "n000", "n001")]
    nodes = [(s, f"n{i:03d}") for s in "xyzp" for i in range(310)]
    df = graph.components(spark.createDataFrame(nodes, "s string, n string"), spark.createDataFrame(edges, "s string, a string, b string"), "n", "a", "b", "s", gathered=gathered)
    plan = df._jdf.queryExecution().analyzed().toString()
    want = {}
    for s in "xyzp":
        found = walked([(a, b) for t, a, b in edges if t == s and a and b])
        want |= {(s, n): found.get(n, n) for t, n in nodes if t == s}
    got = [(r["s"], r["n"], r["component"]) for r in df.collect()]
    assert len(got) == len(nodes) and {g[:2]: g[2] for g in got} == want
    assert ("Relation [" in plan) == (gathered == 10)  # spread edges are in written tables


def test_every_edge_counts(spark):
    li, o = (pq.read_table(f"{D}/{t}.parquet").to_pylist() for t in ("lineitem", "orders"))
    customer = {r["o_orderkey"]: r["o_custkey"] for r in o}
    ends = {}
    for r in li:
        if r["l_orderkey"] in customer:
            ends.setdefault(r["l_returnflag"], []).append((customer[r["l_orderkey"]] * 2, r["l_suppkey"] * 2 + 1))
    want = {(s, n, c) for s, e in ends.items() for n, c in walked(e).items()}
    assert {tuple(r) for r in QUERIES["whole_connected_components"](spark, D).select("snap", "node", "component").collect()} == want


def test_main_component_takes_every_edge(spark, tmp_path):
    # a large and a small network, a pair, a pair under another flag; no line is a first one of the largest quantity
    rng = random.Random(8)
    lines = [(o, rng.randrange(5), "N", rng.randrange(2, 8), float(rng.randrange(1, 50))) for o in range(20) for _ in range(6)]
    lines += [(o, 10 + rng.randrange(2), "N", 3, 7.0) for o in range(20, 26) for _ in range(3)] + [(30, 20, "N", 2, 50.0), (31, 30, "R", 1, 49.0)]
    db = duckdb.connect()
    db.execute("CREATE TABLE lineitem(l_orderkey BIGINT, l_suppkey BIGINT, l_returnflag VARCHAR, l_linenumber INTEGER, l_quantity DOUBLE)")
    db.executemany("INSERT INTO lineitem VALUES (?, ?, ?, ?, ?)", lines)
    db.execute("CREATE TABLE orders AS SELECT CAST(i AS BIGINT) AS o_orderkey, CAST(100 + i AS BIGINT) AS o_custkey FROM range(40) r(i)")
    for t in ("lineitem", "orders"):
        db.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet'")
    want = set()
    for s in ("N", "R"):
        found = walked([((100 + o) * 2, k * 2 + 1) for o, k, f, _, _ in lines if f == s])
        size = Counter(found.values())
        main = max(size, key=lambda c: (size[c], c))
        want |= {(s, x, None if c == main else "island") for x, c in found.items()}
    got = {tuple(r) for r in QUERIES["main_component"](spark, str(tmp_path)).select("snap", "node", "reason").collect()}
    assert got == want == set(db.execute(f"SELECT snap, node, reason FROM ({ORACLES['main_component']})").fetchall())
    assert {r[2] for r in got} == {None, "island"}


def test_what_a_task_sends_is_a_forest(spark):
    rng = random.Random(6)
    edges = [(s, rng.randrange(60), 100 + rng.randrange(40)) for s in ("x", "y") for _ in range(3000)]
    df = spark.createDataFrame([*edges, ("x", 5, 5), (None, 1, 2)], "s string, a long, b long").coalesce(1)
    sent = graph.forests(df, "s").collect()
    for s in ("x", "y"):
        want = walked([(a, b) for t, a, b in edges if t == s])
        some = [(r["a"], r["b"]) for r in sent if r["s"] == s]
        assert len(some) < len(want) and walked(some) == want
    assert [(r["a"], r["b"]) for r in sent if r["s"] is None] == [(2, 1)]
