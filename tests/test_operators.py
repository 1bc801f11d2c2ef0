import numpy as np
from pyspark.sql import functions as F

from voltframe.functions import stats, text
from voltframe.operators import dc, graph, identity, network
from voltframe.operators import relational as rel


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_awards_net(spark):
    df = spark.createDataFrame([("h", "A", "gen", 100.0), ("h", "A", "gen", None), ("h", "A", "ptp", 40.0), ("h", "B", "ptp", -40.0)], "hour string, point string, kind string, mw double")
    assert rows(rel.net_by_kind(df, ["hour", "point"], ["gen", "ptp"])) == [("h", "A", 100.0, 40.0, 140.0), ("h", "B", None, -40.0, -40.0)]
    assert rows(rel.balance(df, ["hour"], ["gen", "ptp"])) == [("h", 100.0, 0.0, 100.0, 100.0, 1.0)]


def test_latest_and_revision(spark):
    df = spark.createDataFrame([("k", None, "z"), ("k", 5, "9"), ("k", 5, "10")], "k string, t int, id string")
    assert rows(rel.latest(df, ["k"], "t", "id")) == [("k", 5, "10")]
    assert {r["id"]: r["revision"] for r in rel.revision(df, ["k"], "t", "id").collect()} == {"z": 0, "9": 1, "10": 2}


def test_null_keys(spark):
    df, other = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (None,)], "k int")
    assert rows(rel.anti(df, other, "k")) == [(1,)]
    assert rows(rel.resolved(df, other, "k")) == [(2, True), (None, False), (None, False)]


def test_weights(spark):
    df = spark.createDataFrame([("H", "A", 1.0, True), ("H", "A", 1.0, True), ("H", "C", 2.0, True), ("Z", "A", 0.0, True), ("Q", None, 3.0, False)], "p string, b string, w double, is_resolved boolean")
    got = {(r["p"], r["b"]): r["weight"] for r in rel.normalized(df, "p", "b", "w").collect()}
    assert got == {("H", "A"): 0.5, ("H", "C"): 0.5, ("Z", "A"): None, ("Q", None): None}


def test_cascade_leaves_repeated_keys(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "a int, k string")
    b = spark.createDataFrame([(10, "x"), (11, "y")], "b int, k string")
    assert rows(rel.cascade(a, b, "a", "b", [("name", F.col("k"), F.col("k"))])) == sorted([(1, 10, "name"), (2, None, "unmatched"), (3, None, "unmatched"), (None, 11, "unmatched")], key=repr)


def test_reactance(spark):
    df = spark.createDataFrame([(0.1, 0.104), (0.0001, -0.0002), (0.1, 0.2)], "a double, b double")
    assert [r[0] for r in df.select(rel.agrees(F.col("a"), F.col("b"))).collect()] == [True, True, False]


def test_components(spark):
    nodes = spark.createDataFrame([("s", i) for i in range(6)], "s string, n long")
    edges = spark.createDataFrame([("s", 4, 2, True), ("s", 2, 5, True), ("s", 0, 1, True), ("s", 1, 3, False)], "s string, a long, b long, live boolean")
    assert {r["n"]: r["component"] for r in graph.components(nodes, edges.where("live"), "n", "a", "b", "s").collect()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 2, 5: 2}
    state, branches = graph.main_component(nodes, edges, "n", "a", "b", "s", F.col("live"))
    assert {r["n"]: r["reason"] for r in state.collect()} == {0: "island", 1: "island", 2: None, 3: "isolated", 4: None, 5: None}
    assert {(r["a"], r["b"]): r["reason"] for r in branches.collect()} == {(4, 2): None, (2, 5): None, (0, 1): "island", (1, 3): "out_of_service"}


def test_keys_survive_renumbering(spark):
    a = identity.with_keys(spark.createDataFrame([(1, "L"), (2, "M"), (3, "M")], "n int, label string"), "label", "n")
    b = identity.with_keys(spark.createDataFrame([(7, "L"), (8, "M"), (9, "M")], "n int, label string"), "label", "n")
    assert [r["bus_key"] for r in a.orderBy("n").collect()] == [r["bus_key"] for r in b.orderBy("n").collect()]
    assert [r["is_ambiguous"] for r in a.orderBy("n").collect()] == [False, True, True]


def test_limits_and_sets(spark):
    r = spark.createDataFrame([(True, 10.0, 12.0), (True, 10.0, None), (False, 10.0, 1.0), (True, 0.0, 1.0)], "is_secured boolean, base_mw double, emergency_mw double")
    inf = float("inf")
    assert rows(network.limits(r).select("limit_mw", "contingency_mw")) == sorted([(10.0, 12.0), (10.0, 10.0), (inf, inf), (inf, inf)], key=repr)
    o = spark.createDataFrame([("c", 2, False, False), ("c", 1, False, True), ("d", 3, True, False)], "c string, b int, is_dropped boolean, is_unresolved boolean")
    assert rows(network.outage_sets(o, ["c"], "b")) == [("c", "1|2", 0, 1, False), ("d", None, 1, 0, True)]


def test_dc():
    f, t, x = np.array([0, 1, 2, 2]), np.array([1, 2, 0, 3]), np.full(4, 0.1)
    s = dc.System(4, f, t, x, np.ones(4), 1)
    assert np.allclose(s.factors([0]), [[2 / 3, 0, 1 / 3, 1 / 3]])
    assert np.allclose(s.flows(np.array([90.0, 0, 0, -30])), [50, -10, -40, 30])
    cut = dc.System(4, f, t, x, np.ones(4), 1, (3,))
    assert np.allclose(cut.factors([3]), 0) and cut.factors([]).shape == (0, 4)


def test_stats(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.5,), (None,), (9.0,)], "x double")
    assert rows(stats.histogram(df, "x", [0, 1, 2.5])) == [(1.0, 1), (2.5, 3)]
    assert stats.quantiles(df, "x", within=(1,)).first()["within_0"] == 2


def test_text():
    assert [text.snake_case(x) for x in ("PSS/E Bus Number", "FromBus", "Hour Ending", "R, p.u.")] == ["psse_bus_number", "from_bus", "hour_ending", "r_pu"]
