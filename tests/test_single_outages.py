"""Every branch out alone, against networks that are solved anew, and meshes in several parts against SQL."""

import duckdb
import numpy as np
import pytest

import voltframe.plans.network_queries  # noqa: F401
from voltframe.operators import dc, outages
from voltframe.plans.queries import ORACLES, QUERIES


def solved_anew(n, f, t, y, q, slack, j):
    """What the other branches carry away from the ends of branch j, by a solution of the network without it: mw by end; None where it splits the network."""
    live = np.arange(len(f)) != j
    if not dc.reached(n, f[live], t[live], slack).all():
        return None
    a = np.zeros((n, n))
    for p, q_, v in ((f, f, y), (t, t, y), (f, t, -y), (t, f, -y)):
        np.add.at(a, (p[live], q_[live]), v[live])
    keep = np.arange(n) != slack
    theta = np.zeros(n)
    theta[keep] = np.linalg.solve(a[np.ix_(keep, keep)], q[keep])
    flow = np.where(live, y * (theta[f] - theta[t]), 0.0)
    net = np.bincount(f, flow, n) - np.bincount(t, flow, n)
    return net[f[j]], net[t[j]]


@pytest.mark.parametrize("kept", [1 << 23, 60])
@pytest.mark.parametrize("seed", range(6))
def test_single_outages_against_networks_solved_anew(monkeypatch, seed, kept):
    # 60 numbers at once: angles come in runs of a column or a few, by sparse elimination
    monkeypatch.setattr(dc, "KEPT", kept)
    rng = np.random.default_rng(seed)
    n = int(rng.integers(9, 60))
    extra = int(rng.integers(n, 3 * n))
    f, t = np.concatenate([np.arange(n - 1), rng.integers(0, n, extra)]), np.concatenate([np.arange(1, n), rng.integers(0, n, extra)])
    f, t = f[f != t], t[f != t]
    y, q, slack = 1 / rng.uniform(0.05, 1, len(f)), rng.normal(size=n), int(rng.integers(n))
    alone, left, right = outages.single(n, f, t, y, q, slack)
    whole = 0
    for j in range(len(f)):
        if want := solved_anew(n, f, t, y, q, slack, j):
            assert (left[j], right[j]) == pytest.approx(want, abs=1e-6) and not alone[j]
            whole += 1
    assert whole > n / 2


def loops(seed, n, extra):
    """A line of n buses and random branches between them, some parallel: f, t, y, q, slack."""
    rng = np.random.default_rng(seed)
    f, t = np.concatenate([np.arange(n - 1), rng.integers(0, n, extra)]), np.concatenate([np.arange(1, n), rng.integers(0, n, extra)])
    f, t = f[f != t], t[f != t]
    return f, t, 1 / rng.uniform(0.05, 1, len(f)), rng.normal(size=n), int(rng.integers(n))


@pytest.mark.parametrize("seed", range(4))
def test_parts_that_fit_one_array_arent_eliminated_bus_by_bus(monkeypatch, seed):
    # a mesh of thousands of buses fills in; its elimination by fronts didn't end
    monkeypatch.setattr(dc, "KEPT", 60)
    monkeypatch.setattr(dc, "System", None)
    f, t, y, q, slack = loops(seed, 40, 70)
    alone, left, right = outages.single(40, f, t, y, q, slack)
    for j in range(len(f)):
        if want := solved_anew(40, f, t, y, q, slack, j):
            assert (left[j], right[j]) == pytest.approx(want, abs=1e-6) and not alone[j]


@pytest.mark.parametrize("kept", [1 << 23, 60])
def test_larger_parts_and_negative_reactances(monkeypatch, kept):
    monkeypatch.setattr(dc, "KEPT", kept)
    f, t, y, q, slack = loops(5, 30, 60)
    array = outages.single(30, f, t, y, q, slack)
    monkeypatch.setattr(outages, "DENSE", 100)
    for one, other in zip(array, outages.single(30, f, t, y, q, slack), strict=True):
        np.testing.assert_allclose(one, other, atol=1e-6)
    monkeypatch.undo()
    monkeypatch.setattr(dc, "KEPT", kept)
    y[::7] *= -0.1
    alone, left, right = outages.single(30, f, t, y, q, slack)
    for j in np.flatnonzero(np.isfinite(left)):
        if want := solved_anew(30, f, t, y, q, slack, j):
            assert (left[j], right[j]) == pytest.approx(want, abs=1e-5)


def test_an_array_is_inverted_by_halves():
    a = np.random.default_rng(0).normal(size=(700, 900))
    a = a @ a.T
    got = a.copy()
    outages.inverted(got)
    np.testing.assert_allclose(got @ a, np.eye(700), atol=1e-8)


def test_networks_that_an_outage_splits():
    # a line A-B-C-D with a second way between B and C; C's branch to D and A's to B are bridges to single buses
    f, t, y = np.array([0, 1, 1, 2]), np.array([1, 2, 2, 3]), np.ones(4)
    q = np.array([5.0, 3.0, 0.0, -8.0])
    alone, left, right = outages.single(4, f, t, y, q, 3)
    assert alone.tolist() == [True, False, False, False]
    assert left.tolist() == [0, 3, 3, 0] and right.tolist() == [3, 0, 0, 0]
    # without the slack none of an outage's ends takes what is left over; with it, the slack does
    alone, left, right = outages.single(4, f, t, y, q, None)
    assert alone.tolist() == [True, False, False, True] and left.tolist() == [0, 3, 3, 0] and right.tolist() == [3, 0, 0, 0]
    # with the slack at B, what A no longer brings is made there
    _, left, right = outages.single(4, f, t, y, q, 1)
    assert left.tolist() == [0, 3, 3, 0] and right.tolist() == [8, 0, 0, 0]


def meshes(folder, links):
    """lineitem and part of (order line, supplier, part, brand, quantity)."""
    db = duckdb.connect()
    db.execute("CREATE TABLE x(n BIGINT, k BIGINT, p BIGINT, b VARCHAR, mw DOUBLE)")
    db.executemany("INSERT INTO x VALUES (?, ?, ?, ?, ?)", links)
    db.execute(f"COPY (SELECT n AS l_orderkey, k AS l_suppkey, p AS l_partkey, mw AS l_quantity FROM x) TO '{folder}/lineitem.parquet'")
    db.execute(f"COPY (SELECT DISTINCT p AS p_partkey, b AS p_brand FROM x) TO '{folder}/part.parquet'")


def check(spark, folder):
    db = duckdb.connect()
    for name in ("lineitem", "part"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    columns = "snapshot_id, supplier, part, n_islanded, part_mw, supplier_mw"
    got = sorted(tuple(r) for r in QUERIES["mesh_outages"](spark, str(folder)).select(*columns.split(", ")).collect())
    assert got == sorted(db.execute(f"SELECT {columns} FROM ({ORACLES['mesh_outages']})").fetchall())
    return got


def test_parts_of_a_mesh_without_the_slack(spark, tmp_path):
    # the same mesh three times, with shifted keys: two copies don't reach the mesh's slack
    rng = np.random.default_rng(0)
    links = [(i, int(k) + 100 * c, int(p) + 1000 * c, f"Brand#{p % 2}", float(mw)) for c in range(3) for i, (k, p, mw) in enumerate(zip(*np.random.default_rng(1).integers(0, [[12], [30], [50]], (3, 400)), strict=True))]
    links = [links[i] for i in rng.permutation(len(links))]
    meshes(tmp_path, links)
    got = check(spark, tmp_path)
    assert any(r[4] for r in got if r[1] >= 200) and all(r[4] < 0 for r in got if r[1] >= 200 and not r[3])


@pytest.mark.parametrize("seed", range(3))
def test_meshes_of_bridges(spark, tmp_path, seed):
    # few links: single pairs, stars, trees and rings, where most outages cut something off
    rng = np.random.default_rng(seed)
    meshes(tmp_path, [(i, int(rng.integers(0, 20)), int(p), f"Brand#{p % 9}", float(rng.integers(1, 50))) for i, p in enumerate(rng.integers(0, 60, 110))])
    got = check(spark, tmp_path)
    assert {r[3] for r in got} == {0, 1}
