"""Labels that spread to the nearest nodes, whole parts in a task or in ranges, against a walk."""

import numpy as np
import pytest

from voltframe.operators import payload


def walked(labels, links):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    best = {}
    for node, label in labels:
        best[node] = min(best.get(node, label), label)
    front = dict(best)
    while front:
        met = {}
        for n, label in front.items():
            for v in near.get(n, ()):
                if v not in best:
                    met[v] = min(met.get(v, label), label)
        best |= met
        front = met
    return best


def frames(spark, labels, links):
    return spark.createDataFrame(labels, "node long, label string"), spark.createDataFrame(links, "a long, b long")


@pytest.mark.parametrize("followed", [100_000, 40])
def test_nearest_labels_against_a_walk(spark, followed):
    rng = np.random.default_rng(5)
    links = [(i, i + 1) for i in range(600)] + [(int(a), int(b)) for a, b in rng.integers(1000, 1150, (170, 2))] + [(2000, 2001), (2001, 2001), (3000, 3001)]
    labels = [(0, "far"), (600, "end"), (300, "middle"), (300, "last"), (2000, "x"), (4000, "alone")] + [(int(n), str(rng.choice(["p", "q", "r"]))) for n in rng.integers(1000, 1150, 12)]
    got = payload.spread_labels(*frames(spark, labels, [*links, (7, None)]), followed).collect()
    want = walked(labels, links)
    assert len(got) == len(want) and {r["node"]: r["label"] for r in got} == want


def test_a_chain_of_hundreds_and_no_labels(spark):
    links = [(i, i + 1) for i in range(450)]
    got = payload.spread_labels(*frames(spark, [(0, "a")], links)).collect()
    assert len(got) == 451 and {r["label"] for r in got} == {"a"}
    assert payload.spread_labels(*frames(spark, [], links)).count() == 0


def test_substations_along_many_matched_lines(spark):
    # 30 substations of two nodes in a row, each joined to the next by a matched line
    inside = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(12)], "a long, b long")
    lines = spark.createDataFrame([(2 * k + 1, 2 * k + 2, f"S{k}", f"S{k + 1}") for k in range(11)], "a long, b long, sa string, sb string")
    nodes = spark.createDataFrame([(0, "S0")], "node long, label string")
    assert dict(map(tuple, payload.substations(nodes, inside, lines).collect())) == {n: f"S{n // 2}" for n in range(24)}


def test_small_parts_are_followed_together(spark):
    rng = np.random.default_rng(8)
    links = [(20 * k + i, 20 * k + i + 1) for k in range(60) for i in range(int(rng.integers(1, 9)))]
    labels = [(20 * k + int(rng.integers(0, 9)), str(rng.choice(["p", "q", "r"]))) for k in range(60) for _ in range(2)]
    labels = [(n, x) for n, x in labels if n in {v for e in links for v in e}]
    got = payload.spread_labels(*frames(spark, labels, links), 100)
    assert "FlatMapCoGroupsInPandas [deal" in got._jdf.queryExecution().executedPlan().toString()
    assert {r["node"]: r["label"] for r in got.collect()} == walked(labels, links)
