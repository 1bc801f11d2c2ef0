"""As-of joins, quantiles by selection, revisions and observed measures, against small models."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltframe.functions import stats
from voltframe.operators import asof, build, measures

T0 = dt.datetime(2026, 1, 1)


@pytest.mark.parametrize("together", [100_000, 20])
def test_newest_before(spark, together):
    rng = random.Random(3)
    posted = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), T0 + dt.timedelta(minutes=rng.randrange(0, 4000, 5)), i, f"v{i}") for i in range(300)] + [("a", None, 900, "never"), ("late", T0 + dt.timedelta(days=90), 901, "too late"), ("hot", T0, 902, None)]
    asked = [(i, rng.choice(["hot", "hot", "a", "b", "late", "none", None]), T0 + dt.timedelta(minutes=rng.randrange(0, 4500, 5))) for i in range(300)] + [(1000, "hot", None), (1001, None, None), (5, "hot", T0)]
    right = spark.createDataFrame(posted, "k string, posted timestamp, doc long, value string").repartition(3)
    left = spark.createDataFrame(asked, "id long, k string, at timestamp").repartition(3)
    got = asof.newest_before(left, right, ["k"], "at", "posted", ["doc", "value"], tie="doc", together=together).collect()
    want = []
    for i, k, at in asked:
        some = [(p, d, v) for x, p, d, v in posted if k is not None and at is not None and x == k and p is not None and p <= at]
        want.append((i, k, at, *(max(some, key=lambda x: x[:2])[1:] if some else (None, None))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    with pytest.raises(ValueError):
        asof.newest_before(left, right.withColumnRenamed("value", "id"), ["k"], "at", "posted", ["id"])
    assert asof.newest_before(left.where("false"), right, ["k"], "at", "posted", ["doc"]).count() == 0
    assert asof.newest_before(left, right.where("false"), ["k"], "at", "posted", ["doc"]).where("doc is not null").count() == 0


@pytest.mark.parametrize("few", [1_000_000, 50])
def test_quantiles_of_large_groups(spark, few):
    rng = np.random.default_rng(1)
    groups = {"skewed": np.exp(rng.normal(0, 8, 3000)), "ties": np.repeat([-1.0, 2.0, 2.0, 7.0], 200), "signs": rng.normal(size=501), "small": rng.normal(size=7), "one": np.array([3.0]), None: rng.normal(size=400), "equal": np.full(300, -5.0), "none": np.array([])}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("none", None), ("ties", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r["g"]: r for r in stats.quantiles(df, "x", ["g"], (1.0,), 9, few).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        r = got[g]
        assert r["n"] == len(xs) and r["within_0"] == int((np.abs(xs) <= 1).sum())
        if len(xs):
            want = [*np.quantile(np.abs(xs), [0.5, 0.9, 0.99]), np.abs(xs).max(), np.median(xs)]
            assert [r["abs_p50"], r["abs_p90"], r["abs_p99"], r["abs_max"], r["median"]] == pytest.approx(want, rel=1e-9, abs=1e-8), g
    whole = stats.quantiles(df, "x", None, (), 9, few).first()
    assert whole["median"] == pytest.approx(np.median(np.concatenate(list(groups.values()))), abs=1e-8)


def test_revisions(spark):
    rng = random.Random(8)
    rows = [(m, r, f"e{e}", rng.choice("xyz")) for m in ("A", "B") for r in (1, 2, 4, 7) for e in range(30) if rng.random() < 0.6 for _ in range(rng.randrange(1, 4))] + [("A", 9, "e1", "x"), ("C", 1, "e", "x"), ("A", 1, None, "x")]
    got = {(r["model"], r["revision"]): (r["kept"], r["changed"], r["new"], r["gone"]) for r in build.revisions(spark.createDataFrame(rows, "model string, revision long, entity string, attribute string"), "model", "revision", "entity", "attribute").collect()}
    sets = defaultdict(lambda: defaultdict(set))
    for m, r, e, a in rows:
        if e is not None:
            sets[m, r][e].add(a)
    want = {}
    for m in "ABC":
        order = sorted(r for x, r in sets if x == m)
        for was, now in zip(order, order[1:], strict=False):
            a, b = sets[m, was], sets[m, now]
            both = a.keys() & b.keys()
            want[m, now] = (sum(a[e] == b[e] for e in both), sum(a[e] != b[e] for e in both), len(b.keys() - a.keys()), len(a.keys() - b.keys()))
    assert got == want
    names = spark.createDataFrame([("A", 1, "n", 1), ("A", 1, "n", 2), ("A", 1, "m", 3), ("A", 2, "n", 1), ("A", 2, None, 4)], "model string, revision long, name string, number long")
    assert {r["number"] for r in build.unique_names(names, "model", "revision", "name").collect()} == {3, 1}


def test_observed_measures(spark, tmp_path):
    df = spark.range(100).withColumn("is_ambiguous", F.col("id") % 4 == 0).withColumn("bus_type", F.when(F.col("id") < 3, 3))
    seen = measures.Observed(df, measures.MEASURES["bus"])
    seen.frame.write.parquet(str(tmp_path / "bus"))
    assert seen.rows() == [("TOP-06.swing", 3.0), ("TOP-07.ambiguous", 25.0), ("TOP-07.buses", 100.0)]
    assert measures.Observed(df, {}).rows() == []
    none = measures.Observed(df.where("id < 0"), measures.MEASURES["bus"])
    none.frame.repartition("id").write.parquet(str(tmp_path / "none"))
    assert none.rows() == [("TOP-06.swing", 0.0), ("TOP-07.ambiguous", 0.0), ("TOP-07.buses", 0.0)]
