import zipfile

from pyspark.sql import functions as F

from test_assembly import C, S, tables
from voltframe.operators import dc
from voltframe.session import Session
from voltframe.sources import files
from voltframe.sources.columns import fields


def test_incremental_raw(spark, tmp_path):
    box, s = tmp_path / "in", Session(spark, str(tmp_path / "root"))
    box.mkdir()
    with zipfile.ZipFile(box / "a.zip", "w") as z:
        z.writestr("Lines.csv", "A,B\n1,x\n")
        z.writestr("other.txt", "")
    calls = []

    def parse(df):
        calls.append(df.count())
        return files.delimited(df, fields("A:i", "B"))

    s.ingest(str(box), "E")
    s.build_raw("lines", r"Lines\.csv$", parse, "1")
    with zipfile.ZipFile(box / "b.zip", "w") as z:
        z.writestr("Lines.csv", "A,B\n2,y\n3,z\n")
    s.ingest(str(box), "E")
    s.build_raw("lines", r"Lines\.csv$", parse, "1")
    s.build_raw("lines", r"Lines\.csv$", parse, "1")
    assert calls == [1, 1, 0] and s.artifacts().count() == 2
    assert sorted((r["a"], r["b"], r["emil_id"]) for r in s.raw("lines").collect()) == [(1, "x", "E"), (2, "y", "E"), (3, "z", "E")]
    s.build_raw("lines", r"Lines\.csv$", parse, "2")
    assert calls[-1] == 2 and s.raw("lines").count() == 3
    assert sorted(len(r["members"]) for r in s.packages().collect()) == [1, 2]
    assert s.query("SELECT sum(a) AS n FROM {t}", t=s.raw("lines")).first()["n"] == 6


def test_network_flows(spark, tmp_path):
    s = Session(spark, str(tmp_path))
    for name, df in zip(("bus", "node", "branch", "branch_rating", "contingency_outage", "gtc_member", "settlement_point_bus"), tables(spark), strict=True):
        s.write_core(name, df)
    assert {r["snapshot_id"] for r in s.core_rows("bus", S).collect()} == {S} and C in {r["snapshot_id"] for r in s.core("bus").collect()}
    net = s.network([S])
    q = spark.createDataFrame([(S, 0, 10.0), (S, 1, 5.0)], "snapshot_id string, bus_index long, mw double")
    assert sorted((r["branch_index"], r["flow_mw"]) for r in dc.flows(net.solver_rows(), q).collect()) == [(0, 10.0), (1, 15.0), (2, 15.0)]


def test_injections_of_the_latest_posting(spark, tmp_path):
    rows = [("h", "d", "01", "P", "g", 1.0, 1, "a"), ("h", "d", "01", "P", "g", 5.0, 2, "b"), ("h", "d", "01", "P", "x", -2.0, 2, "b")]
    df = spark.createDataFrame(rows, "interval_start_utc string, delivery_date string, hour_ending string, settlement_point string, kind string, mw double, posted_at int, doc_id string")
    assert [r["net_mw"] for r in Session(spark, str(tmp_path)).injections(df, ["g", "x"]).collect()] == [3.0]
