from datetime import datetime

from test_assembly import S, tables
from voltframe.operators import checks
from voltframe.operators.assembly import build_network


def test_hours(spark):
    rows = [("11/01/2026", "02:00", "Y", 1, "a"), ("11/01/2026", "02:00", "N", 1, "a"), ("11/01/2026", "02:00", "N", 2, "b")]
    got = checks.hour_rows(spark.createDataFrame(rows, "delivery_date string, hour_ending string, dst_flag string, posted_at int, doc_id string")).collect()
    assert sorted((r["interval_start_utc"], r["doc_id"]) for r in got) == [(datetime(2026, 11, 1, 6), "b"), (datetime(2026, 11, 1, 7), "a")]


def test_directions(spark):
    rows = [("A", "B", 1.0, 1.0, "A", "B", 1.0, 1.0), ("A", "B", 1.0, 1.0, "B", "A", 1.0, 1.0), ("A", "B", 1.0, 1.0, "B", "C", 1.0, 1.0), ("A", "A", 138.0, 69.0, "A", "A", 69.04, 138.0), ("A", "A", 69.0, 69.0, "A", "A", 69.0, 69.0), (None, "A", 1.0, 1.0, "A", "A", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "f string, t string, fk double, tk double, a string, b string, ak double, bk double")
    assert [r[0] for r in df.select(checks.row_direction(("f", "t"), ("fk", "tk"), ("a", "b"), ("ak", "bk"))).collect()] == [1, -1, None, -1, None, None]


def test_binding_rows(spark):
    bus, *rest = tables(spark)
    bus = bus.withColumn("substation", bus["bus_key"])
    net = build_network(bus, *rest)
    rows = [(S, n, c, a, b) for n, c, a, b in (("ab", "BASE CASE", "B", "A"), ("AB", "K", "A", "B"), ("B C", "k", "B", "C"), ("BC", "GONE", "B", "C"), ("BC", "new", "B", "C"), ("BC", "K", "X", "C"), ("EF", "K", "E", "F"), ("G", "K", None, None))]
    shadow = spark.createDataFrame([(*r, 138.0, 138.0) for r in rows], "snapshot_id string, constraint_name string, contingency_name string, from_station string, to_station string, from_station_kv double, to_station_kv double")
    gtcs = spark.createDataFrame([(S, "G", 1)], "snapshot_id string, gtc_id string, n_missing int")
    got = {(r["constraint_name"], r["contingency_name"], r["from_station"]): (r["sign"], r["outcome"]) for r in checks.binding(shadow, net, bus, gtcs).collect()}
    assert got == {
        ("ab", "BASE CASE", "B"): (-1, "used_base_case"), ("AB", "K", "A"): (1, "constraint_is_outaged_by_its_contingency"), ("B C", "k", "B"): (1, "used_contingency_partial"),
        ("BC", "GONE", "B"): (1, "binding_under_contingency_absent_in_model"), ("BC", "new", "B"): (1, "contingency_unknown"), ("BC", "K", "X"): (None, "direction_not_recognized"),
        ("EF", "K", "E"): (None, "constraint_not_a_branch"), ("G", "K", None): (None, "used_gtc_crr_members_incomplete"),
    }


def test_names_of_documents(spark):
    listed = spark.createDataFrame([("E", "1", "a b.zip"), ("E", "2", "c"), ("E", "3", "c")], "emil_id string, doc_id string, file_name string")
    names = spark.createDataFrame([("E", "a_b.zip"), ("E", "c.zip"), ("E", "none")], "emil_id string, name string")
    assert {(r["name"], r["doc_id"]) for r in checks.document_of_name(listed, names).collect()} == {("a_b.zip", "1"), ("c.zip", None), ("none", None)}
