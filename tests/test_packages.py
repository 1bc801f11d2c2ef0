"""Packages of all families to typed tables in one pass."""

import datetime as dt
import io
import zipfile

import pytest
from test_sources import RAW

from voltframe.session import Session
from voltframe.sources import files, layouts, packages
from voltframe.sources.columns import SourceError


def csv_of(table, *rows, end=""):
    return "\n".join([",".join(f.header for f in layouts.TABLES[table]) + end, *rows]) + "\n"


def row_of(table, **values):
    names = [f.name for f in layouts.TABLES[table]]
    assert not set(values) - set(names)
    return ",".join(str(values.get(n, "")) for n in names)


def members(spark, emil, **content):
    rows = [(emil, "blob", f"m{i}", path.replace("__", "/"), data if isinstance(data, bytes) else data.encode()) for i, (path, data) in enumerate(content.items())]
    return spark.createDataFrame(rows, "emil_id string, blob_sha256 string, member_sha256 string, member_path string, content binary")


def test_every_layout_by_its_header():
    for family in ("dam_prices", "mappings", "disclosure"):
        tables = layouts.FAMILIES[family][1]
        for t in tables:
            same = [x for x in tables if [f.header for f in tables[x]] == [f.header for f in tables[t]]]
            path = f"60d_DAM_{layouts.BY_STEM.get(t, 'Any')}-01-JAN-26.csv" if len(same) > 1 else "x.csv"
            assert packages.table_of(csv_of(t).encode(), tables, path) == t
    with pytest.raises(SourceError):
        packages.table_of(b"A,B\n", layouts.MAPPINGS, "x.csv")
    assert len(layouts.TABLES) == 53 and set(layouts.PRODUCTS.values()) == set(layouts.FAMILIES)


@pytest.mark.parametrize(
    ("family", "path", "kind", "identity"),
    [
        ("crr_model", "a/2026.FEB.Monthly.Auction.NetworkModel_PeakWD_FEB_2026.raw", "raw", {"auction": "monthly", "month": "2026-02-01", "time_of_use": "PeakWD", "term": None, "sequence": None}),
        ("crr_model", "2027.1st6.AnnualAuction.Seq3.Contingencies_MAR_2027.csv", "crr_contingencies", {"auction": "annual", "term": "2027.1st6", "sequence": 3, "month": "2027-03-01", "time_of_use": None}),
        ("crr_model", "x.MappingDocument.xlsx", "sheets", {"auction": None, "term": None, "sequence": None, "month": None, "time_of_use": None}),
        ("crr_model", "2026.FEB.Monthly.Auction.Contingencies.xml", "unknown", {"auction": "monthly", "month": "2026-02-01", "time_of_use": None, "term": None, "sequence": None}),
        ("crr_results", "Common_MarketResults_2026.FEB.Monthly.Auction_AUCTION.CSV", "crr_auction_market_results", {"auction": "monthly", "month": "2026-02-01", "term": None, "sequence": None}),
        ("dam_model", "DAM01022026_ld_007.csv", "dam_loads", {"operating_date": "2026-01-02", "hour": 7}),
        ("dam_model", "DAM01022026_007.raw", "raw", {"operating_date": "2026-01-02", "hour": 7}),
        ("dam_model", "DAM01022026_SpNb.csv", "dam_non_biddable_resource_nodes", {"operating_date": "2026-01-02", "hour": None}),
        ("dam_model", "README_DAM01022026.txt", "unknown", {"operating_date": None, "hour": None}),
        ("disclosure", "60d_DAM_ESR_Data-05-MAR-26.csv", "header", {"operating_date": "2026-03-05"}),
        ("dam_prices", "any.csv", "header", {}),
    ],
)
def test_names_of_members(family, path, kind, identity):
    assert packages.kind_of(path, layouts.FAMILIES[family][0]) == kind
    if not path.startswith("README"):
        assert packages.identity(path, family) == identity


def test_one_pass_over_a_package_of_all_kinds(spark):
    loads = csv_of("dam_loads", row_of("dam_loads", hour="7.0", psse_bus_number=1, load_name=" L 1 ", raw_mw_ldf="0.25"), end=",")
    found = packages.parsed(
        members(spark, "NP4-500-SG", **{"DAM01022026_007.raw": RAW, "DAM01022026_ld_007.csv": "﻿" + loads, "DAM01022026_SpNb.csv": csv_of("dam_non_biddable_resource_nodes"), "README_DAM01022026.txt": "text", "DAM01022026_zz_007.csv": "?"}), "dam_model"
    ).cache()
    kinds = {(r["table"], r["n"]) for r in found.where("row is not null").groupBy("table").count().withColumnRenamed("count", "n").collect()}
    assert {t for t, _ in kinds} >= {"psse_case", "psse_bus", "psse_branch", "psse_transformer", "dam_loads"}
    assert {(r["table"], r["member_path"]) for r in found.where("row is null").collect()} == {("dam_non_biddable_resource_nodes", "DAM01022026_SpNb.csv"), ("unknown", "README_DAM01022026.txt"), ("unknown", "DAM01022026_zz_007.csv")}
    load = packages.typed(found, "dam_loads", "dam_model").first()
    assert (load["operating_date"], load["hour"], load["psse_bus_number"], load["load_name"], load["raw_mw_ldf"], load["raw_mvar_ldf"], load["emil_id"], load["row_number"]) == (dt.date(2026, 1, 2), 7, 1, "L 1", 0.25, None, "NP4-500-SG", 0)
    bus = packages.typed(found, "psse_bus", "dam_model").orderBy("i").collect()
    assert [(r["hour"], r["i"], r["name"], r["ide"], r["comment"]) for r in bus] == [(7, 1, "ONE / A", 1, "1 ONE"), (7, 2, "TWO", 3, None)]
    case = packages.typed(found, "psse_case", "dam_model").first()
    assert (case["sbase"], case["title1"], case["header_comment"]) == (100.0, "FIRST", "written by nobody")
    assert packages.typed(found, "dam_non_biddable_resource_nodes", "dam_model").count() == 0


@pytest.mark.parametrize("change", [("Load Name", "Load  Name"), ("7,1,", "7.5,1,"), ("7,1,", "x,1,")])
def test_what_breaks_its_layout_is_an_error(spark, change):
    text = csv_of("dam_loads", row_of("dam_loads", hour=7, psse_bus_number=1)).replace(*change)
    with pytest.raises(Exception, match="DAM01022026_ld_007.csv"):
        packages.parsed(members(spark, "E", **{"DAM01022026_ld_007.csv": text}), "dam_model").collect()


def test_packages_are_built_once_by_version(spark, tmp_path):
    box, s = tmp_path / "in", Session(spark, str(tmp_path / "root"))
    box.mkdir()

    def put(name, **content):
        with zipfile.ZipFile(box / name, "w") as z:
            for path, text in content.items():
                z.writestr(path, text)

    put("a.zip", **{"x.csv": csv_of("dam_lmps", "01/02/2026,01:00,B1,25.5,N", "01/02/2026,01:00,B2,26,N"), "y.csv": csv_of("dam_system_lambda", "01/02/2026,01:00,20,N"), "z.txt": ""})
    s.ingest(str(box), "NP4-183-CD")
    assert s.build_packages("NP4-183-CD", "1") == 1
    assert s.build_packages("NP4-183-CD", "1") == 0
    put("b.zip", **{"x.csv": csv_of("dam_lmps", "01/02/2026,02:00,B1,30,N")})
    s.ingest(str(box), "NP4-183-CD")
    assert s.build_packages("NP4-183-CD", "1") == 1 and s.build_packages("NP4-183-CD", "2") == 2
    assert sorted((r["hour_ending"], r["bus_name"], r["lmp"]) for r in s.raw("dam_lmps").collect()) == [("01:00", "B1", 25.5), ("01:00", "B2", 26.0), ("02:00", "B1", 30.0)]
    assert [r["system_lambda"] for r in s.raw("dam_system_lambda").collect()] == [20.0]
    assert files.header_of(io.BytesIO(b"A,B\n").getvalue()) == ("A", "B")
