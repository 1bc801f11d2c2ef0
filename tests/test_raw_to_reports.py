"""One path: zip bytes, typed tables, snapshots, core tables, network, binding rows, solver, residuals."""

import zipfile

import pytest
from pyspark.sql import functions as F
from test_packages import csv_of, row_of

from voltframe.operators import checks, hours
from voltframe.session import Session
from voltframe.workers import shared

S = "snapshot_id"
SHOWN = {1: "ONE", 2: "TWO", 3: "THREE", 4: "FOUR"}
#: A ring 1-2-3 with a tail 3-4; bus 1 is the swing.
LINES = [(1, 2, "L12", 0.1), (2, 3, "L23", 0.2), (1, 3, "L13", 0.1), (3, 4, "L34", 0.1)]


def raw():
    buses = [f"{n}, '{name}', 138.0, {3 if n == 1 else 1}, 0, 0, 1, 1, 1.0, 0.0, 1" for n, name in SHOWN.items()]
    lines = [f"{a}, {b}, '1 ', 0.0, {x}, 0.0, 100, 120, 130, 0, 0, 0, 0, 1 / [{name}]" for a, b, name, x in LINES]
    return "\n".join(["0, 100.0, 30 / x", "A", "B", *buses, "0 / END OF BUS DATA", "0 / END OF LOAD DATA", "0 / END OF GENERATOR DATA", *lines, "0 / END OF BRANCH DATA", "0 / END OF TRANSFORMER DATA", "Q"])


def package(path, hours_):
    with zipfile.ZipFile(path, "w") as z:
        for h in hours_:
            named = [row_of("dam_lines", hour=h, psse_from_bus_number=a, psse_to_bus_number=b, psse_ckt_id=1, branch_status="Closed", monitored="Yes", monitored_and_secured="Yes", branch_name=n) for a, b, n, _ in LINES]
            out = [row_of("dam_contingencies", hour=h, contingency_name=c, equipment_type="Branch", contingency_operation="Outage", psse_from_bus_number=a, psse_to_bus_number=b, psse_ckt_id=1) for c, a, b in (("RING OUT", 1, 2), ("TAIL OUT", 3, 4))]
            points = [row_of("dam_settlement_points", hour=h, settlement_point_name=f"RN{n}", settlement_point_type="Resource Node", status="ENERGIZED", psse_bus_number=n) for n in SHOWN]
            day = "DAM01022026"
            for kind, table, rows in (("ln", "dam_lines", named), ("ctg", "dam_contingencies", out), ("sp", "dam_settlement_points", points), ("xf", "dam_transformers", []), ("gn", "dam_generators", []), ("ld", "dam_loads", []), ("hb", "dam_hub_buses", [])):
                z.writestr(f"{day}_{kind}_{h:03d}.csv", csv_of(table, *rows))
            z.writestr(f"{day}_{h:03d}.raw", raw())
        z.writestr("README_DAM01022026.txt", "nothing to parse")


def test_from_zip_bytes_to_residuals(spark, tmp_path):
    s = Session(spark, str(tmp_path / "root"))
    for emil in ("NP4-500-SG", "NP4-191-CD", "NP3-966-ER"):
        (tmp_path / emil).mkdir()
    package(tmp_path / "NP4-500-SG" / "model.zip", (1, 2))
    times = ["01/02/2026,01:00", "01/02/2026,02:00"]

    # prices that the network explains: 30 less 8 on L13 when RING OUT, in hour 1 only
    def shadow(t, name, ctg, mu, mw, a, b):
        return f"{t},7,{name},{ctg},100,{mw},0,{mu},{SHOWN[a]},{SHOWN[b]},138,138,x,N"

    with zipfile.ZipFile(tmp_path / "NP4-191-CD" / "prices.zip", "w") as z:
        z.writestr("a.csv", csv_of("dam_shadow_prices", shadow(times[0], "L13", "RING OUT", 8, -3, 1, 3), shadow(times[0], "L34", "TAIL OUT", 9, 1, 3, 4), shadow(times[0], "L23", "BASE CASE", 5, 1, 3, 2)))
        # with L12 out everything at 2, 3 and 4 comes over L13: its factor is -1 there; L23 read from 3 to 2 has factors 1/4 * (0, 0, -1...)
        f23 = {1: 0.0, 2: 0.25, 3: -0.25, 4: -0.25}
        z.writestr("b.csv", csv_of("dam_settlement_point_prices", *[f"{t},RN{n},{30 - (8 * (-1.0 if n > 1 else 0.0) + 5 * -f23[n] if t == times[0] else 0)},N" for t in times for n in SHOWN]))
        z.writestr("c.csv", csv_of("dam_system_lambda", *[f"{t},30,N" for t in times]))
    with zipfile.ZipFile(tmp_path / "NP3-966-ER" / "day.zip", "w") as z:
        def awards(stem, table, *rows):
            z.writestr(f"60d_DAM_{stem}-02-JAN-26.csv", csv_of(table, *rows))

        awards("EnergyOnlyOfferAwards", "dam_60d_energy_only_offer_awards", *[row_of("dam_60d_energy_only_offer_awards", delivery_date="01/02/2026", hour_ending=h, settlement_point=p, energy_only_offer_award_in_mw=mw, offer_id=1) for h, p, mw in (("01:00", "RN2", 5), ("01:00", "RN4", 2), ("02:00", "RN2", 1))])
        awards("EnergyBidAwards", "dam_60d_energy_bid_awards", row_of("dam_60d_energy_bid_awards", delivery_date="01/02/2026", hour_ending="01:00", settlement_point="RN3", energy_only_bid_award_in_mw=-4, bid_id=2))
        for stem, table in (("Gen_Resource_Data", "dam_60d_gen_resource_data"), ("ESR_Data", "dam_60d_esr_data"), ("PTPObligationBidAwards", "dam_60d_ptp_obligation_bid_awards"), ("PTP_Obligation_OptionAwards", "dam_60d_ptp_obligation_option_awards")):
            awards(stem, table)
    for emil in ("NP4-500-SG", "NP4-191-CD", "NP3-966-ER"):
        s.ingest(str(tmp_path / emil), emil)
        assert s.build_packages(emil, "1") == 1
    s.build_snapshots()
    assert s.hour_ids("2026-01-02") == ["dam:2026-01-02:he01:r1", "dam:2026-01-02:he02:r1"]
    assert set(s.build_core("dam", run_id="r")) >= {"bus", "branch", "contingency_outage", "settlement_point_bus"}
    s.build_awards()
    seen = {r["measure"]: r["value"] for r in s.measures("r").collect()}
    assert (seen["TOP-07.buses"], seen["TOP-06.swing"], seen["RAT-08.secured"], seen["TOP-13.outages"], seen["SP-07.nodes"], seen["SP-03.weight"]) == (8, 2, 8, 4, 8, 8)

    net = s.network().written()
    assert {(r["branch_id"], r["branch_index"]) for r in net.branches.collect()} == {(b, k) for _ in (1, 2) for k, b in enumerate(("L12", "L13", "L23", "L34"))}
    snaps = s.core("snapshot").select(S, "interval_start_utc")
    hour = lambda table: checks.hour_rows(s.raw(table).withColumns({"posted_at": F.lit(None).cast("timestamp"), "doc_id": F.col("blob_sha256")})).join(snaps, "interval_start_utc")
    shown = hour("dam_shadow_prices").select(S, F.col("row_number").cast("string").alias("row"), "constraint_name", "contingency_name", "from_station", "to_station", "from_station_kv", "to_station_kv", F.col("shadow_price"), F.col("constraint_value").alias("published_mw"), F.col("constraint_limit").alias("limit_mw"))
    gtcs = spark.createDataFrame([], f"{S} string, gtc_id string, n_missing long")
    binding = checks.binding(shown, net, s.core("bus"), gtcs).withColumns({"contingency": F.col("contingency_name"), "members": F.lit(None).cast(hours.MEMBERS)})
    binding = shared(binding)
    injections = s.core("hourly_award").join(snaps, "interval_start_utc").join(net.weights(), [S]).where("settlement_point = point").groupBy(S, "bus_index").agg(F.sum(F.col("mw") * F.col("weight")).alias("mw"))
    solved = hours.solve(net.solver_rows(), net.cases(), binding, net.weights(), injections)
    solved = shared(solved)

    outcomes = {r["constraint_name"]: r["outcome"] for r in hours.outcomes(binding, solved).collect()}
    assert outcomes == {"L13": "used_contingency", "L34": "constraint_is_outaged_by_its_contingency", "L23": "used_base_case"}
    prices = hour("dam_settlement_point_prices").select(S, F.col("settlement_point").alias("point"), F.col("settlement_point_price").alias("price"))
    system = hour("dam_system_lambda").select(S, F.col("system_lambda").alias("system_price"))
    report = hours.hour_prices(prices, solved, net.weights(), system).collect()
    assert len(report) == 8 and all(r["residual"] == pytest.approx(0, abs=1e-6) and r["source"] == "published" for r in report)
    # with L12 out, what the awards put in at 2, 3 and 4 leaves by L13, read from 1 to 3
    flows = {r["constraint_name"]: r["flow_mw"] for r in hours.hour_flows(binding, solved).collect()}
    assert flows["L13"] == pytest.approx(-(5 - 4 + 2)) and set(flows) == {"L13", "L23"}
