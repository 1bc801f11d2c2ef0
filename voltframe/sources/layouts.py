"""Declared columns of the published files, and the rules by which a member's name or header says what it is.

A column is its header, its kind (s text, i whole number, d double) and, where the header's own words don't give it, its name.
"""

from __future__ import annotations

from .columns import Field, fields

# Headers of published files, in their order.

_TIME = fields("DeliveryDate", "HourEnding")
_DST = fields("DSTFlag")
_DAY = fields("Delivery Date", "Hour Ending")

CRR_MODEL = {
    "crr_contingencies": fields("Contingency", "DeviceName", "DeviceType", "Action"),
    "crr_monitored_lines_and_transformers": fields("DeviceName", "DeviceType", "BaseCaseRating:d", "EmergencyRating:d", "TimeOfUse"),
    "crr_non_thermal_constraints": fields("Name", "Limit:d", "DeviceName", "DeviceType", "FlowDirection", "Factor:d"),
    "crr_sources_and_sinks": fields("Name", "PriceNode", "BusName", "ParticipationFactor:d"),
    "crr_outages": fields(
        "RDFID", "ACTUAL_END_DATE", "ACTUAL_START_DATE", "CATEGORY", "EQUIPMENT_FROM_STAT_NAME_ACRN", "EQUIPMENT_FROM_STATION_NAME", "EQUIPMENT_HI_SUSTAINED_LIMIT", "EQUIPMENT_NAME", "EQUIPMENT_NORMAL_STATE",
        "EQUIPMENT_OUTAGE_STATE", "EQUIPMENT_TO_STAT_NAME_ACRN", "EQUIPMENT_TO_STATION_NAME", "EQUIPMENT_TYPE", "IDENTIFIER", "NEW_PLANNED_END_DATE", "NEW_PLANNED_START_DATE", "PLANNED_END_DATE", "PLANNED_START_DATE",
        "PROJECT_NAME", "REQUESTOR_ORG_NAME", "STATUS", "TYPE_ACRONYM", "VOLTAGE_LEVEL", "EMS_IMPORT_INHIBIT", "LATEST_END_DATE", "NATURE_OF_WORK", "OUTAGE_GROUP_LABEL", "TYPE",
    ),
}
#: Sheets of the auction model's mapping workbook, and the tables they hold; number cells there are not all numbers.
CRR_SHEETS = {
    "Lines": ("crr_mapping_lines", fields("CRR_Tag", "Operations_Name", "OP_EQCODE", "LNNAME", "EQNAME", "From #", "From Name", "To #", "To Name", "Circuit ID")),
    "Autos": ("crr_mapping_autos", fields("CRR Name", "Operations_Name", "PTNAME", "From #", "From Name", "To #", "To Name", "ID")),
}
CRR_RESULTS = {
    "crr_auction_bids_and_offers": fields("Source", "Sink", "BidType", "StartDate", "EndDate", "HedgeType", "TimeOfUse", "MW:d", "BidPricePerMWH:d", "ShadowPricePerMWH:d"),
    "crr_auction_base_loading": fields("CRR_ID", "AccountHolder", "Source", "Sink", "HedgeType", "TimeOfUse", "MW:d", "ShadowPricePerMWH:d"),
    "crr_auction_binding_constraints": fields("DeviceName", "DeviceType", "Direction", "Flow:d", "Limit:d", "Description", "Contingency", "CalendarPeriod", "TimeOfUse", "ShadowPrice:d"),
    "crr_auction_market_results": (*fields("CRR_ID", "OriginalCRR_ID", "AccountHolder", "HedgeType", "BidType", "CRRType", "Source", "Sink", "StartDate", "EndDate", "TimeOfUse"), Field("Bid24Hour", "s", "bid_24_hour"), *fields("MW:d", "ShadowPricePerMWH:d")),
    "crr_auction_source_sink_shadow_prices": fields("SourceSink", "CalendarPeriod", "TimeOfUse", "ShadowPricePerMWH:d"),
}

_ENDS = fields("From Station Name/PSS/E Bus Name", "From PSS/E KV:d", "To Station Name/PSS/E Bus Name", "To PSS/E KV:d")
_STATION = fields("Station Name/PSS/E Bus Name")
_SPLIT = "Split Bus (contingency) "
DAM_MODEL = {
    "dam_contingencies": (
        *fields("Hour:i", "Contingency Name"),
        Field("Equipment Type (Branch/Load/Generator/SettlementPoint)", "s", "equipment_type"),
        Field("Contingency Operation (Outage or Split Bus)", "s", "contingency_operation"),
        *fields("PSS/E GenOrLoadOrSP Bus Number:i", "PSS/E GenOrLoad Id", "Station Name/PSSE Bus Name", "PSS/E KV:d", "PSS/E From Bus Number:i", "PSS/E To Bus Number:i", "PSS/E Ckt Id"), *_ENDS,
        Field(_SPLIT + "PSS/E Bus Number (From PSS/E Bus Number in case branches or PSS/E Bus number in case of Load and Generator)", "s", "split_bus_psse_bus_number"),
        Field(_SPLIT + "From Station Name/PSS/E Bus Name", "s", "split_bus_from_station_name_psse_bus_name"),
        Field(_SPLIT + "From PSS/E KV", "d", "split_bus_from_psse_kv"),
        Field(_SPLIT + "PSS/E To Bus Number - Only for Branches", "s", "split_bus_psse_to_bus_number"),
        Field(_SPLIT + "To Station Name/PSS/E Bus Name", "s", "split_bus_to_station_name_psse_bus_name"),
        Field(_SPLIT + "To PSS/E KV", "d", "split_bus_to_psse_kv"),
    ),
    "dam_generators": (
        *fields("Hour:i", "PSS/E Bus Number:i", "PSS/E Gen Id"), *_STATION, *fields("PSS/E KV:d", "Generator Name", "Generator Status"),
        Field("Resource Node Settlment Point Name", "s", "resource_node_settlement_point_name"),
        *fields("Resource Node PSS/E Bus Number:i", "Resource Node Station Name/PSS/E Bus Name", "Resource Node PSS/E KV:d", "Combined Cycle - Train Name", "Combined Cycle - Logical Resource Node Settlement Point Name", "Generator in Load Zone", "Resource Node in Load Zone"),
        Field("DC Tie (if applicable)", "s", "dc_tie"),
    ),
    "dam_hub_buses": (*fields("Hour:i", "PSS/E Bus Number:i"), *_STATION, *fields("PSS/E KV:d", "Bus Status", "Hub Bus Name", "Hub Name")),
    "dam_loads": (
        *fields("Hour:i", "PSS/E Bus Number:i", "PSS/E Load Id"), *_STATION, *fields("PSS/E KV:d", "Load Name", "Load Status", "Weather Zone Name", "Load Zone Name", "Ercot Load?", "Conforming or NonConforming", "Raw MW LDF:d"),
        Field("Raw MVAr LDF", "d", "raw_mvar_ldf"), *fields("Load Rollover Capable?", "Number of Target Loads:i"),
        *(f for n in ("1st", "2nd", "3rd", "4th", "5th", "6th", "7th", "8th", "9th", "10th") for f in fields(f"{n} Target Load Name", f"Fraction of this Load to {n} Target Load:d")),
    ),
    "dam_lines": (
        *fields("Hour:i", "PSS/E From Bus Number:i", "PSS/E To Bus Number:i", "PSS/E Ckt Id", "Branch Status", "Monitored?", "Monitored and Secured?"), *_ENDS,
        *fields("Branch Name", "r (p.u):d", "x (p.u):d", "b (p.u):d", "RATEA:d", "RATEB:d", "RATEC:d"),
    ),
    "dam_settlement_points": (
        *fields("Hour:i", "Settlement Point Name", "Settlement Point Type", "Status"),
        Field("Number of energized components - (i)Buses (Hub & PUN Resource Nodes) (ii)Loads (LZ) (iii)Generators (Resource Nodes & Logical Resource Nodes)", "i", "number_of_energized_components"),
        *fields("PSS/E Bus Number:i"), *_STATION, *fields("PSS/E KV:d", "Combined Cycle Train Name", "Combined Cycle Settlement Point"),
        Field("Load Zone (for Resource Node & PUN Resource Node)", "s", "load_zone"),
    ),
    "dam_transformers": (
        *fields("Hour:i", "PSS/E From Bus Number:i", "PSS/E To Bus Number:i", "PSS/E Ckt Id", "Transformer Status", "Monitored?", "Monitored and Secured?"), *_ENDS,
        *fields("Branch Name", "r (p.u):d", "x (p.u):d", "Off Nominal Turns Ratio:d", "RATEA:d", "RATEB:d", "RATEC:d"),
    ),
    "dam_settlement_point_contingencies": (
        *fields("Hour:i", "Contingency Name"), Field("Contingency Operation (Outage or Split Bus)", "s", "contingency_operation"),
        *fields("PSS/E Bus Number:i", "Station Name/PSSE Bus Name", "PSS/E KV:d", "Settlement Point Name"),
    ),
    "dam_non_biddable_resource_nodes": fields("Resource Node"),
}
DAM_PRICES = {
    "dam_shadow_prices": (
        *_TIME, *fields("ConstraintID:i", "ConstraintName", "ContingencyName", "ConstraintLimit:d", "ConstraintValue:d", "ViolationAmount:d", "ShadowPrice:d", "FromStation", "ToStation"),
        Field("FromStationkV", "d", "from_station_kv"), Field("ToStationkV", "d", "to_station_kv"), *fields("DeliveryTime"), *_DST,
    ),
    "dam_lmps": (*_TIME, *fields("BusName", "LMP:d"), *_DST),
    "dam_settlement_point_prices": (*_TIME, *fields("SettlementPoint", "SettlementPointPrice:d"), *_DST),
    "dam_system_lambda": (*_TIME, *fields("SystemLambda:d"), *_DST),
    "dam_deenergized_settlement_points": (*_TIME, *fields("SettlementPoint"), *_DST),
    "dam_electrically_similar_settlement_points": (*_TIME, *fields("SettlementPoint", "GroupIndex:i", "UpdateTime"), *_DST),
    "heuristic_pricing_associations": (*fields("MarketType"), Field("FromEBName", "s", "from_electrical_bus"), Field("ToEBName", "s", "to_electrical_bus"), *fields("Type", "Priority:i")),
    "load_distribution_factors": (*fields("LdfDate", "LdfHour"), Field("SubStation", "s", "substation"), *fields("DistributionFactor:d", "LoadID", "MVARDistributionFactor:d", "MRIDLoad"), *_DST),
}
MAPPINGS = {
    "sp_electrical_bus_mapping": fields("ELECTRICAL_BUS", "NODE_NAME", "PSSE_BUS_NAME", "VOLTAGE_LEVEL", "SUBSTATION", "SETTLEMENT_LOAD_ZONE", "RESOURCE_NODE", "HUB_BUS_NAME", "HUB", "PSSE_BUS_NUMBER:i"),
    "sp_resource_node_units": fields("RESOURCE_NODE", "UNIT_SUBSTATION", "UNIT_NAME"),
    "sp_noie_mapping": fields("PHYSICAL_LOAD", "NOIE", "VOLTAGE_NAME", "SUBSTATION", "ELECTRICAL_BUS"),
    "sp_ccp_resource_names": (*fields("CCP_NAME"), Field("LOGICALREOURCENODENAME", "s", "logical_resource_node_name")),
    "sp_hub_and_dc_tie_names": fields("NAME"),
    "hub_buses": fields("ELECTRICAL_BUS", "ELECTRICAL_BUS_KV:d", "HUB_BUS_NAME", "HUB"),
    "electrical_buses": fields("ELECTRICAL_BUS"),
}


def _steps(text: str, n: int) -> tuple[Field, ...]:
    """``text`` for each step of a curve, its number in place of ``#``."""
    return tuple(f for k in range(1, n + 1) for f in fields(*(x.replace("#", str(k)) for x in text.split(", "))))


_OFFER = _steps("BLOCK INDICATOR#, PRICE# RRSPFR:d, PRICE# RRSFFR:d, PRICE# RRSUFR:d, PRICE# ECRS:d, PRICE# OFFEC:d, PRICE# ONLINE NONSPIN:d, PRICE# REGUP:d, PRICE# REGDOWN:d, PRICE# OFFLINE NONSPIN:d, QUANTITY MW#:d", 5)
_RESOURCE = (
    *_DAY, *fields("QSE", "DME", "Resource Name", "Resource Type"), *_steps("QSE submitted Curve-MW#:d, QSE submitted Curve-Price#:d", 10),
    *fields(
        "Start Up Hot:d", "Start Up Inter:d", "Start Up Cold:d", "Min Gen Cost:d", "HSL:d", "LSL:d", "Resource Status", "Awarded Quantity:d", "Settlement Point Name", "Energy Settlement Point Price:d", "RegUp Awarded:d", "RegUp MCPC:d",
        "RegDown Awarded:d", "RegDown MCPC:d", "RRSPFR Awarded:d", "RRSFFR Awarded:d", "RRSUFR Awarded:d", "RRS MCPC:d", "ECRSSD Awarded:d", "ECRS MCPC:d", "NonSpin Awarded:d", "NonSpin MCPC:d",
    ),
)
_POINT = (*_DAY, *fields("Settlement Point", "QSE Name"))
_PATH = (*_DAY, *fields("QSE Name", "Settlement Point Source", "Settlement Point Sink"))
DISCLOSURE = {
    "dam_60d_qse_self_arranged_as": (*_DAY, *fields("QSE", *(f"Total Self-Arranged AS {x}:d" for x in ("RegUp", "RegDown", "NonSpin", "NSPNM", "RRSPFR", "RRSFFR", "RRSUFR", "ECRSSD", "ECRSMD")))),
    "dam_60d_gen_resource_data": _RESOURCE,
    "dam_60d_generation_resource_as_offers": (*_DAY, *fields("QSE", "DME", "Generation Resource Name", "Multi-Hour Block Flag"), *_OFFER),
    "dam_60d_load_resource_data": (
        *_DAY,
        *fields(
            "Load Resource Name", "Max Power Consumption for Load Resource:d", "Low Power Consumption for Load Resource:d", "RegUp Awarded:d", "RegUp MCPC:d", "RegDown Awarded:d", "RegDown MCPC:d", "RRSPFR Awarded:d", "RRSFFR Awarded:d",
            "RRSUFR Awarded:d", "RRS MCPC:d", "ECRSSD Awarded:d", "ECRSMD Awarded:d", "ECRS MCPC:d", "NonSpin Awarded:d", "NonSpin MCPC:d",
        ),
    ),
    "dam_60d_load_resource_as_offers": (*_DAY, *fields("QSE", "DME", "Load Resource Name", "Multi-Hour Block Flag"), *_OFFER, *fields("NCLR Flag")),
    "dam_60d_energy_only_offers": (*_POINT, *_steps("Energy Only Offer MW#:d, Energy Only Offer Price#:d", 10), *fields("Energy Only Offer ID", "Multi-Hour Block Indicator", "Block/Curve indicator")),
    "dam_60d_energy_only_offer_awards": (*_POINT, *fields("Energy Only Offer Award in MW:d", "Settlement Point Price:d", "Offer ID")),
    "dam_60d_energy_bids": (*_POINT, *_steps("Energy Only Bid MW#:d, Energy Only Bid Price#:d", 10), *fields("Energy Only Bid ID", "Multi-Hour Block Indicator", "Block/Curve indicator")),
    "dam_60d_energy_bid_awards": (*_POINT, *fields("Energy Only Bid Award in MW:d", "Settlement Point Price:d", "Bid ID")),
    "dam_60d_ptp_obligation_option": (*_PATH, *fields("MW:d", "Price:d", "Offer ID", "Multi-Hour Block Indicator", "CRR ID")),
    "dam_60d_ptp_obligation_bids": (*_PATH, *fields("PtP Bid - MW:d", "PtP Bid - Price:d", "Bid ID", "Multi-Hour Block Indicator")),
    "dam_60d_ptp_obligation_option_awards": (*_PATH, *fields("MW:d", "Price:d", "Offer ID", "CRR ID")),
    "dam_60d_ptp_obligation_bid_awards": (*_PATH, *fields("PtP Bid Award - MW:d", "PtP Bid - Price:d", "Bid ID")),
    "dam_60d_esr_as_offers": (*_DAY, *fields("QSE", "DME", "Resource Name", "Multi-Hour Block Flag"), *_OFFER),
    "dam_60d_esr_data": _RESOURCE,
    "dam_60d_as_only_offers": (*_DAY, *fields("QSE Name", "Offer ID", "AS Type"), *_steps("AS Only Offer MW#:d, AS Only Offer Price#:d", 5)),
    "dam_60d_as_only_awards": (*_DAY, *fields("QSE Name", "AS Type", "Offer ID", *(f"Quantity{n} Award:d" for n in range(1, 6)), "Total Award:d", "MCPC:d")),
}
#: Tables of equal headers: the word in a member's name that tells which of them it is.
BY_STEM = {"dam_60d_gen_resource_data": "Gen_Resource_Data", "dam_60d_esr_data": "ESR_Data"}

TABLES = CRR_MODEL | dict(CRR_SHEETS.values()) | CRR_RESULTS | DAM_MODEL | DAM_PRICES | MAPPINGS | DISCLOSURE

# How members are named. Each rule is a pattern and what a member that fits it holds; the first that fits counts.

_MONTHS = "JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC"
CRR_MODEL_RULES = [
    (r"(?i)networkmodel[^/]*\.raw$", "raw"),
    (r"(?i)monitoredlinesandtransformers[^/]*\.csv$", "crr_monitored_lines_and_transformers"),
    (r"(?i)non-thermalconstraints[^/]*\.csv$", "crr_non_thermal_constraints"),
    (r"(?i)sourcesandsinks[^/]*\.csv$", "crr_sources_and_sinks"),
    (r"(?i)contingencies[^/]*\.csv$", "crr_contingencies"),
    (r"(?i)mappingdocument[^/]*\.xlsx$", "sheets"),
    (r"(?i)outages[^/]*\.txt$", "crr_outages"),
]
CRR_RESULT_RULES = [
    (r"Common_AuctionBidsAndOffers_\d{4}\.[^/]*\.(?i:csv)$", "crr_auction_bids_and_offers"),
    (r"Common_BaseLoading_\d{4}\.[^/]*\.(?i:csv)$", "crr_auction_base_loading"),
    (r"Common_BindingConstraint_\d{4}\.[^/]*\.(?i:csv)$", "crr_auction_binding_constraints"),
    (r"Common_MarketResults_\d{4}\.[^/]*\.(?i:csv)$", "crr_auction_market_results"),
    (r"Common_SourceAndSinkShadowPrices_\d{4}\.[^/]*\.(?i:csv)$", "crr_auction_source_sink_shadow_prices"),
]
DAM_MODEL_RULES = [
    (r"(?i)(^|/)DAM\d{8}_\d{3}\.raw$", "raw"),
    (r"(?i)(^|/)DAM\d{8}_ctg_\d{3}\.csv$", "dam_contingencies"),
    (r"(?i)(^|/)DAM\d{8}_gn_\d{3}\.csv$", "dam_generators"),
    (r"(?i)(^|/)DAM\d{8}_hb_\d{3}\.csv$", "dam_hub_buses"),
    (r"(?i)(^|/)DAM\d{8}_ld_\d{3}\.csv$", "dam_loads"),
    (r"(?i)(^|/)DAM\d{8}_ln_\d{3}\.csv$", "dam_lines"),
    (r"(?i)(^|/)DAM\d{8}_sp_\d{3}\.csv$", "dam_settlement_points"),
    (r"(?i)(^|/)DAM\d{8}_xf_\d{3}\.csv$", "dam_transformers"),
    (r"(?i)(^|/)DAM\d{8}_SpCtg\.csv$", "dam_settlement_point_contingencies"),
    (r"(?i)(^|/)DAM\d{8}_SpNb\.csv$", "dam_non_biddable_resource_nodes"),
]
BY_HEADER_RULES = [(r"(?i)\.csv$", "header")]
DISCLOSURE_RULES = [(r"(^|/)60d_DAM_.+-\d\d-[A-Za-z]{3}-\d\d\.csv$", "header")]

#: What a member's name says of its rows: column, type, pattern with one group.
CRR_IDENTITY = [
    ("auction", "string", r"(?i)\.(Annual|Monthly)\.?Auction"),
    ("term", "string", r"(?i)(\d{4}\.\d(?:st|nd)\d)\.AnnualAuction\.Seq\d+"),
    ("sequence", "bigint", r"(?i)\d{4}\.\d(?:st|nd)\d\.AnnualAuction\.Seq(\d+)"),
    ("month", "date", rf"(?i)(\d{{4}}\.(?:{_MONTHS}))\.Monthly\.Auction|_((?:{_MONTHS})_\d{{4}})(?=[._])"),
    ("time_of_use", "string", r"(?i)_(PeakWD|PeakWE|Off-?peak)(?=[._])"),
]
DAM_IDENTITY = [("operating_date", "date", r"(?i)DAM(\d{8})[_.]"), ("hour", "bigint", r"(?i)DAM\d{8}_(?:[A-Za-z]+_)?(\d{3})\.")]
DISCLOSURE_IDENTITY = [("operating_date", "date", r"60d_DAM_.+-(\d\d-[A-Za-z]{3}-\d\d)\.csv$")]

#: Family: its rules, the tables that headers may name, and the identity of its members.
FAMILIES = {
    "crr_model": (CRR_MODEL_RULES, CRR_MODEL, CRR_IDENTITY),
    "crr_results": (CRR_RESULT_RULES, CRR_RESULTS, CRR_IDENTITY[:4]),
    "dam_model": (DAM_MODEL_RULES, DAM_MODEL, DAM_IDENTITY),
    "dam_prices": (BY_HEADER_RULES, DAM_PRICES, []),
    "mappings": (BY_HEADER_RULES, MAPPINGS, []),
    "disclosure": (DISCLOSURE_RULES, DISCLOSURE, DISCLOSURE_IDENTITY),
}
#: Product of the archive: its family.
PRODUCTS = {
    "NP7-801-M": "crr_model", "NP7-800-M": "crr_model", "NP7-803-M": "crr_results", "NP7-802-M": "crr_results", "NP4-500-SG": "dam_model", "NP4-191-CD": "dam_prices", "NP4-183-CD": "dam_prices", "NP4-190-CD": "dam_prices",
    "NP4-523-CD": "dam_prices", "NP4-200-CD": "dam_prices", "NP4-158-SG": "dam_prices", "NP4-231-CD": "dam_prices", "NP4-159-CD": "dam_prices", "NP4-160-SG": "mappings", "NP3-220-SG": "mappings", "NP3-966-ER": "disclosure",
}


def families_of(table: str) -> list[str]:
    """The families whose members hold a table."""
    if table.startswith("psse_"):
        return ["crr_model", "dam_model"]
    sheets = {t for t, _ in CRR_SHEETS.values()}
    return [f for f, (_, tables, _) in FAMILIES.items() if table in tables or (f == "crr_model" and table in sheets)]
