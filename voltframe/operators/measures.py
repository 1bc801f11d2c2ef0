"""Measures of core tables, observed on the plans that write them: no second scan, whatever the number of measures."""

from __future__ import annotations

import threading

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# What each table's measures count, by the register's names.
_TIES = "is_tie and is_in_service = false"
MEASURES: dict[str, dict[str, str]] = {
    "bus": {"TOP-07.buses": "true", "TOP-07.ambiguous": "is_ambiguous", "TOP-06.swing": "bus_type = 3"},
    "branch": {
        "TOP-09.ties": "is_tie", "TOP-09.open_ties": _TIES, "RAT-02.reactance_zero": "x_pu = 0", "RAT-02.reactance_negative": "x_pu < 0", "RAT-08.monitored": "is_monitored", "RAT-08.secured": "is_secured",
        "RAT-08.secured_not_monitored": "is_secured and not is_monitored", "NAM-10.without_name": "branch_id is null",
    },
    "branch_rating": {"RAT-04.emergency_below_base": "emergency_mw > 0 and emergency_mw < base_mw", "RAT-06.without_block": "rating_source = 'crr_monitored' and time_of_use is null", "RAT-07.base_missing": "coalesce(base_mw, 0) <= 0"},
    "contingency_outage": {"TOP-13.outages": "operation = 'outage'", "TOP-13.splits": "operation = 'split_bus'", "TOP-13.other": "operation not in ('outage', 'split_bus')", "RAT-10.unresolved": "not is_resolved"},
    "settlement_point": {"SP-07.hubs": "kind = 'hub'", "SP-07.zones": "kind = 'load_zone'", "SP-07.ties": "kind = 'dc_tie'", "SP-07.nodes": "kind = 'resource_node'", "SP-03.weighted": "n_buses > 0 and weight_sum_raw > 0"},
    "settlement_point_bus": {"SP-03.weight": "= sum(weight)", "SP-08.unresolved": "not is_resolved"},
    "load": {"SP-09.in_service": "is_in_service", "SP-09.loads": "true"},
}


def aggregates(measures: dict[str, str]) -> list[Column]:
    """A condition's text stands for the number of rows that meet it; a text after ``=`` is an aggregate by itself."""
    return [(F.expr(m[1:]) if m.startswith("=") else F.count_if(F.expr(m))).cast("double").alias(name) for name, m in measures.items()]


class Observed:
    """A frame that tells its measures once it has been written."""

    def __init__(self, df: DataFrame, measures: dict[str, str]):
        self._df = df
        self._names = {name: None if m.startswith("=") else 0.0 for name, m in measures.items()}
        self._seen = Observation() if measures else None
        self.frame = df.observe(self._seen, *aggregates(measures)) if measures else df

    def rows(self, wait: float = 3.0) -> list[tuple[str, float | None]]:
        """(name, value) in the order of the names, after the write. Spark may drop what observes a frame that turns out empty, and then tells nothing:
        if no word has come after ``wait`` seconds, an empty frame's counts are 0. Measures that no word comes of after a minute more are an error."""
        if not self._names:
            return []
        told: list[dict] = []

        def listen() -> None:
            try:
                told.append(self._seen.get)
            except Py4JJavaError:  # a row without fields
                pass

        ear = threading.Thread(target=listen, daemon=True)
        ear.start()
        ear.join(wait)
        if not told and not self._df.isEmpty():
            ear.join(60)
            if not told:
                raise TimeoutError("the frame was written, but Spark told no measures")
        return sorted((self._names | (told[0] if told else {})).items())
