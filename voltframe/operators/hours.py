"""Whole hours of published prices and flows against solved networks.

The binding rows of all snapshots say which contingencies are to be solved: each (snapshot, contingency) once, however many
rows bind under it, and a large snapshot's in several tasks. What comes out is one row for each, with the flow of every
binding row, what the rows add to each point's price, and what is cut off; it is small, meant to be written, and feeds prices, flows and outcomes alike.
Factors by bus never leave the task that solves them.

Binding rows have snapshot_id, row (a text that is unique within the snapshot), contingency, branch_index, sign, members (branch_index, factor: the parts of a
constraint over several branches; null for a single branch), shadow_price and outcome (see ``checks.binding`` and
``reports.block_binding``). Rows whose outcome doesn't begin with ``used`` are listed, but not applied.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import name_key
from . import reports
from .dc import UNMET, S, _apart, _system, batches, outaged

MEMBERS = "array<struct<branch_index: bigint, factor: double>>"
SPLITS = "array<struct<branch_index: bigint, split_end: string>>"
ROWS = "array<struct<row: string, flow_mw: double, is_lost: boolean, shadow_price: double>>"
POINTS = "array<struct<point: string, congestion: double, plain: double>>"
FIELDS = {S: "string", "contingency": "string", "n_islanded": "long", "cut": "array<long>", "is_solved": "boolean", "is_partial": "boolean", "rows": ROWS, "points": POINTS, "flows": "array<double>"}
COLUMNS, SOLVED = list(FIELDS), ", ".join(f"{k} {v}" for k, v in FIELDS.items())


def _asked(lines: DataFrame, contingencies: DataFrame, binding: DataFrame) -> DataFrame:
    """A row for each case: the intact network (contingency ``""``) of every snapshot, and each contingency that a used row binds under."""
    whole = F.col("outcome").startswith("used") & F.col("shadow_price").isNotNull()
    under = F.when(F.col("outcome").startswith("used_contingency"), name_key(F.col("contingency"))).otherwise("")
    single = F.array(F.struct(F.col("branch_index").cast("long").alias("branch_index"), F.col("sign").cast("double").alias("factor")))
    members = F.coalesce(F.col("members").cast(MEMBERS), F.when(F.col("branch_index").isNotNull() & F.col("sign").isNotNull(), single))
    used = binding.where(whole).select(S, under.alias("contingency"), F.struct(F.col("row").cast("string").alias("row"), F.col("shadow_price").cast("double").alias("shadow_price"), members.alias("members")).alias("x"), (F.col("outcome") == "used_contingency_partial").alias("partial")).where("x.members is not null")
    given = used.groupBy(S, "contingency").agg(F.array_sort(F.collect_list("x")).alias("rows"), F.max("partial").alias("partial"))
    intact = lines.select(S).distinct().select(S, F.lit("").alias("contingency"))
    cases = intact.join(given.where("contingency = ''"), [S, "contingency"], "left").unionByName(given.where("contingency <> ''"))
    known = contingencies.select(S, name_key(F.col("contingency")).alias("contingency"), F.col("out").cast("array<bigint>").alias("out"), F.col("splits").cast(SPLITS).alias("splits")).where("contingency <> ''").dropDuplicates([S, "contingency"])
    return cases.join(known, [S, "contingency"], "left")


def solve(lines: DataFrame, contingencies: DataFrame, binding: DataFrame, weights: DataFrame, injections: DataFrame, parts: int = 1) -> DataFrame:
    """A row for each case of ``lines`` (as ``dc`` takes them) that ``binding`` asks for: see ``SOLVED``.

    ``contingencies``: snapshot_id, contingency, out, splits; one that is unknown leaves the network as it is. ``weights``: snapshot_id, point, bus_index, weight;
    ``injections``: snapshot_id, bus_index, mw. Texts name contingencies by letters and digits. ``flows`` are all branches' in the
    intact network. A case that can't be solved has ``is_solved`` false and nothing to add.
    """
    cases = _asked(lines, contingencies, binding).withColumn("__part", F.pmod(F.xxhash64("contingency"), F.lit(parts)).cast("int"))
    # one network's weights and injections; they go to each of its tasks once
    about = weights.groupBy(S).agg(F.collect_list(F.struct(F.col("point").cast("string").alias("point"), F.col("bus_index").cast("long").alias("bus_index"), F.col("weight").cast("double").alias("weight"))).alias("weights"))
    about = about.join(injections.groupBy(S).agg(F.collect_list(F.struct(F.col("bus_index").cast("long").alias("bus_index"), F.col("mw").cast("double").alias("mw"))).alias("injections")), S, "full")
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    asked = cases.unionByName(about.withColumn("__part", every), allowMissingColumns=True)

    def run(key: tuple, network: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(network) and given["contingency"].notna().any():
            system = _system(network)
            q, names, rows, at, weight = np.zeros(system.n), [], np.zeros(0, int), np.zeros(0, int), np.zeros(0)
            for x in given[given["contingency"].isna()].itertuples():
                if x.injections is not None:
                    for i in x.injections:
                        q[i["bus_index"]] += i["mw"]
                if x.weights is not None and len(x.weights):
                    names = sorted({w["point"] for w in x.weights})
                    number = {p: k for k, p in enumerate(names)}
                    rows, at, weight = (np.array(v) for v in zip(*((number[w["point"]], w["bus_index"], w["weight"]) for w in x.weights), strict=True))
            todo = [_Case(x) for x in given[given["contingency"].notna()].sort_values("contingency").itertuples()]
            for some, solved in batches(system, todo):
                for c in some:
                    out.append((key[0], *_one(system, c, solved, q, names, rows, at, weight)))
        return pd.DataFrame(out, columns=COLUMNS)

    dealt = lines.withColumn("__part", every)
    return dealt.groupBy(S, "__part").cogroup(_apart(asked).groupBy(S, "__part")).applyInPandas(run, SOLVED)


class _Case:
    """A case as ``dc.batches`` takes it; ``wanted`` are the branches of its binding rows."""

    def __init__(self, x):
        self.contingency, self.partial = x.contingency, bool(x.partial)
        self.out = [] if x.out is None else list(x.out)
        self.splits = [] if x.splits is None else list(x.splits)
        self.rows = [] if x.rows is None else list(x.rows)
        self.wanted = sorted({int(m["branch_index"]) for r in self.rows for m in r["members"]})


def _one(system, c: _Case, solved: dict, q: np.ndarray, names: list[str], rows: np.ndarray, at: np.ndarray, weight: np.ndarray) -> tuple:
    case = outaged(system, c, solved)
    new = np.setdiff1d(case.cut, system.cut)
    # 13 digits: what is zero or a short decimal is so exactly, and flows that lie halfway between two roundings stay there
    factors = np.round(case.factors(c.wanted, solved), 13) + 0.0 if c.wanted else np.zeros((0, system.n))
    fine = not c.wanted or case.residual <= UNMET
    number = {j: k for k, j in enumerate(c.wanted)}
    cost, found = np.zeros(system.n), []
    for r in c.rows if fine else ():
        own = [(number[int(m["branch_index"])], m["factor"]) for m in r["members"]]
        lost = bool(c.contingency) and any(not case.connected[b] for m in r["members"] for b in case.ends(int(m["branch_index"])))
        vector = sum((f * factors[k] for k, f in own), np.zeros(system.n))
        found.append({"row": r["row"], "flow_mw": round(float(vector @ q), 9) + 0.0, "is_lost": lost, "shadow_price": r["shadow_price"]})
        if not lost:
            cost += r["shadow_price"] * vector
    points = []
    if names and cost.any():
        plain = np.bincount(rows, weight * cost[at], len(names))
        own = plain
        if len(new) and not c.partial:
            alive = case.connected[: system.n][at]
            whole = np.bincount(rows[alive], weight[alive], len(names))
            own = np.divide(np.bincount(rows[alive], (weight * cost[at])[alive], len(names)), whole, out=np.zeros(len(names)), where=whole > 0)
        points = [{"point": p, "congestion": x, "plain": y} for p, x, y in zip(names, own.tolist(), plain.tolist(), strict=True)]
    flows = system.flows(np.where(system.connected, q, 0.0)).tolist() if not c.contingency else None
    return c.contingency, len(new), new.tolist(), fine, c.partial, found, points, flows


def outcomes(binding: DataFrame, solved: DataFrame, what: str = "constraint") -> DataFrame:
    """``binding`` with flow_mw (of the row, in its direction) and the outcome that takes account of what its contingency cuts off."""
    found = solved.select(S, "n_islanded", "is_solved", F.explode("rows").alias("x")).select(S, F.col("x.row").alias("row"), F.col("x.flow_mw").alias("flow_mw"), F.col("x.is_lost").alias("__lost"), F.col("n_islanded").alias("__islands"))
    failed = solved.where("not is_solved").select(S, F.col("contingency").alias("__ctg"), F.lit(True).alias("__failed"))
    under = F.when(F.col("outcome").startswith("used_contingency"), name_key(F.col("contingency"))).otherwise("")
    df = binding.withColumn("__ctg", under).join(found, [S, "row"], "left").join(failed, [S, "__ctg"], "left")
    hit = F.col("outcome").startswith("used_contingency")
    outcome = F.when(F.col("outcome").startswith("used") & F.col("__failed"), "network_not_solved").when(hit & F.col("__lost"), f"{what}_islanded_by_its_contingency")
    outcome = outcome.when(F.col("outcome").isin("used_contingency", "used_contingency_split_bus") & (F.col("__islands") > 0), "used_contingency_islanding").otherwise(F.col("outcome"))
    return df.select(*[c for c in binding.columns if c != "outcome"], outcome.alias("outcome"), F.when(outcome.startswith("used"), F.col("flow_mw")).alias("flow_mw"))


def congestion(solved: DataFrame, weights: DataFrame) -> DataFrame:
    """snapshot_id, point, congestion, plain of every point: sums over a snapshot's cases; nothing where no row binds."""
    x = solved.select(S, F.explode("points").alias("x")).groupBy(S, F.col("x.point").alias("point")).agg(F.sum("x.congestion").alias("congestion"), F.sum("x.plain").alias("plain"))
    every = weights.select(S, F.col("point").cast("string").alias("point")).distinct()
    return every.join(x, [S, "point"], "left").fillna(0.0, ["congestion", "plain"])


def hour_prices(prices: DataFrame, solved: DataFrame, weights: DataFrame, system_prices: DataFrame) -> DataFrame:
    """snapshot_id, point, price, residual, plain_residual, source: published prices (snapshot_id, point, price) against the congestion that the
    binding rows explain, with weights over connected buses, and with plain ones."""
    added = congestion(solved, weights)
    own = reports.residuals(prices, added, system_prices)
    plain = reports.residuals(prices, added, system_prices, "plain").select(S, "point", F.col("residual").alias("plain_residual"))
    return own.join(plain, [S, "point"])


def hour_flows(binding: DataFrame, solved: DataFrame) -> DataFrame:
    """``binding`` (with published_mw and limit_mw) of rows that were applied and have a published flow, with our flow and how far apart they are; limits hold to a kilowatt."""
    df = outcomes(binding, solved).where("flow_mw is not null and published_mw is not null")
    diff = F.round(F.col("flow_mw") - F.col("published_mw"), 9)
    apart = F.abs(F.round(diff, 3))
    return df.withColumns({"difference": diff, "within_1_mw": apart <= 1, "within_5_percent": F.coalesce(apart <= 0.05 * F.abs("limit_mw"), F.lit(False)), "is_opposite": F.signum("flow_mw") != F.signum("published_mw")})


def base_flows(solved: DataFrame) -> DataFrame:
    """snapshot_id, branch_index, flow_mw of the intact networks, as ``reports.loadings`` takes them."""
    return solved.where("contingency = ''").select(S, F.posexplode("flows").alias("branch_index", "flow_mw")).withColumn("branch_index", F.col("branch_index").cast("long"))


def cut_off_prices(solved: DataFrame) -> DataFrame:
    """snapshot_id, bus_index, shadow_price: of the applied rows whose contingency cuts a bus off."""
    some = solved.where("n_islanded > 0 and not is_partial")
    mu = F.aggregate("rows", F.lit(0.0), lambda a, x: a + F.when(x["is_lost"], 0.0).otherwise(x["shadow_price"]))
    return some.select(S, F.explode("cut").alias("bus_index"), mu.alias("mu")).groupBy(S, "bus_index").agg(F.sum("mu").alias("shadow_price"))
