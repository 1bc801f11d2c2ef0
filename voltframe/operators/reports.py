"""Reports of a model's prices and flows against published ones, for all snapshots at once.

Frames are long: a row for each snapshot and point, branch, binding row or outcome. Nothing is gathered; the solver's rows
come from ``dc.cases``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import name_key
from .dc import S


# Prices


def renormalized(weights: DataFrame, cut: DataFrame, by: tuple[str, ...] = (S, "contingency")) -> DataFrame:
    """Weights (snapshot, point, bus, weight) of each contingency over the buses that it leaves connected, summing to one again; a point
    with no bus left has none. ``cut`` (snapshot, contingency, bus) names the buses cut off; contingencies without one aren't in it."""
    which = cut.select(*by).distinct()
    left = weights.join(which, by[0]).join(cut, [*by, "bus_index"], "left_anti")
    whole = F.sum("weight").over(Window.partitionBy(*by, "point"))
    return left.withColumn("weight", F.col("weight") / whole).where("weight is not null")


def congestion(weights: DataFrame, binding: DataFrame, factors: DataFrame, cut: DataFrame) -> DataFrame:
    """snapshot_id, point, congestion, plain: what binding rows (snapshot, contingency, branch, sign, shadow_price) add to a point's
    price by factors (snapshot, contingency, branch, bus, factor); in ``congestion`` weights are those over connected buses."""
    moved = binding.join(factors, [S, "contingency", "branch_index"]).withColumn("cost", F.col("sign") * F.col("shadow_price") * F.col("factor"))
    per_bus = moved.groupBy(S, "contingency", "bus_index").agg(F.sum("cost").alias("cost"))
    plain = per_bus.join(weights, [S, "bus_index"]).groupBy(S, "point").agg(F.sum(F.col("cost") * F.col("weight")).alias("plain"))
    islands = cut.select(S, "contingency").distinct()
    whole = per_bus.join(islands, [S, "contingency"], "left_anti").join(weights, [S, "bus_index"])
    parts = per_bus.join(renormalized(weights, cut), [S, "contingency", "bus_index"])
    own = whole.select(S, "point", "cost", "weight").unionByName(parts.select(S, "point", "cost", "weight")).groupBy(S, "point").agg(F.sum(F.col("cost") * F.col("weight")).alias("congestion"))
    zero = F.lit(0.0)
    return weights.select(S, "point").distinct().join(own, [S, "point"], "left").join(plain, [S, "point"], "left").select(S, "point", F.coalesce("congestion", zero).alias("congestion"), F.coalesce("plain", zero).alias("plain"))


def outcomes(binding: DataFrame) -> DataFrame:
    """snapshot_id, outcome, rows, shadow_price, share: counts and sums by outcome, and its part of all absolute shadow prices."""
    total = F.sum("__mu").over(Window.partitionBy(S))
    by = binding.groupBy(S, "outcome").agg(F.count("*").alias("rows"), F.sum("shadow_price").alias("shadow_price"), F.sum(F.abs("shadow_price")).alias("__mu"))
    return by.withColumn("share", F.try_divide("__mu", total)).drop("__mu")


def share_used(binding: DataFrame) -> DataFrame:
    """snapshot_id, share_used: how much of all absolute shadow prices rows carry whose outcome begins with ``used``."""
    mu = F.abs("shadow_price")
    return binding.groupBy(S).agg(F.try_divide(F.coalesce(F.sum(F.when(F.col("outcome").startswith("used"), mu)), F.lit(0.0)), F.sum(mu)).alias("share_used"))


def by_flags(binding: DataFrame, branches: DataFrame) -> DataFrame:
    """snapshot_id, is_secured, is_monitored, is_limited, rows of binding branches."""
    flags = ["is_secured", "is_monitored", "is_limited"]
    return binding.join(branches.select(S, "branch_index", *flags), [S, "branch_index"]).groupBy(S, *flags).agg(F.count("*").alias("rows"))


def residuals(prices: DataFrame, added: DataFrame, system_prices: DataFrame, column: str = "congestion") -> DataFrame:
    """snapshot_id, point, price, residual, source: a published price with the congestion taken off, against the published system price
    or, where there is none, the median of the snapshot's points."""
    fitted = prices.join(added, [S, "point"]).withColumn("__fitted", F.col("price") + F.col(column))
    middle = fitted.groupBy(S).agg(F.median("__fitted").alias("__median"))
    df = fitted.join(middle, S).join(system_prices, S, "left")
    source = F.when(F.col("system_price").isNotNull(), "published").otherwise("fitted_median")
    return df.select(S, "point", "price", (F.col("__fitted") - F.coalesce("system_price", "__median")).alias("residual"), source.alias("source"))


def block_residuals(published: DataFrame, cost: DataFrame, hours: DataFrame) -> DataFrame:
    """snapshot_id, block, point, residual, offset: posted prices per megawatt-hour less a block's cost per hour, from the block's median."""
    df = published.join(cost, [S, "block", "point"]).join(hours, "block").withColumn("__fitted", F.col("price") - F.col("cost") / F.col("hours"))
    offset = df.groupBy(S, "block").agg(F.median("__fitted").alias("offset"))
    return df.join(offset, [S, "block"]).select(S, "block", "point", (F.col("__fitted") - F.col("offset")).alias("residual"), "offset")


def slices(rows: DataFrame, by: list[str], value: str = "residual", within: float = 1.0, beyond: float = 5.0) -> DataFrame:
    """by, n, p50_abs, p90_abs, max_abs, within, beyond: absolute values by kind of point, train, cut-off state or any other label."""
    x = F.abs(value)
    return rows.groupBy(*by).agg(F.count(value).alias("n"), F.percentile(x, 0.5).alias("p50_abs"), F.percentile(x, 0.9).alias("p90_abs"), F.max(x).alias("max_abs"), F.count_if(x <= within).alias("within"), F.count_if(x > beyond).alias("beyond"))


def cut_off(points: DataFrame, weights: DataFrame, cut: DataFrame) -> DataFrame:
    """``points`` with is_cut: whether some contingency cuts off one of a point's buses."""
    hit = weights.join(cut.select(S, "bus_index").distinct(), [S, "bus_index"], "left_semi").select(S, "point").distinct().withColumn("__hit", F.lit(True))
    return points.join(hit, [S, "point"], "left").withColumn("is_cut", F.coalesce("__hit", F.lit(False))).drop("__hit")


def agreement(ours: DataFrame, theirs: DataFrame, by: list[str], item: str) -> DataFrame:
    """by, agree, only_ours, only_theirs: two lists of items, such as points cut off or without voltage."""
    a = ours.select(*by, item).distinct().withColumn("__a", F.lit(1))
    b = theirs.select(*by, item).distinct().withColumn("__b", F.lit(1))
    one, two = F.col("__a").isNotNull(), F.col("__b").isNotNull()
    return a.join(b, [*by, item], "full").groupBy(*by).agg(F.count_if(one & two).alias("agree"), F.count_if(one & ~two).alias("only_ours"), F.count_if(~one & two).alias("only_theirs"))


def similar_groups(prices: DataFrame, groups: DataFrame, cent: float = 0.01) -> DataFrame:
    """snapshot_id, groups, apart, largest: groups of points that should share a price, those whose prices lie over a cent apart, and the widest spread."""
    each = prices.join(groups, [S, "point"]).groupBy(S, "group_index").agg((F.max("price") - F.min("price")).alias("spread"))
    return each.groupBy(S).agg(F.count("*").alias("groups"), F.count_if(F.col("spread") > cent).alias("apart"), F.max("spread").alias("largest"))


# Flows


def placed(injections: DataFrame, points: DataFrame, point_buses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Injections (snapshot, point, net_mw) on buses (snapshot, bus, mw), and by kind of point what was and wasn't placed."""
    known = injections.join(points.select(S, "point", "kind", "n_buses"), [S, "point"], "left").withColumns({"kind": F.coalesce("kind", F.lit("not_in_model")), "is_placed": F.coalesce(F.col("n_buses") > 0, F.lit(False))})
    spread = known.where("is_placed").select(S, "point", "net_mw").join(point_buses.select(S, "point", "bus_index", "weight"), [S, "point"])
    at = spread.groupBy(S, "bus_index").agg(F.sum(F.col("net_mw") * F.col("weight")).alias("mw"))
    return at, known.groupBy(S, "is_placed", "kind").agg(F.count("*").alias("points"), F.sum("net_mw").alias("net_mw"), F.sum(F.abs("net_mw")).alias("abs_mw"))


def loadings(flow: DataFrame, branches: DataFrame) -> DataFrame:
    """snapshot_id, branch_index, loading (to six digits, so that a branch at its limit stays at it), mw_above of limited branches."""
    some = branches.where("is_limited and limit_mw > 0").select(S, "branch_index", "limit_mw")
    above = F.greatest(F.abs("flow_mw") - F.col("limit_mw"), F.lit(0.0))
    return flow.join(some, [S, "branch_index"]).select(S, "branch_index", F.round(F.abs("flow_mw") / F.col("limit_mw"), 6).alias("loading"), above.alias("mw_above"))


def flow_differences(binding: DataFrame, ours: DataFrame) -> DataFrame:
    """Binding rows that were used and have a published flow, with ours in the row's direction, the difference and what it says."""
    df = binding.where(F.col("outcome").startswith("used") & F.col("published_mw").isNotNull()).join(ours, [S, "contingency", "branch_index"])
    mw = F.col("sign") * F.col("flow_mw")
    diff = mw - F.col("published_mw")
    return df.select(*binding.columns, mw.alias("our_mw"), diff.alias("difference"), (F.abs(diff) <= 1).alias("within_1_mw"), F.coalesce(F.abs(diff) <= 0.05 * F.abs("limit_mw"), F.lit(False)).alias("within_5_percent"), (F.signum(mw) != F.signum("published_mw")).alias("is_opposite"))


def balance_summary(balance: DataFrame) -> DataFrame:
    """day, hours, share_p50, share_max, net_p50, net_max of an hourly balance (day, net_mw, supply_mw)."""
    share, net = F.abs(F.try_divide("net_mw", "supply_mw")), F.abs("net_mw")
    return balance.groupBy("day").agg(F.count("*").alias("hours"), F.median(share).alias("share_p50"), F.max(share).alias("share_max"), F.median(net).alias("net_p50"), F.max(net).alias("net_max"))


# Binding rows of auctions and borrowed constraints


def block_binding(binding: DataFrame, branches: DataFrame, contingencies: DataFrame, gtcs: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Binding rows of an auction's block (snapshot, device_name, direction, contingency) with branch_index, sign and outcome. ``branches``
    has branch_id, branch_index and is_name_reversed; contingencies branch_indexes, n_lost, n_splits and is_empty; ``gtcs`` gtc_id.

    Where many contingencies take out the same branches, or one takes out very many, contingencies have an outage_set instead of
    branch_indexes, and ``members`` (snapshot, outage_set, branch_index) a row for each branch of a set."""
    lines = branches.select(S, name_key(F.col("branch_id")).alias("__name"), "branch_index", F.coalesce("is_name_reversed", F.lit(False)).alias("__back"))
    cut = contingencies.select(S, name_key(F.col("contingency_id")).alias("__ctg"), "branch_indexes" if members is None else "outage_set", "n_lost", "n_splits", "is_empty")
    known = gtcs.select(S, name_key(F.col("gtc_id")).alias("__name")).distinct().withColumn("__gtc", F.lit(True))
    df = binding.withColumns({"__name": name_key(F.col("device_name")), "__ctg": name_key(F.coalesce("contingency", F.lit("")))})
    df = df.join(known, [S, "__name"], "left").join(lines, [S, "__name"], "left").join(cut, [S, "__ctg"], "left")
    is_out = F.array_contains("branch_indexes", F.col("branch_index"))
    if members is not None:
        is_out = F.col("__out")
        df = df.join(members.select(S, "outage_set", "branch_index", F.lit(True).alias("__out")).distinct(), [S, "outage_set", "branch_index"], "left")
    way = F.upper(F.trim("direction"))
    sign = F.when(way.startswith("FROM"), 1).when(way.startswith("TO"), -1) * F.when(F.col("__back"), -1).otherwise(1)
    return df.withColumn("sign", sign).withColumn("outcome", _outcome("device", is_out)).select(*binding.columns, "branch_index", "sign", "outcome")


def _outcome(what: str, is_out: Column) -> Column:
    return (
        F.when(F.col("__gtc"), "used_gtc").when(F.col("branch_index").isNull(), f"{what}_not_a_branch").when(F.col("sign").isNull(), "direction_not_recognized")
        .when(F.col("__ctg") == "", "used_base_case").when(F.col("is_empty") & (F.col("n_lost") > 0), "binding_under_contingency_absent_in_model")
        .when(F.col("is_empty"), "used_non_topological_contingency").when(F.col("is_empty").isNull(), "contingency_unknown")
        .when(is_out, f"{what}_is_outaged_by_its_contingency")
        .when(F.col("n_lost") > 0, "used_contingency_partial").when(F.col("n_splits") > 0, "used_contingency_split_bus").otherwise("used_contingency")
    )


def with_islands(binding: DataFrame, branches: DataFrame, solved: DataFrame, what: str = "constraint") -> DataFrame:
    """Binding rows whose outcome takes account of what ``dc.cases`` found: an end that its contingency cuts off, or other buses that it does."""
    state = solved.groupBy(S, "contingency").agg(F.max("n_islanded").alias("__islands"), F.max("cut").alias("__cut"))
    ends = branches.select(S, "branch_index", "from_index", "to_index")
    df = binding.join(state, [S, "contingency"], "left").join(ends, [S, "branch_index"], "left")
    lost = F.coalesce(F.array_contains("__cut", F.col("from_index")) | F.array_contains("__cut", F.col("to_index")), F.lit(False))
    outcome = F.when(F.col("outcome").startswith("used_contingency") & lost, f"{what}_islanded_by_its_contingency")
    outcome = outcome.when(F.col("outcome").isin("used_contingency", "used_contingency_split_bus") & (F.col("__islands") > 0), "used_contingency_islanding").otherwise(F.col("outcome"))
    return df.withColumn("outcome", outcome).select(*binding.columns)


def borrowed(members: DataFrame, ends: DataFrame, pairs: DataFrame, buses: DataFrame, dam: DataFrame) -> DataFrame:
    """gtc_id, branch_index, factor: an auction's constraint members (gtc_id, branch_id, factor) on the day-ahead model's branches, by
    matched ``pairs`` (crr_branch_id, dam_branch_id); the factor turns round where most matched ends are crossed, and a member whose ends
    don't tell is lost. ``ends`` and ``dam`` have a branch's buses (from_bus, to_bus), ``buses`` pairs of them."""
    to = buses.select(F.col("crr_bus").alias("__c"), F.col("dam_bus").alias("__d"))
    sides = ends.select("branch_id", "from_bus", "to_bus")
    for end in ("from", "to"):
        sides = sides.join(to.withColumnsRenamed({"__c": f"{end}_bus", "__d": f"__{end}"}), f"{end}_bus", "left")
    rows = members.join(sides.select("branch_id", "__from", "__to"), "branch_id", "left").join(pairs.select(F.col("crr_branch_id").alias("branch_id"), "dam_branch_id"), "branch_id", "left")
    rows = rows.join(dam.select(F.col("branch_id").alias("dam_branch_id"), "branch_index", F.col("from_bus").alias("__f"), F.col("to_bus").alias("__t")), "dam_branch_id", "left")

    def agree(a: str, b: str) -> Column:
        return F.coalesce((F.col(a) == F.col(b)).cast("int"), F.lit(0))

    turn = F.signum(agree("__from", "__f") + agree("__to", "__t") - agree("__from", "__t") - agree("__to", "__f"))
    return rows.where("branch_index is not null").withColumn("factor", F.col("factor") * turn).where("factor <> 0").select("gtc_id", "branch_index", "factor")


def incomplete(declared: DataFrame, found: DataFrame) -> DataFrame:
    """gtc_id, n_missing: members that a constraint (gtc_id, n_declared) has beyond those found."""
    n = found.groupBy("gtc_id").agg(F.count("*").alias("__n"))
    return declared.join(n, "gtc_id", "left").select("gtc_id", (F.col("n_declared") - F.coalesce("__n", F.lit(0))).alias("n_missing"))
