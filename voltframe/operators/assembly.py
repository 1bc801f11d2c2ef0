"""Networks ready for a DC solver, for all snapshots at once: what is in the main component, with dense indexes."""

from __future__ import annotations

from dataclasses import dataclass
from dataclasses import fields as dataclass_fields

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workers import shared
from .core import S, none, union
from .graph import main_component
from .network import dense_index, limits, signed_factor, slack

# The blocks that auction ratings have.
BLOCKS = ["PeakWD", "PeakWE", "Off-peak"]


@dataclass(frozen=True)
class Options:
    contract_ties: bool = False
    time_of_use: str = "PeakWD"

    def __post_init__(self) -> None:
        if self.time_of_use not in BLOCKS:
            raise ValueError(f"no block {self.time_of_use!r}; there are {BLOCKS}")


@dataclass(frozen=True)
class Network:
    buses: DataFrame
    branches: DataFrame
    slacks: DataFrame
    contingencies: DataFrame
    gtc_members: DataFrame
    point_buses: DataFrame
    dropped_buses: DataFrame
    dropped_branches: DataFrame

    def solver_rows(self) -> DataFrame:
        """Branches as the DC functions take them."""
        at = self.slacks.join(self.buses.select(S, F.col("bus_id").alias("slack"), F.col("bus_index").alias("slack_index")), [S, "slack"]).select(S, "slack_index")
        return self.branches.join(at, S).select(S, "branch_index", "from_index", "to_index", "x_pu", "tap_ratio", "slack_index")

    def written(self) -> "Network":
        """The same, each part written once to the shared folder: what is made of a network doesn't assemble it again."""
        return Network(*[shared(getattr(self, f.name)) for f in dataclass_fields(self)])

    def cases(self) -> DataFrame:
        """Contingencies as ``dc`` and ``hours`` take them."""
        return self.contingencies.where("not is_empty").select(S, F.col("contingency_id").alias("contingency"), F.col("branch_indexes").alias("out"), "splits")

    def weights(self) -> DataFrame:
        """Points' weights as ``reports`` and ``hours`` take them."""
        return self.point_buses.select(S, F.col("settlement_point_id").alias("point"), "bus_index", "weight")

    def summary(self) -> DataFrame:
        """snapshot_id, name, n: rows of each part."""
        parts = ("buses", "branches", "contingencies", "gtc_members", "point_buses", "dropped_buses", "dropped_branches")
        return union([getattr(self, p).groupBy(S).agg(F.count("*").alias("n")).select(S, F.lit(p).alias("name"), "n") for p in parts])


def bus_rows(bus: DataFrame, node: DataFrame, options: Options) -> DataFrame:
    """snapshot_id, bus_id, bus_key, node_number, kv, bus_type: core buses, or each node of auction models (``key@node`` where ties join it) unless ties are contracted."""
    if options.contract_ties:
        return bus.select(S, F.col("bus_key").alias("bus_id"), "bus_key", none("long").alias("node_number"), "kv", "bus_type")
    ident = F.when(F.col("is_tie_member"), F.concat_ws("@", "bus_key", F.col("node_number").cast("string"))).otherwise(F.col("bus_key"))
    nodes = node.select(S, ident.alias("bus_id"), "bus_key", "node_number", "kv", F.col("node_type").alias("bus_type"))
    whole = bus.join(node.select(S).distinct(), S, "left_anti").select(S, F.col("bus_key").alias("bus_id"), "bus_key", none("long").alias("node_number"), "kv", "bus_type")
    return whole.unionByName(nodes)


def _ends(branch: DataFrame, rows: DataFrame) -> DataFrame:
    """The bus rows that branches end at: by node where rows have nodes, else by bus key."""
    by_node = rows.where("node_number is not null").select(S, "node_number", F.col("bus_id").alias("__id"))
    df = branch
    for end in ("from", "to"):
        df = df.join(by_node.withColumnsRenamed({"node_number": f"{end}_node", "__id": f"__{end}"}), [S, f"{end}_node"], "left")
        df = df.withColumn(f"{end}_bus", F.coalesce(f"__{end}", f"{end}_bus_key")).drop(f"__{end}")
    return df


def _rated(branches: DataFrame, rating: DataFrame, block: str) -> DataFrame:
    """Limits of auction models from the monitored list's block, of hourly ones from the model; of several the lowest."""
    hourly = F.col(S).startswith("dam:")
    some = rating.where((hourly & (F.col("rating_source") == "psse_raw")) | (~hourly & (F.col("rating_source") == "crr_monitored") & (F.col("time_of_use") == block)))
    values = F.struct("base_mw", "emergency_mw")
    one = some.where("branch_id is not null").groupBy(S, "branch_id").agg(F.min_by(values, values).alias("__r")).select(S, "branch_id", "__r.*")
    return limits(branches.join(one, [S, "branch_id"], "left"))


def build_network(bus: DataFrame, node: DataFrame, branch: DataFrame, rating: DataFrame, outages: DataFrame, gtc_members: DataFrame, point_buses: DataFrame, options: Options = Options()) -> Network:
    """Drops what is out of service, contracted, a loop or off the largest component (dropped rows say why), then indexes the rest from 0 by id.

    Branches without an id or with an unknown end are dropped as unplaced.
    """
    rows = bus_rows(bus, node, options)
    at = _ends(branch, rows)
    placed = at.where("branch_id is not null and from_bus is not null and to_bus is not null")
    state, marked = main_component(rows, placed, "bus_id", "from_bus", "to_bus", S, F.coalesce("is_in_service", F.lit(False)))
    marked = marked.withColumn("reason", F.when((F.col("reason") == "loop") & F.col("is_tie"), "contracted_tie").otherwise(F.col("reason")))
    unplaced = at.where("branch_id is null or from_bus is null or to_bus is null").select(S, "branch_id", F.lit("unplaced").alias("reason"))

    buses = rows.join(state.where("reason is null").select(S, "bus_id"), [S, "bus_id"])
    buses = dense_index(buses, S, "bus_id", "bus_index")
    live = marked.where("reason is null").drop("reason")
    index = buses.select(S, "bus_id", "bus_index")
    for end in ("from", "to"):
        live = live.join(index.withColumnsRenamed({"bus_id": f"{end}_bus", "bus_index": f"{end}_index"}), [S, f"{end}_bus"])
    branches = dense_index(_rated(live, rating, options.time_of_use), S, "branch_id", "branch_index").withColumn("tap_ratio", F.coalesce("tap_ratio", F.lit(1.0)))
    ends = union([branches.select(S, F.col(f"{e}_bus").alias("bus_id")) for e in ("from", "to")])
    slacks = slack(buses, ends.groupBy(S, "bus_id").agg(F.count("*").alias("degree")), S, "bus_id")

    inside = branches.select(S, "branch_id", "branch_index")
    rest = F.col("element_kind").isin("load", "generator", "settlement_point")
    hit, split = F.col("branch_index").isNotNull(), (F.col("operation") == "split_bus") & F.col("split_end").isNotNull()
    cut = outages.join(inside, [S, "branch_id"], "left").groupBy(S, "contingency_id").agg(
        F.array_sort(F.collect_set(F.when(~split, F.col("branch_index")))).alias("branch_indexes"),
        F.array_sort(F.collect_set(F.when(split & hit, F.struct("branch_index", "split_end")))).alias("splits"),
        F.count_if(~rest & F.col("is_resolved") & ~hit).alias("n_dropped"), F.count_if(~rest & ~F.col("is_resolved")).alias("n_unresolved"), F.count_if(rest).alias("n_other_rows"),
    ).withColumn("is_empty", (F.size("branch_indexes") == 0) & (F.size("splits") == 0))

    members = gtc_members.join(branches.select(S, "branch_id", "branch_index", "is_name_reversed"), [S, "branch_id"])
    members = members.select(S, "gtc_id", "branch_index", signed_factor(F.col("factor"), F.col("flow_direction"), F.coalesce("is_name_reversed", F.lit(False))).alias("factor"))

    shares = rows.withColumn("__n", F.count("*").over(Window.partitionBy(S, "bus_key"))).join(index, [S, "bus_id"], "left").select(S, "bus_key", "bus_index", "__n")
    weights = point_buses.where("is_resolved and weight is not null").join(shares, [S, "bus_key"]).withColumn("__w", F.col("weight") / F.col("__n"))
    whole = Window.partitionBy(S, "settlement_point_id")
    kept = F.when(F.col("bus_index").isNotNull(), F.col("__w")).otherwise(0.0)
    weights = weights.withColumns({"__kept": F.sum(kept).over(whole), "__all": F.sum("__w").over(whole)}).where("bus_index is not null and __kept > 0")
    points = weights.groupBy(S, "settlement_point_id", "bus_index").agg((F.sum("__w") / F.max("__kept")).alias("weight"), F.max(F.col("__all") - F.col("__kept")).alias("weight_dropped"))
    return Network(buses, branches, slacks, cut, members, points, state.where("reason is not null"), marked.where("reason is not null").select(S, "branch_id", "reason").unionByName(unplaced))
