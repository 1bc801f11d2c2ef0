"""Two models of one grid: which branches, buses and contingencies are the same, and how they differ.

Every frame has ``pair_id``, so one job compares all pairs of snapshots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import name_key
from .core import none, union
from .relational import agrees, first_of

P = "pair_id"
TOLERANCE = 0.01
MANY = 5


def _alone(df: DataFrame, *by: str) -> DataFrame:
    """Rows that are the only ones of their key."""
    return df.withColumn("__n", F.count("*").over(Window.partitionBy(P, *by))).where("__n = 1").drop("__n")


def _without(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.where(F.col(key).isNotNull()).select(P, key).distinct(), [P, key], "left_anti")


def placeholder(mapping: DataFrame) -> DataFrame:
    """pair_id, placeholder: the operations name that most rows share, if more than a few do; it means nothing was mapped."""
    n = mapping.groupBy(P, "operations_name").count().where(F.col("count") > MANY)
    return n.groupBy(P).agg(F.max_by("operations_name", F.struct("count", "operations_name")).alias("placeholder"))


def match_branches(crr: DataFrame, lines: DataFrame, autos: DataFrame, dam: DataFrame) -> DataFrame:
    """crr_branch_id, dam_branch_id, match_method, operations_name, n_candidates.

    Names are compared by letters and digits: equal (``exact``), with the circuit (``ops+ckt``), as the only one with one or two
    characters more (``prefix``), or as the only free one of several whose reactance agrees (``prefix+x``). The rest of both sides follows.
    """
    c, d = "crr_branch_id", "dam_branch_id"
    ops = union([df.select(P, F.col(k).alias(c), "operations_name", F.lit(i).alias("__r")) for i, (df, k) in enumerate(((lines, "crr_tag"), (autos, "crr_name")))])
    ops = first_of(ops, [P, c], [F.col("__r"), F.col("operations_name")]).drop("__r").join(placeholder(lines), P, "left")
    ops = ops.select(P, c, F.when(F.col("placeholder").isNull() | (F.col("operations_name") != F.col("placeholder")), F.col("operations_name")).alias("operations_name"))
    left = crr.select(P, F.col("branch_id").alias(c), "ckt", F.col("x_pu").alias("__cx")).join(ops, [P, c], "left").withColumns({"__ops": name_key(F.col("operations_name")), "__ckt": F.concat(name_key(F.col("operations_name")), name_key(F.col("ckt")))})
    right = dam.where("branch_id is not null").groupBy(P, F.col("branch_id").alias(d)).agg(F.min("x_pu").alias("__dx")).withColumn("__dam", name_key(F.col(d)))

    def equal(rows: DataFrame, key: str, method: str) -> DataFrame:
        return rows.join(right.withColumnRenamed("__dam", key), [P, key]).select(P, c, d, F.lit(method).alias("match_method"), "operations_name", F.lit(1).cast("long").alias("n_candidates"))

    exact = equal(left, "__ops", "exact")
    rest = _without(left, exact, c)
    by_ckt = equal(rest, "__ckt", "ops+ckt")
    rest = _without(rest, by_ckt, c)
    stems = union([right.where(F.length("__dam") > n).withColumn("__ops", F.col("__dam").substr(F.lit(1), F.length("__dam") - n)) for n in (1, 2)]).select(P, d, "__dx", "__ops").distinct()
    found = rest.where("__ops <> ''").select(P, c, "__ops", "__cx").distinct().join(stems, [P, "__ops"]).withColumn("n_candidates", F.size(F.collect_set(d).over(Window.partitionBy(P, c))))
    one = found.where("n_candidates = 1").select(P, c, d, F.lit("prefix").alias("match_method")).distinct()
    taken = union([x.select(P, d) for x in (exact, by_ckt, one)]).distinct()
    several = found.where("n_candidates > 1").join(taken, [P, d], "left_anti").where(agrees(F.col("__cx"), F.col("__dx"), TOLERANCE)).select(P, c, d).distinct()
    several = _alone(_alone(several, c), d).withColumn("match_method", F.lit("prefix+x"))
    n = found.groupBy(P, c).agg(F.max("n_candidates").cast("long").alias("n_candidates"))
    late = rest.join(one.unionByName(several), [P, c], "left").join(n, [P, c], "left").select(P, c, d, F.coalesce("match_method", F.lit("unmatched")).alias("match_method"), "operations_name", F.coalesce("n_candidates", F.lit(0).cast("long")).alias("n_candidates"))
    done = union([exact, by_ckt, late])
    left_over = _without(right, done, d).select(P, none("string").alias(c), d, F.lit("unmatched").alias("match_method"), none("string").alias("operations_name"), F.lit(0).cast("long").alias("n_candidates"))
    return done.unionByName(left_over)


def match_buses(crr: DataFrame, dam: DataFrame, crr_branch: DataFrame, dam_branch: DataFrame, matches: DataFrame) -> DataFrame:
    """crr_bus_key, dam_bus_key, match_method, settlement_point, n_votes, n_candidates.

    First by settlement points that are on one bus of either side, if all of both buses agree; then by votes of matched branches' ends: each
    other's best with two votes, or with one where both buses end a single matched branch. A bus whose best vote ties stays unmatched.
    """
    c, d = "crr_bus_key", "dam_bus_key"
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def points(df: DataFrame, key: str) -> DataFrame:
        long = df.select(P, F.col("bus_key").alias(key), F.explode(F.split("attachments", r"\|")).alias("x")).where("startswith(x, 'S:')")
        return _alone(long.select(P, F.expr("substr(x, 3)").alias("settlement_point"), key).distinct(), "settlement_point")

    agreed = points(crr, c).join(points(dam, d), [P, "settlement_point"]).groupBy(P, c, d).agg(F.min("settlement_point").alias("settlement_point"), F.count("*").alias("n_votes"))
    wc, wd = Window.partitionBy(P, c), Window.partitionBy(P, d)
    by_point = agreed.withColumns({"__c": F.count("*").over(wc), "__d": F.count("*").over(wd)}).where("__c = 1 and __d = 1").select(P, c, d, F.lit("settlement_point").alias("match_method"), "settlement_point", "n_votes", one.alias("n_candidates"))

    pairs = matches.where("match_method <> 'unmatched'").select(P, "crr_branch_id", "dam_branch_id")
    ends = pairs
    for side, df in (("crr", crr_branch), ("dam", dam_branch)):
        ends = ends.join(df.select(P, F.col("branch_id").alias(f"{side}_branch_id"), F.array("from_bus_key", "to_bus_key").alias(f"__{side}")), [P, f"{side}_branch_id"])
    votes = ends.select(P, F.explode("__crr").alias(c), "__dam").select(P, c, F.explode("__dam").alias(d)).dropna(subset=[c, d]).groupBy(P, c, d).agg(F.count("*").alias("n_votes"))
    votes = _without(_without(votes, by_point, c), by_point, d)
    best = votes.withColumns({"__mc": F.max("n_votes").over(wc), "__md": F.max("n_votes").over(wd), "n_candidates": F.count("*").over(wc)})
    degrees = [ends.select(P, F.explode(f"__{s}").alias(k)).groupBy(P, k).agg(F.count("*").alias(f"__deg_{s}")) for s, k in (("crr", c), ("dam", d))]
    scored = best.where("n_votes = __mc and n_votes = __md").join(degrees[0], [P, c]).join(degrees[1], [P, d]).where("n_votes >= 2 or (__deg_crr = 1 and __deg_dam = 1)")
    by_end = _alone(_alone(scored, c), d).select(P, c, d, F.lit("branch_endpoints").alias("match_method"), none("string").alias("settlement_point"), "n_votes", "n_candidates")
    done = by_point.unionByName(by_end)

    def rest(df: DataFrame, mine: str, other: str) -> DataFrame:
        return _without(df.select(P, F.col("bus_key").alias(mine)).distinct(), done, mine).withColumns({other: none("string"), "match_method": F.lit("unmatched"), "settlement_point": none("string"), "n_votes": none("long")})

    n = best.groupBy(P, c).agg(F.max("n_candidates").alias("n_candidates"))
    left = rest(crr, c, d).join(n, [P, c], "left").fillna(0, ["n_candidates"])
    return union([done, left, rest(dam, d, c).withColumn("n_candidates", zero)])


def match_contingencies(crr_outages: DataFrame, dam_outages: DataFrame, matches: DataFrame) -> DataFrame:
    """By name (case and blanks at the ends aside; the first of equal ones by id), then by equal, non-empty sets of branches that point at one contingency."""
    c, d, zero = "crr_contingency_id", "dam_contingency_id", F.lit(0).cast("long")
    translate = matches.where("match_method <> 'unmatched'").select(P, F.col("crr_branch_id").alias("branch_id"), "dam_branch_id").dropna(subset=["branch_id"])
    name = F.upper(F.trim("contingency_id")).alias("__name")
    left = crr_outages.join(translate, [P, "branch_id"], "left").groupBy(P, "contingency_id", name).agg(F.count_distinct("branch_id").alias("n_crr_branches"), F.array_sort(F.collect_set("dam_branch_id")).alias("__cs")).withColumnRenamed("contingency_id", c)
    right = dam_outages.groupBy(P, "contingency_id", name).agg(F.array_sort(F.collect_set("branch_id")).alias("__ds"), F.count_if(F.col("element_kind") != "branch").alias("n_dam_other_rows"), F.bool_or(F.col("operation") == "split_bus").alias("has_split_bus")).withColumnRenamed("contingency_id", d)
    named = first_of(first_of(left.join(right, [P, "__name"]), [P, c], [F.col(d)]), [P, d], [F.col(c)]).withColumn("match_method", F.lit("name"))
    rest, others = _without(left, named, c).where("size(__cs) > 0"), _without(right, named, d).where("size(__ds) > 0")
    single = _alone(others.withColumn("__set", F.array_join("__ds", "\x1f")), "__set")
    member = _alone(rest.withColumn("__set", F.array_join("__cs", "\x1f")).join(single.drop("__name"), [P, "__set"]), d).withColumn("match_method", F.lit("members"))
    columns = [P, c, d, "match_method", "n_crr_branches", F.size("__ds").cast("long").alias("n_dam_branches"), F.size(F.array_intersect("__cs", "__ds")).cast("long").alias("n_shared_branches"), "n_dam_other_rows", "has_split_bus", F.lit(1).cast("long").alias("n_candidates")]
    done = named.select(columns).unionByName(member.select(columns))
    gone = F.lit("unmatched").alias("match_method")
    only_left = _without(left, done, c).select(P, c, none("string").alias(d), gone, "n_crr_branches", zero.alias("n_dam_branches"), zero.alias("n_shared_branches"), zero.alias("n_dam_other_rows"), F.lit(False).alias("has_split_bus"), zero.alias("n_candidates"))
    only_right = _without(right, done, d).select(P, none("string").alias(c), d, gone, zero.alias("n_crr_branches"), F.size("__ds").cast("long").alias("n_dam_branches"), zero.alias("n_shared_branches"), "n_dam_other_rows", "has_split_bus", zero.alias("n_candidates"))
    return union([done, only_left, only_right])


# Differences


def _side(branch: DataFrame, buses: DataFrame, ratings: DataFrame, side: str, enforced: str) -> DataFrame:
    kv = buses.select(P, "bus_key", F.floor("kv").cast("double").alias("kv"))
    rated = ratings.groupBy(P, "branch_id").agg(F.min_by(F.struct("base_mw", "emergency_mw"), F.struct("base_mw", "emergency_mw")).alias("r")).select(P, "branch_id", "r.*")
    df = branch
    for end in ("from", "to"):
        df = df.join(kv.withColumnsRenamed({"bus_key": f"{end}_bus_key", "kv": f"__{end}"}), [P, f"{end}_bus_key"], "left")
    df = df.join(rated, [P, "branch_id"], "left")
    values: list[tuple[str, Column]] = [("branch_id", F.col("branch_id")), ("kind", F.col("kind")), ("x_pu", F.col("x_pu")), ("kv_lo", F.least("__from", "__to")), ("kv_hi", F.greatest("__from", "__to")), ("is_in_service", F.col("is_in_service")), ("is_enforced", F.coalesce(enforced, F.lit(False))), ("base_mw", F.col("base_mw")), ("emergency_mw", F.col("emergency_mw"))]
    return df.select(P, *[v.alias(f"{side}_{n}") for n, v in values])


def diff_branches(matches: DataFrame, crr_branch: DataFrame, crr_buses: DataFrame, crr_ratings: DataFrame, dam_branch: DataFrame, dam_buses: DataFrame, dam_ratings: DataFrame, time_of_use: str = "PeakWD") -> DataFrame:
    """Matched branches side by side. Of several ratings of a branch in one block the lowest counts."""
    pairs = matches.where("match_method <> 'unmatched'").select(P, "crr_branch_id", "dam_branch_id", "match_method")
    crr = _side(crr_branch, crr_buses, crr_ratings.where((F.col("rating_source") == "crr_monitored") & (F.col("time_of_use") == time_of_use)), "crr", "is_monitored")
    dam = _side(dam_branch, dam_buses, dam_ratings.where("rating_source = 'psse_raw'"), "dam", "is_secured")
    df = pairs.join(crr, [P, "crr_branch_id"], "left").join(dam, [P, "dam_branch_id"], "left")
    return df.withColumns({"same_kind": F.col("crr_kind") == F.col("dam_kind"), "same_reactance": agrees(F.col("crr_x_pu"), F.col("dam_x_pu"), TOLERANCE), "same_kv": (F.col("crr_kv_lo") == F.col("dam_kv_lo")) & (F.col("crr_kv_hi") == F.col("dam_kv_hi"))})


def diff_settlement_points(crr_points: DataFrame, crr_rows: DataFrame, dam_points: DataFrame, dam_rows: DataFrame, bus_matches: DataFrame) -> DataFrame:
    """Points of both models: how many of their buses, and how much weight, they share."""
    k = [P, "settlement_point_id"]
    translate = bus_matches.where("match_method <> 'unmatched'").select(P, F.col("crr_bus_key").alias("bus_key"), F.col("dam_bus_key").alias("__d"))
    crr = crr_rows.where("is_resolved").join(translate, [P, "bus_key"], "left").select(*k, F.col("__d").alias("bus_key"), F.col("weight").alias("__wc"))
    dam = dam_rows.where("is_resolved").select(*k, "bus_key", F.col("weight").alias("__wd"))
    both = crr_points.select(*k, F.col("kind").alias("crr_kind")).join(dam_points.select(*k, F.col("kind").alias("dam_kind")), k)
    n_crr = crr.groupBy(k).agg(F.count("*").alias("n_crr_buses"), F.count_if(F.col("bus_key").isNull()).alias("n_crr_buses_unmatched"))
    n_dam = dam.groupBy(k).agg(F.count("*").alias("n_dam_buses"))
    shared = crr.join(dam, [*k, "bus_key"]).groupBy(k).agg(F.count("*").alias("n_shared_buses"), F.sum("__wc").alias("shared_weight_crr"), F.sum("__wd").alias("shared_weight_dam"))
    df = both.join(n_crr, k, "left").join(n_dam, k, "left").join(shared, k, "left").fillna(0, ["n_crr_buses", "n_dam_buses", "n_crr_buses_unmatched", "n_shared_buses", "shared_weight_crr", "shared_weight_dam"])
    n = F.col("n_shared_buses")
    return df.withColumns({"same_kind": F.col("crr_kind") == F.col("dam_kind"), "same_buses": (n == F.col("n_crr_buses")) & (n == F.col("n_dam_buses")) & (n > 0)})


def diff_loads(crr_loads: DataFrame, dam_loads: DataFrame, bus_matches: DataFrame) -> DataFrame:
    """Buses that have a load in either model; a bus without a partner keeps its row."""
    c, d, up = "crr_bus_key", "dam_bus_key", F.col("is_in_service")

    def total(value: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(value))), F.lit(0.0))

    crr = crr_loads.groupBy(P, F.col("bus_key").alias(c)).agg(F.count("*").alias("n_crr_loads"), F.count_if(up).alias("n_crr_in_service"), total("mw", up).alias("crr_mw_in_service"), total("mw", ~up).alias("crr_mw_out_of_service"))
    dam = dam_loads.groupBy(P, F.col("bus_key").alias(d)).agg(F.count("*").alias("n_dam_loads"), F.count_if(up).alias("n_dam_in_service"), total("mw", up).alias("dam_mw_in_service"), total("mw_ldf", up).alias("dam_mw_ldf_in_service"), total("mw_ldf", ~up).alias("dam_mw_ldf_out_of_service"), F.count_if("is_rollover_capable").alias("n_dam_rollover_capable"))
    pairs = bus_matches.where("match_method <> 'unmatched'").select(P, c, d, "match_method")
    left = crr.join(pairs, [P, c], "left").join(dam, [P, d], "left")
    right = _without(dam, left, d).join(pairs, [P, d], "left").join(crr.where("false"), [P, c], "left")
    df = left.unionByName(right.select(left.columns)).fillna("unmatched", ["match_method"]).fillna(0, ["n_crr_loads", "n_crr_in_service", "n_dam_loads", "n_dam_in_service"])
    return df.withColumns({"same_n_loads": F.col("n_crr_loads") == F.col("n_dam_loads"), "same_n_in_service": F.col("n_crr_in_service") == F.col("n_dam_in_service")})


def pair_coverage(**tables: DataFrame) -> DataFrame:
    """pair_id, table, matched, crr_unmatched, dam_unmatched of match tables, each under its name (branches, buses, contingencies)."""
    out = []
    for name, df in tables.items():
        c, d = (next(x for x in df.columns if x.startswith(f"{side}_") and x.endswith(("_id", "_key"))) for side in ("crr", "dam"))
        a, b = F.col(c).isNotNull(), F.col(d).isNotNull()
        out.append(df.groupBy(P).agg(F.count_if(a & b).alias("matched"), F.count_if(a & ~b).alias("crr_unmatched"), F.count_if(~a & b).alias("dam_unmatched")).withColumn("table", F.lit(name)))
    return union(out)
