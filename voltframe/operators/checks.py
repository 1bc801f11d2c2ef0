"""Reports of models against what was published: hours of reports, binding constraints on branches, load shares, written patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock
from ..functions.text import name_key
from .assembly import Network
from .core import S

# Fixed value: the contingency of the intact network, by letters and digits.
BASE_CASE = "BASECASE"


def hour_rows(rows: DataFrame) -> DataFrame:
    """Rows of a published report (delivery_date, hour_ending, dst_flag, posted_at, doc_id) with their instant, of each hour's latest posting only."""
    start = clock.hour_ending_start(F.to_date("delivery_date", "MM/dd/yyyy"), F.col("hour_ending"), F.col("dst_flag"))
    df = rows.withColumn("interval_start_utc", start)
    newest = df.groupBy("interval_start_utc").agg(F.max_by("doc_id", F.struct(F.col("posted_at").isNotNull(), "posted_at", F.length("doc_id"), "doc_id")).alias("doc_id"))
    return df.join(newest, ["interval_start_utc", "doc_id"], "left_semi")


def row_direction(ends: tuple[str, str], kvs: tuple[str, str], stations: tuple[str, str], station_kvs: tuple[str, str]) -> Column:
    """1 where a published row reads a branch from its own first end, -1 against it, null where ends aren't recognised: by substations, within one by kilovolts to a tenth."""
    f, t, a, b = (F.col(c) for c in (*ends, *stations))
    x, y, p, q = (F.round(F.col(c), 1) for c in (*kvs, *station_kvs))
    apart = F.when((f == a) & (t == b), 1).when((f == b) & (t == a), -1)
    within = F.when(p == q, None).when((x == p) & (y == q), 1).when((x == q) & (y == p), -1)
    return F.when(f != t, apart).when(f == t, within)


def binding(shadow: DataFrame, net: Network, bus: DataFrame, gtcs: DataFrame) -> DataFrame:
    """Published binding rows (snapshot_id, constraint_name, contingency_name, from_station, to_station and their kilovolts) with branch_index, sign and outcome.

    ``gtcs`` has snapshot_id, gtc_id and n_missing of constraints whose members are known. What an outage cuts off is left to the solver:
    such rows are among ``used_contingency`` here.
    """
    sub = net.buses.join(bus.select(S, "bus_key", name_key(F.col("substation")).alias("__sub")), [S, "bus_key"], "left").select(S, "bus_index", "__sub", F.col("kv").alias("__kv"))
    lines = net.branches.select(S, name_key(F.col("branch_id")).alias("__name"), "branch_index", "from_index", "to_index")
    for end in ("from", "to"):
        lines = lines.join(sub.withColumnsRenamed({"bus_index": f"{end}_index", "__sub": f"__{end}_sub", "__kv": f"__{end}_kv"}), [S, f"{end}_index"])
    cut = net.contingencies.select(S, name_key(F.col("contingency_id")).alias("__ctg"), "branch_indexes", F.size("splits").alias("__splits"), (F.col("n_dropped") + F.col("n_unresolved")).alias("__lost"), "is_empty")
    known = gtcs.select(S, name_key(F.col("gtc_id")).alias("__name"), F.col("n_missing").alias("__missing"))
    df = shadow.withColumns({"__name": name_key(F.col("constraint_name")), "__ctg": name_key(F.col("contingency_name")), "__a": name_key(F.col("from_station")), "__b": name_key(F.col("to_station"))})
    df = df.join(known, [S, "__name"], "left").join(lines, [S, "__name"], "left").join(cut, [S, "__ctg"], "left")
    sign = row_direction(("__from_sub", "__to_sub"), ("__from_kv", "__to_kv"), ("__a", "__b"), ("from_station_kv", "to_station_kv"))
    outcome = (
        F.when(F.col("__missing") > 0, "used_gtc_crr_members_incomplete").when(F.col("__missing").isNotNull(), "used_gtc_crr_members")
        .when(F.col("branch_index").isNull(), "constraint_not_a_branch").when(F.col("sign").isNull(), "direction_not_recognized")
        .when(F.col("__ctg") == BASE_CASE, "used_base_case").when(F.col("is_empty") & (F.col("__lost") > 0), "binding_under_contingency_absent_in_model")
        .when(F.col("is_empty"), "used_non_topological_contingency").when(F.col("is_empty").isNull(), "contingency_unknown")
        .when(F.array_contains("branch_indexes", F.col("branch_index")), "constraint_is_outaged_by_its_contingency")
        .when(F.col("__lost") > 0, "used_contingency_partial").when(F.col("__splits") > 0, "used_contingency_split_bus").otherwise("used_contingency")
    )
    return df.withColumn("sign", sign).withColumn("outcome", outcome).select(*shadow.columns, "branch_index", "sign", "outcome")


def load_shares(model: DataFrame, published: DataFrame) -> DataFrame:
    """Shares of substations in their zone's load, model (substation, zone, mw) against report (substation, factor). A substation of two zones counts whole in its larger one."""
    key = F.upper("substation").alias("substation")
    by_zone = model.groupBy(key, "zone").agg(F.sum("mw").alias("mw"))
    whole = by_zone.groupBy("substation").agg(F.sum("mw").alias("model_mw"), F.max_by("zone", F.struct("mw", "zone")).alias("zone"))
    both = whole.join(published.groupBy(key).agg(F.sum("factor").alias("published")), "substation")
    zone = Window.partitionBy("zone")
    shares = both.withColumns({"model_share": F.try_divide("model_mw", F.sum("model_mw").over(zone)), "published_share": F.try_divide("published", F.sum("published").over(zone))})
    return shares.withColumn("diff", F.abs(F.col("model_share") - F.col("published_share")))


def patterns(df: DataFrame, by: list[str], value: str, k: int = 3) -> DataFrame:
    """The k commonest forms of texts (letters as A, digits as 9) of each group, ties to the smaller form."""
    form = F.regexp_replace(F.regexp_replace(F.col(value), "[0-9]", "9"), "[A-Za-z]", "A")
    n = df.where(F.col(value).isNotNull()).groupBy(*by, form.alias("pattern")).agg(F.count("*").alias("n"))
    order = Window.partitionBy(*by).orderBy(F.col("n").desc(), "pattern")
    return n.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def document_of_name(listed: DataFrame, names: DataFrame) -> DataFrame:
    """emil_id, name, doc_id: the one listed document that a file's name belongs to; the name may lack .zip or have its marks replaced. Null unless exactly one fits."""
    plain = listed.select("emil_id", "doc_id", F.explode(F.array_distinct(F.array("file_name", F.regexp_replace("file_name", "[^A-Za-z0-9._-]", "_")))).alias("__f"))
    stems = names.select("emil_id", "name", F.explode(F.array_distinct(F.array("name", F.regexp_replace("name", r"(?i)\.zip$", "")))).alias("__f"))
    fit = stems.join(plain, ["emil_id", "__f"]).groupBy("emil_id", "name").agg(F.collect_set("doc_id").alias("__d"))
    return names.join(fit, ["emil_id", "name"], "left").select("emil_id", "name", F.when(F.size("__d") == 1, F.get("__d", F.lit(0))).alias("doc_id"))


def common_days(*tables: DataFrame, day: str = "day") -> DataFrame:
    """Days that all tables have."""
    out = tables[0].select(day).distinct()
    for df in tables[1:]:
        out = out.intersect(df.select(day))
    return out
