"""Queries of reports, networks, listings and builds on the driver's tables, each beside the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import build, dc, reports
from ..operators.network import dense_index
from ..sources import listing
from .queries import money, query, table

S = "snapshot_id"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: money(F.col(c), digits) + 0.0 for c in columns})


@query("SELECT c_custkey FROM customer ORDER BY md5('1:' || c_custkey), c_custkey LIMIT 100")
def seeded_sample(spark, sf_dir):
    return build.sample(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", 100)


def binding(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias(S), F.when(F.col("o_orderstatus") == "F", "used_base_case").when(F.col("o_orderstatus") == "O", "used_contingency").otherwise("direction_not_recognized").alias("outcome"), F.col("o_totalprice").alias("shadow_price"))


BINDING = "SELECT o_orderpriority AS snapshot_id, CASE o_orderstatus WHEN 'F' THEN 'used_base_case' WHEN 'O' THEN 'used_contingency' ELSE 'direction_not_recognized' END AS outcome, o_totalprice AS shadow_price FROM orders"


@query(f"WITH b AS ({BINDING}), g AS (SELECT snapshot_id, outcome, count(*) AS n, sum(shadow_price) AS mu, sum(abs(shadow_price)) AS a FROM b GROUP BY 1, 2) SELECT snapshot_id, outcome, n AS rows, round(mu, 2) AS shadow_price, round(a / sum(a) OVER (PARTITION BY snapshot_id), 6) AS share FROM g")
def outcome_counts(spark, sf_dir):
    return rounded(rounded(reports.outcomes(binding(spark, sf_dir)), "share"), "shadow_price", digits=2)


@query(f"WITH b AS ({BINDING}) SELECT snapshot_id, round(sum(abs(shadow_price)) FILTER (outcome LIKE 'used%') / sum(abs(shadow_price)), 6) AS share_used FROM b GROUP BY 1")
def shadow_price_used(spark, sf_dir):
    return rounded(reports.share_used(binding(spark, sf_dir)), "share_used")


def weights(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.sum("l_quantity").alias("weight"))
    return rows.select(F.lit("s").alias(S), F.col("l_orderkey").alias("point"), F.col("l_partkey").alias("bus_index"), "weight")


def cut(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part").where("p_size <= 10")
    return p.select(F.lit("s").alias(S), F.when(F.col("p_size") <= 5, "low").otherwise("high").alias("contingency"), F.col("p_partkey").alias("bus_index"))


WEIGHTS = "SELECT l_orderkey AS point, l_partkey AS bus_index, sum(l_quantity) AS weight FROM lineitem GROUP BY 1, 2"
CUT = "SELECT CASE WHEN p_size <= 5 THEN 'low' ELSE 'high' END AS contingency, p_partkey AS bus_index FROM part WHERE p_size <= 10"


@query(f"""WITH w AS ({WEIGHTS}), c AS ({CUT}), k AS (SELECT w.*, n.contingency FROM w, (SELECT DISTINCT contingency FROM c) n WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.contingency = n.contingency AND c.bus_index = w.bus_index))
SELECT 's' AS snapshot_id, contingency, point, bus_index, round(weight / sum(weight) OVER (PARTITION BY contingency, point), 9) AS weight FROM k""")
def renormalized_weights(spark, sf_dir):
    return rounded(reports.renormalized(weights(spark, sf_dir), cut(spark, sf_dir)), "weight", digits=9).select(S, "contingency", "point", "bus_index", "weight")


@query(f"""WITH w AS ({WEIGHTS}), c AS ({CUT}), f AS (SELECT contingency, bus_index, 0.25 * cost AS cost FROM (SELECT CASE WHEN p_size % 3 = 0 THEN 'low' WHEN p_size % 3 = 1 THEN 'high' ELSE 'none' END AS contingency, p_partkey AS bus_index, CAST(p_size AS DOUBLE) AS cost FROM part)),
i AS (SELECT DISTINCT contingency FROM c), k AS (SELECT w.*, i.contingency FROM w, i WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.contingency = i.contingency AND c.bus_index = w.bus_index)),
r AS (SELECT contingency, point, bus_index, weight / sum(weight) OVER (PARTITION BY contingency, point) AS weight FROM k),
own AS (SELECT point, sum(v) AS congestion FROM (SELECT r.point, f.cost * r.weight AS v FROM f JOIN r USING (contingency, bus_index) UNION ALL SELECT w.point, f.cost * w.weight FROM f JOIN w USING (bus_index) WHERE f.contingency = 'none') GROUP BY 1),
plain AS (SELECT point, sum(f.cost * w.weight) AS plain FROM f JOIN w USING (bus_index) GROUP BY 1)
SELECT 's' AS snapshot_id, point, round(coalesce(congestion, 0), 9) AS congestion, round(coalesce(plain, 0), 9) AS plain FROM (SELECT DISTINCT point FROM w) LEFT JOIN own USING (point) LEFT JOIN plain USING (point)""")
def congestion_terms(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    which = F.when(F.col("p_size") % 3 == 0, "low").when(F.col("p_size") % 3 == 1, "high").otherwise("none")
    factors = p.select(F.lit("s").alias(S), which.alias("contingency"), F.lit(7).alias("branch_index"), F.col("p_partkey").alias("bus_index"), (F.col("p_size") / 4.0).alias("factor"))
    rows = factors.select(S, "contingency", "branch_index").distinct().withColumns({"sign": F.lit(-1), "shadow_price": F.lit(-1.0)})
    return rounded(reports.congestion(weights(spark, sf_dir), rows, factors, cut(spark, sf_dir)), "congestion", "plain", digits=9)


@query("""WITH p AS (SELECT o_orderpriority AS s, o_orderkey AS point, o_totalprice AS price, o_totalprice + o_custkey / 100.0 AS fitted FROM orders), m AS (SELECT s, median(fitted) AS mid FROM p GROUP BY 1)
SELECT p.s AS snapshot_id, point, price, round(fitted - CASE WHEN p.s = '1-URGENT' THEN 1000.0 ELSE mid END, 6) AS residual, CASE WHEN p.s = '1-URGENT' THEN 'published' ELSE 'fitted_median' END AS source FROM p JOIN m USING (s)""")
def price_residuals(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias(S), F.col("o_orderkey").alias("point"), F.col("o_totalprice").alias("price"), (F.col("o_custkey") / 100.0).alias("congestion"))
    known = spark.range(1).select(F.lit("1-URGENT").alias(S), F.lit(1000.0).alias("system_price"))
    return rounded(reports.residuals(o.select(S, "point", "price"), o.select(S, "point", "congestion"), known), "residual")


@query("""WITH p AS (SELECT o_orderpriority AS s, o_orderstatus AS block, o_orderkey AS point, o_totalprice - o_custkey * 100.0 / CASE o_orderstatus WHEN 'F' THEN 320 ELSE 160 END AS fitted FROM orders WHERE o_orderstatus <> 'P'), m AS (SELECT s, block, median(fitted) AS mid FROM p GROUP BY 1, 2)
SELECT s AS snapshot_id, block, point, round(fitted - mid, 6) AS residual, round(mid, 6) AS "offset" FROM p JOIN m USING (s, block)""")
def block_price_residuals(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderpriority").alias(S), F.col("o_orderstatus").alias("block"), F.col("o_orderkey").alias("point"), F.col("o_totalprice").alias("price"), (F.col("o_custkey") * 100.0).alias("cost"))
    hours = spark.createDataFrame([("F", 320), ("O", 160)], "block string, hours long")
    return rounded(reports.block_residuals(rows.select(S, "block", "point", "price"), rows.select(S, "block", "point", "cost"), hours), "residual", "offset")


@query("""SELECT c_mktsegment AS kind, count(c_acctbal) AS n, round(quantile_cont(abs(c_acctbal), 0.5), 6) AS p50_abs, round(quantile_cont(abs(c_acctbal), 0.9), 6) AS p90_abs, max(abs(c_acctbal)) AS max_abs, count(*) FILTER (abs(c_acctbal) <= 1) AS within, count(*) FILTER (abs(c_acctbal) > 5) AS beyond FROM customer GROUP BY 1""")
def residual_slices(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("kind"), F.col("c_acctbal").alias("residual"))
    return rounded(reports.slices(c, ["kind"]), "p50_abs", "p90_abs")


@query(f"WITH w AS ({WEIGHTS}), c AS ({CUT}) SELECT o_orderkey AS point, EXISTS (SELECT 1 FROM w JOIN c USING (bus_index) WHERE w.point = o_orderkey) AS is_cut FROM orders")
def points_cut_off(spark, sf_dir):
    points = table(spark, sf_dir, "orders").select(F.lit("s").alias(S), F.col("o_orderkey").alias("point"))
    return reports.cut_off(points, weights(spark, sf_dir), cut(spark, sf_dir)).select("point", "is_cut")


@query("""WITH a AS (SELECT DISTINCT c_nationkey AS nation, c_custkey % 500 AS item FROM customer), b AS (SELECT DISTINCT s_nationkey AS nation, s_suppkey % 500 AS item FROM supplier)
SELECT nation, count(*) FILTER (x AND y) AS agree, count(*) FILTER (x AND NOT y) AS only_ours, count(*) FILTER (y AND NOT x) AS only_theirs FROM (SELECT nation, item, bool_or(o) AS x, bool_or(NOT o) AS y FROM (SELECT *, true AS o FROM a UNION ALL SELECT *, false FROM b) GROUP BY 1, 2) GROUP BY 1""")
def list_agreement(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), (F.col("c_custkey") % 500).alias("item"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 500).alias("item"))
    return reports.agreement(a, b, ["nation"], "item")


@query("""WITH g AS (SELECT p_brand AS s, p_type AS grp, max(p_retailprice) - min(p_retailprice) AS spread FROM part GROUP BY 1, 2) SELECT s AS snapshot_id, count(*) AS "groups", count(*) FILTER (spread > 0.01) AS apart, round(max(spread), 6) AS largest FROM g GROUP BY 1""")
def similar_price_groups(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    out = reports.similar_groups(p.select(F.col("p_brand").alias(S), F.col("p_partkey").alias("point"), F.col("p_retailprice").alias("price")), p.select(F.col("p_brand").alias(S), F.col("p_partkey").alias("point"), F.col("p_type").alias("group_index")))
    return rounded(out, "largest")


def placement(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    q = o.groupBy(F.col("o_orderpriority").alias(S), F.col("o_custkey").alias("point")).agg(F.sum("o_totalprice").alias("net_mw"))
    c = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    names = o.select(F.col("o_orderpriority").alias(S)).distinct()
    points = names.join(c.select(F.col("c_custkey").alias("point"), F.col("c_mktsegment").alias("kind"), F.when(F.col("c_mktsegment") == "BUILDING", 0).otherwise(2).alias("n_buses")))
    buses = points.where("n_buses > 0").select(S, "point", F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).select(S, "point", (F.col("point") % 40 + F.col("k")).alias("bus_index"), F.when(F.col("k") == 0, 0.25).otherwise(0.75).alias("weight"))
    return reports.placed(q, points, buses)


PLACED = """q AS (SELECT o_orderpriority AS s, o_custkey AS point, sum(o_totalprice) AS mw FROM orders GROUP BY 1, 2),
k AS (SELECT q.*, coalesce(c_mktsegment, 'not_in_model') AS kind, coalesce(c_mktsegment <> 'BUILDING', false) AS is_placed FROM q LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON c_custkey = point)"""


@query(f"WITH {PLACED} SELECT s AS snapshot_id, bus_index, round(sum(mw * weight), 4) AS mw FROM (SELECT s, point % 40 + 0 AS bus_index, mw, 0.25 AS weight FROM k WHERE is_placed UNION ALL SELECT s, point % 40 + 1, mw, 0.75 FROM k WHERE is_placed) GROUP BY 1, 2")
def bus_injections(spark, sf_dir):
    return rounded(placement(spark, sf_dir)[0], "mw", digits=4)


@query(f"WITH {PLACED} SELECT s AS snapshot_id, is_placed, kind, count(*) AS points, round(sum(mw), 2) AS net_mw, round(sum(abs(mw)), 2) AS abs_mw FROM k GROUP BY 1, 2, 3")
def injections_placed(spark, sf_dir):
    return rounded(placement(spark, sf_dir)[1], "net_mw", "abs_mw", digits=2)


@query("""SELECT o_orderpriority AS snapshot_id, o_orderkey AS branch_index, round(abs(o_totalprice) / (o_custkey * 900.0), 6) AS loading, round(greatest(abs(o_totalprice) - o_custkey * 900.0, 0), 6) AS mw_above FROM orders WHERE o_orderstatus = 'F' AND o_custkey > 0""")
def branch_loadings(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias(S), F.col("o_orderkey").alias("branch_index"), F.col("o_totalprice").alias("flow_mw"), (F.col("o_orderstatus") == "F").alias("is_limited"), (F.col("o_custkey") * 900.0).alias("limit_mw"))
    return rounded(reports.loadings(rows.select(S, "branch_index", "flow_mw"), rows.drop("flow_mw")), "mw_above")


@query("""WITH b AS (SELECT o_orderpriority AS s, o_orderkey AS k, CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE -1 END AS sign, o_totalprice AS pub, o_totalprice * 0.9 AS lim, o_totalprice + o_custkey % 7 - 3 AS flow FROM orders WHERE o_orderstatus <> 'P')
SELECT s AS snapshot_id, k AS branch_index, round(sign * flow - pub, 6) AS difference, abs(sign * flow - pub) <= 1 AS within_1_mw, abs(sign * flow - pub) <= 0.05 * abs(lim) AS within_5_percent, sign(sign * flow) <> sign(pub) AS is_opposite FROM b""")
def binding_flow_differences(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    outcome = F.when(F.col("o_orderstatus") == "P", "contingency_unknown").otherwise("used_base_case")
    rows = o.select(F.col("o_orderpriority").alias(S), F.lit("").alias("contingency"), F.col("o_orderkey").alias("branch_index"), F.when(F.col("o_custkey") % 2 == 0, 1).otherwise(-1).alias("sign"), outcome.alias("outcome"), F.col("o_totalprice").alias("published_mw"), (F.col("o_totalprice") * 0.9).alias("limit_mw"))
    ours = o.select(F.col("o_orderpriority").alias(S), F.lit("").alias("contingency"), F.col("o_orderkey").alias("branch_index"), (F.col("o_totalprice") + F.col("o_custkey") % 7 - 3).alias("flow_mw"))
    return rounded(reports.flow_differences(rows, ours), "difference").select(S, "branch_index", "difference", "within_1_mw", "within_5_percent", "is_opposite")


@query("""WITH h AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey % 24 AS hour, sum(CASE WHEN o_orderstatus = 'O' THEN -o_totalprice ELSE o_totalprice END) AS net, sum(o_totalprice) AS supply FROM orders GROUP BY 1, 2)
SELECT day, count(*) AS hours, round(median(abs(net / supply)), 6) AS share_p50, round(max(abs(net / supply)), 6) AS share_max, round(median(abs(net)), 3) AS net_p50, round(max(abs(net)), 3) AS net_max FROM h GROUP BY 1""")
def daily_balance_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    net = F.when(F.col("o_orderstatus") == "O", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    hourly = o.groupBy(F.to_date("o_orderdate").alias("day"), (F.col("o_custkey") % 24).alias("hour")).agg(F.sum(net).alias("net_mw"), F.sum("o_totalprice").alias("supply_mw"))
    return rounded(rounded(reports.balance_summary(hourly), "share_p50", "share_max"), "net_p50", "net_max", digits=3)


@query("""WITH b AS (SELECT l_orderkey * 10 + l_linenumber AS id, 'P' || l_partkey AS device, l_linestatus AS d, CASE WHEN l_suppkey % 3 > 0 THEN 'C' || l_suppkey END AS ctg, l_partkey, l_suppkey FROM lineitem), j AS (SELECT b.*, p.p_size, s.s_nationkey AS nation FROM b LEFT JOIN (SELECT * FROM part WHERE p_size > 3) p ON p_partkey = l_partkey LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey > 1) s ON ctg IS NOT NULL AND s_suppkey = l_suppkey)
SELECT id, CASE WHEN p_size IS NULL THEN NULL ELSE l_partkey END AS branch_index, CASE WHEN p_size IS NULL THEN NULL WHEN d = 'F' THEN CASE WHEN p_size % 2 = 0 THEN -1 ELSE 1 END ELSE NULL END AS sign,
CASE WHEN p_size IS NULL THEN 'device_not_a_branch' WHEN d <> 'F' THEN 'direction_not_recognized' WHEN ctg IS NULL THEN 'used_base_case' WHEN nation < 5 AND nation % 2 = 1 THEN 'binding_under_contingency_absent_in_model' WHEN nation < 5 THEN 'used_non_topological_contingency' WHEN nation IS NULL THEN 'contingency_unknown' WHEN l_partkey % 100 = l_suppkey % 100 THEN 'device_is_outaged_by_its_contingency' WHEN nation % 2 = 1 THEN 'used_contingency_partial' WHEN nation % 3 = 0 THEN 'used_contingency_split_bus' ELSE 'used_contingency' END AS outcome FROM j""")
def block_binding_outcomes(spark, sf_dir):
    lines = table(spark, sf_dir, "part").where("p_size > 3").select(F.lit("s").alias(S), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("branch_id"), F.col("p_partkey").alias("branch_index"), (F.col("p_size") % 2 == 0).alias("is_name_reversed"))
    n = F.col("s_nationkey")
    # a set of parts is many suppliers' outage: it is listed once, a row for each part
    sets = table(spark, sf_dir, "part").select(F.lit("s").alias(S), (F.col("p_partkey") % 100).alias("outage_set"), F.col("p_partkey").alias("branch_index"))
    ctg = table(spark, sf_dir, "supplier").where("s_nationkey > 1").select(F.lit("s").alias(S), F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("contingency_id"), (F.col("s_suppkey") % 100).alias("outage_set"), (n % 2).alias("n_lost"), F.when(n % 3 == 0, 1).otherwise(0).alias("n_splits"), (n < 5).alias("is_empty"))
    line = table(spark, sf_dir, "lineitem")
    rows = line.select(F.lit("s").alias(S), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("device_name"), F.when(F.col("l_linestatus") == "F", F.when(F.col("l_partkey").isNotNull(), "From")).otherwise("none").alias("direction"), F.when(F.col("l_suppkey") % 3 > 0, F.concat(F.lit("C"), F.col("l_suppkey").cast("string"))).alias("contingency"))
    none = spark.createDataFrame([], f"{S} string, gtc_id string")
    sign = F.when(F.col("branch_index").isNotNull(), F.col("sign")).alias("sign")
    return reports.block_binding(rows, lines, ctg, none, sets).select("id", "branch_index", sign, "outcome")


@query("""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS delivery_date, o_orderkey AS doc_id, o_orderdate + INTERVAL (o_custkey % 50) HOUR AS posted FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY delivery_date ORDER BY posted DESC, length(CAST(doc_id AS VARCHAR)) DESC, doc_id DESC) AS n FROM d) SELECT delivery_date, doc_id FROM r WHERE n = 1""")
def latest_limits_by_day(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.to_date("o_orderdate").alias("delivery_date"), F.col("o_orderkey").alias("doc_id"), (F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_custkey") % 50).cast("int"))).alias("posted_at"))
    return build.latest_by_day(rows).select("delivery_date", "doc_id")


@query("""WITH a AS (SELECT DISTINCT l_returnflag AS model, l_partkey AS k FROM lineitem WHERE l_linestatus = 'F'), b AS (SELECT DISTINCT l_returnflag AS model, l_partkey AS k FROM lineitem WHERE l_linestatus = 'O')
SELECT model, count(*) FILTER (x AND y) AS kept, count(*) FILTER (x AND NOT y) AS gone, count(*) FILTER (y AND NOT x) AS "new" FROM (SELECT model, k, bool_or(o) AS x, bool_or(NOT o) AS y FROM (SELECT *, true AS o FROM a UNION ALL SELECT *, false FROM b) GROUP BY 1, 2) GROUP BY 1""")
def key_stability(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("model"), F.col("l_partkey").alias("key"), "l_linestatus")
    return build.stable_keys(rows.where("l_linestatus = 'F'"), rows.where("l_linestatus = 'O'"), "key")


@query("""WITH a AS (SELECT DISTINCT p_name AS x FROM part), b AS (SELECT DISTINCT CASE WHEN p_size % 3 = 0 THEN p_name ELSE replace(upper(p_name), ' ', '-') END AS y FROM part WHERE p_size < 40), k AS (SELECT DISTINCT regexp_replace(upper(y), '[^A-Z0-9]', '', 'g') AS k FROM b)
SELECT CASE WHEN x IN (SELECT y FROM b) THEN 'exact' WHEN regexp_replace(upper(x), '[^A-Z0-9]', '', 'g') IN (SELECT k FROM k) THEN 'normalized' ELSE 'none' END AS how, count(*) AS n FROM a GROUP BY 1""")
def name_agreement(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    other = p.where("p_size < 40").select(F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(F.regexp_replace(F.upper("p_name"), " ", "-")).alias("y"))
    return build.same_names(p, other, "p_name", "y")


@query("""SELECT o_custkey % 10 AS report_type_id, count(*) AS n_docs, count(*) FILTER (o_orderdate < TIMESTAMP '1995-06-01') AS n_before, min(o_orderdate) AS earliest_posted, max(o_orderdate) AS latest_posted, min(CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END) AS earliest_date, max(CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END) AS latest_date, CAST(sum(o_orderkey) AS BIGINT) AS total_bytes FROM orders GROUP BY 1""")
def listing_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    docs = o.select((F.col("o_custkey") % 10).alias("report_type_id"), F.col("o_orderdate").alias("posted_at"), F.when(F.col("o_orderstatus") == "P", "").otherwise(F.to_date("o_orderdate").cast("string")).alias("operating_date"), F.col("o_orderkey").alias("size_bytes"))
    return listing.summary(docs, F.lit("1995-06-01").cast("timestamp"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN 10000000 + o_custkey END AS report_type_id FROM orders""")
def product_of_name(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    name = F.concat(F.when(F.col("o_orderkey") % 3 > 0, "rpt.").otherwise("doc."), (F.col("o_custkey") + 10_000_000).cast("string"), F.lit(".csv.zip"))
    return o.select("o_orderkey", listing.product_of_name(name).alias("report_type_id"))


@query("""WITH a AS (SELECT o_orderkey AS doc_id, o_orderkey FROM orders WHERE o_orderstatus = 'F') SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderkey AS size_bytes FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM a)""")
def fetch_plan(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    listed = o.select(F.col("o_orderkey").cast("string").alias("doc_id"), F.lit("f").alias("file_name"), F.lit(None).cast("string").alias("url"), F.col("o_orderdate").alias("posted_at"), F.col("o_orderkey").alias("size_bytes"))
    archived = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("doc_id"))
    return listing.planned(listed.unionByName(listed), archived).select("doc_id", "size_bytes")


# Networks of parts: a brand's parts, in the order of their keys, are the buses of a chain or a ring


def parts_in_order(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias(S), "p_partkey", "p_size")
    return dense_index(p, S, "p_partkey", "bus_index").withColumn("n", F.count("*").over(Window.partitionBy(S)))


def lines(parts: DataFrame, *, ring: bool) -> DataFrame:
    rows = parts if ring else parts.where("bus_index + 1 < n")
    x = F.lit(0.1) if ring else (F.col("p_size") + 1) / 100.0
    return rows.select(S, F.col("bus_index").alias("branch_index"), F.col("bus_index").alias("from_index"), ((F.col("bus_index") + 1) % F.col("n")).alias("to_index"), x.alias("x_pu"), F.lit(1.0).alias("tap_ratio"), F.lit(0).cast("long").alias("slack_index"))


PARTS = "SELECT p_brand AS s, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS b, count(*) OVER (PARTITION BY p_brand) AS n FROM part"


@query(f"""WITH p AS ({PARTS}), q AS (SELECT l_partkey, sum(l_quantity) AS mw FROM lineitem GROUP BY 1), r AS (SELECT p.*, coalesce(mw, 0) AS mw FROM p LEFT JOIN q ON l_partkey = p_partkey), f AS (SELECT s, b, n, -coalesce(sum(mw) OVER (PARTITION BY s ORDER BY b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS flow FROM r)
SELECT s AS snapshot_id, CAST(b AS BIGINT) AS branch_index, round(flow, 3) + 0.0 AS flow_mw FROM f WHERE b + 1 < n""")
def chain_flows(spark, sf_dir):
    parts = parts_in_order(spark, sf_dir)
    q = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("mw"))
    injections = parts.join(q, F.col("l_partkey") == F.col("p_partkey")).select(S, "bus_index", "mw")
    return rounded(dc.flows(lines(parts, ring=False), injections), "flow_mw", digits=3)


@query(f"""WITH p AS ({PARTS}), k AS (SELECT * FROM p WHERE b < 3)
SELECT k.s AS snapshot_id, CAST(k.b AS BIGINT) AS branch_index, CAST(p.b AS BIGINT) AS bus_index, round(CASE WHEN p.b > k.b THEN -(p.n - p.b) / CAST(p.n AS DOUBLE) ELSE p.b / CAST(p.n AS DOUBLE) END, 6) + 0.0 AS factor FROM k JOIN p USING (s)""")
def ring_factors(spark, sf_dir):
    parts = parts_in_order(spark, sf_dir)
    wanted = parts.where("bus_index < 3").select(S, F.col("bus_index").alias("branch_index"))
    return rounded(dc.shift_factors(lines(parts, ring=True), wanted), "factor")


@query(f"""WITH p AS (SELECT DISTINCT s, n FROM ({PARTS})) SELECT s AS snapshot_id, c.contingency, CAST(CASE c.contingency WHEN 'one' THEN 0 ELSE n - 1 - n // 2 END AS BIGINT) AS n_islanded, CAST(CASE c.contingency WHEN 'one' THEN n - 1 ELSE n // 2 END AS BIGINT) AS n_moving FROM p, (VALUES ('one'), ('two')) c(contingency)""")
def ring_outages(spark, sf_dir):
    """One branch of a ring out leaves a chain; two out cut off what lies between."""
    parts = parts_in_order(spark, sf_dir)
    half, last = F.expr("n div 2").cast("long"), (F.col("n") - 1).cast("long")
    none = F.expr("cast(array() as array<struct<branch_index: long, split_end: string>>)")
    asked = parts.select(S, "n").distinct().select(S, F.explode(F.array(F.struct(F.lit("one").alias("contingency"), F.array(last).alias("out")), F.struct(F.lit("two").alias("contingency"), F.array(last, half).alias("out")))).alias("c"))
    asked = asked.select(S, "c.*", none.alias("splits"), F.array(F.lit(0).cast("long")).alias("wanted"))
    return dc.cases(lines(parts, ring=True), asked, parts=2).select(S, "contingency", "n_islanded", F.size(F.filter("factors", lambda x: F.abs(x) > 1e-6)).cast("long").alias("n_moving"))
