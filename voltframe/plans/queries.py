"""The reference operators' queries on the driver's tables, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock, stats, text
from ..operators import dc, graph
from ..operators import relational as rel
from ..workers import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c, digits: int = 2):
    return F.round(c, digits)


KINDS = ["F", "O", "P"]


def awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("point"), F.col("o_orderstatus").alias("kind"), F.when(F.col("o_orderstatus") == "O", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("mw"))


AWARDS = "SELECT CAST(o_orderdate AS DATE) AS day, o_custkey AS point, o_orderstatus AS kind, CASE WHEN o_orderstatus = 'O' THEN -o_totalprice ELSE o_totalprice END AS mw FROM orders"


@query(f"""WITH a AS ({AWARDS}), w AS (SELECT day, point, sum(mw) FILTER (kind = 'F') AS f, sum(mw) FILTER (kind = 'O') AS o, sum(mw) FILTER (kind = 'P') AS p FROM a GROUP BY ALL)
SELECT day, point, round(f, 2) AS "F", round(o, 2) AS "O", round(p, 2) AS "P", round(coalesce(f, 0) + coalesce(o, 0) + coalesce(p, 0), 2) AS net_mw FROM w""")
def net_injections(spark, sf_dir):
    df = rel.net_by_kind(awards(spark, sf_dir), ["day", "point"], KINDS)
    return df.select("day", "point", *[money(F.col(c)).alias(c) for c in (*KINDS, "net_mw")])


@query(f"""WITH a AS ({AWARDS}), w AS (SELECT day, coalesce(sum(mw) FILTER (kind = 'F'), 0) AS f, coalesce(sum(mw) FILTER (kind = 'O'), 0) AS o, coalesce(sum(mw) FILTER (kind = 'P'), 0) AS p FROM a GROUP BY ALL)
SELECT day, round(f, 2) AS "F", round(o, 2) AS "O", round(p, 2) AS "P", round(f + o + p, 2) AS net_mw, round(greatest(f, 0) + greatest(o, 0) + greatest(p, 0), 2) AS supply_mw,
 round((f + o + p) / nullif(greatest(f, 0) + greatest(o, 0) + greatest(p, 0), 0), 6) AS net_share FROM w""")
def hourly_balance(spark, sf_dir):
    df = rel.balance(awards(spark, sf_dir), ["day"], KINDS)
    return df.select("day", *[money(F.col(c)).alias(c) for c in (*KINDS, "net_mw", "supply_mw")], money(F.col("net_share"), 6).alias("net_share"))


@query("""SELECT l_orderkey AS hour, l_suppkey AS point, 'source' AS kind, l_quantity AS mw FROM lineitem WHERE l_quantity <> 0
UNION ALL SELECT l_orderkey, l_partkey, 'sink', -l_quantity FROM lineitem WHERE l_quantity <> 0""")
def signed_union(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    part = [(li.select(F.col("l_orderkey").alias("hour"), F.col(c).alias("point"), F.col("l_quantity").alias("mw")), k, s) for c, k, s in (("l_suppkey", "source", 1), ("l_partkey", "sink", -1))]
    return rel.signed_union(part, ["hour", "point"])


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, length(CAST(o_orderkey AS VARCHAR)) DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def latest_posting(spark, sf_dir):
    return rel.latest(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, length(CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS INTEGER) AS revision FROM orders")
def revision_number(spark, sf_dir):
    return rel.revision(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "revision")


@query("""WITH s AS (SELECT s_nationkey AS point, s_suppkey % 7 AS bus, sum(s_acctbal) AS raw_weight FROM supplier WHERE s_acctbal >= 0 GROUP BY ALL)
SELECT point, bus, round(raw_weight, 2) AS raw_weight, round(CASE WHEN sum(raw_weight) OVER (PARTITION BY point) > 0 THEN raw_weight / sum(raw_weight) OVER (PARTITION BY point) END, 6) AS weight, true AS is_resolved FROM s
UNION ALL SELECT s_nationkey, NULL, round(s_acctbal, 2), NULL, false FROM supplier WHERE s_acctbal < 0""")
def normalized_weights(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("point"), (F.col("s_suppkey") % 7).alias("bus"), F.col("s_acctbal").alias("raw"), (F.col("s_acctbal") >= 0).alias("is_resolved"))
    df = rel.normalized(s, "point", "bus", "raw")
    return df.withColumns({"raw_weight": money(F.col("raw_weight")), "weight": money(F.col("weight"), 6)})


@query("""WITH b AS (SELECT n_regionkey AS hub, c_nationkey AS part, c_custkey AS bus FROM customer JOIN nation ON c_nationkey = n_nationkey), h AS (SELECT hub, count(DISTINCT part) AS n FROM b GROUP BY hub)
SELECT hub, part, bus, round(1.0 / n / count(bus) OVER (PARTITION BY hub, part), 9) AS weight FROM b JOIN h USING (hub)""")
def two_level_hub(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    b = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("hub"), F.col("c_nationkey").alias("part"), F.col("c_custkey").alias("bus"))
    return rel.two_level(b, "hub", "part", "bus").withColumn("weight", money(F.col("weight"), 9))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey AS target, round(l_quantity * l_discount, 4) AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity * l_tax, 4) FROM lineitem""")
def rollover_explode(spark, sf_dir):
    df = rel.handed_over(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_quantity", [("l_suppkey", "l_discount"), ("l_partkey", "l_tax")])
    return df.withColumn("amount", money(F.col("amount"), 4))


@query("SELECT c_custkey, CASE WHEN starts_with(upper(c_mktsegment), 'AUTO') THEN 'hub' WHEN starts_with(upper(c_mktsegment), 'B') THEN 'load_zone' WHEN starts_with(upper(c_mktsegment), 'MACH') THEN 'dc_tie' ELSE 'unknown' END AS kind FROM customer")
def kind_from_name(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.kind_of(F.col("c_mktsegment"), [("AUTO", "hub"), ("B", "load_zone"), ("MACH", "dc_tie")], prefix=True).alias("kind"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN p_partkey IS NOT NULL THEN l_partkey END AS l_partkey, p_partkey IS NOT NULL AS is_resolved FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 25) ON l_partkey = p_partkey")
def resolved_flag(spark, sf_dir):
    known = table(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"))
    return rel.resolved(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), known, "l_partkey")


@query("""WITH e AS (SELECT c_custkey % 40 AS a, c_nationkey AS b, min(c_custkey) AS id FROM customer GROUP BY ALL), u AS (SELECT a, b, id, false AS is_swapped FROM e UNION ALL SELECT b, a, id, true FROM e)
SELECT a, b, id, is_swapped FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY is_swapped, id) AS n FROM u) WHERE n = 1""")
def bidirectional_join(spark, sf_dir):
    e = table(spark, sf_dir, "customer").groupBy((F.col("c_custkey") % 40).alias("a"), F.col("c_nationkey").cast("long").alias("b")).agg(F.min("c_custkey").alias("id"))
    return rel.both_ways(e, "a", "b", ["id"])


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def semi_dim(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def anti_dim(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return rel.anti(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), o, "c_custkey")


_SETS = "SELECT {k}, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), '|' ORDER BY CAST(l_linenumber AS VARCHAR)) AS s FROM lineitem GROUP BY 1"


@query(f"""WITH a AS ({_SETS.format(k='l_orderkey AS order_a')}), b AS ({_SETS.format(k='l_partkey AS part_b')}), o AS (SELECT s, min(part_b) AS part_b FROM b GROUP BY s HAVING count(*) = 1)
SELECT order_a, part_b FROM a JOIN o USING (s)""")
def set_equality_match(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return rel.equal_sets(li.withColumnRenamed("l_orderkey", "order_a"), li.withColumnRenamed("l_partkey", "part_b"), "order_a", "part_b", "l_linenumber")


@query("""WITH a AS (SELECT DISTINCT left(p_brand, length(p_brand) - 1) AS stem FROM part), b AS (SELECT DISTINCT p_brand AS brand FROM part)
SELECT stem, brand FROM a JOIN b ON left(brand, length(brand) - 1) = stem UNION ALL SELECT stem, brand FROM a JOIN b ON length(brand) > 2 AND left(brand, length(brand) - 2) = stem""")
def prefix_match(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    a = p.select(F.expr("left(p_brand, length(p_brand) - 1)").alias("stem")).distinct()
    return rel.by_prefix(a, p.select(F.col("p_brand").alias("brand")).distinct(), "stem", "brand")


@query("""WITH v AS (SELECT o_custkey AS a, l_suppkey AS b, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
w AS (SELECT *, max(n) OVER (PARTITION BY a) AS ma, max(n) OVER (PARTITION BY b) AS mb, count(*) OVER (PARTITION BY a) AS da, count(*) OVER (PARTITION BY b) AS db FROM v),
x AS (SELECT a, b, n, count(*) OVER (PARTITION BY a) AS na, count(*) OVER (PARTITION BY b) AS nb FROM w WHERE n = ma AND n = mb AND (n >= 2 OR (da = 1 AND db = 1)))
SELECT a, b, n FROM x WHERE na = 1 AND nb = 1""")
def mutual_best_vote(spark, sf_dir):
    j = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rel.mutual_best(j.groupBy(F.col("o_custkey").alias("a"), F.col("l_suppkey").alias("b")).agg(F.count("*").alias("n")), "a", "b", "n")


@query("""WITH a AS (SELECT p_partkey AS pid, regexp_replace(upper(p_name), '[^A-Z0-9]', '', 'g') AS k1, p_partkey AS k2 FROM part), b AS (SELECT s_suppkey AS sid, regexp_replace(upper(s_name), '[^A-Z0-9]', '', 'g') AS k1, s_suppkey * 3 AS k2 FROM supplier),
u1 AS (SELECT x.pid, y.sid, 'name' AS method FROM (SELECT *, count(*) OVER (PARTITION BY k1) AS n FROM a WHERE k1 IS NOT NULL) x JOIN (SELECT *, count(*) OVER (PARTITION BY k1) AS n FROM b WHERE k1 IS NOT NULL) y ON x.k1 = y.k1 AND x.n = 1 AND y.n = 1),
a2 AS (SELECT * FROM a WHERE pid NOT IN (SELECT pid FROM u1)), b2 AS (SELECT * FROM b WHERE sid NOT IN (SELECT sid FROM u1)),
u2 AS (SELECT x.pid, y.sid, 'number' AS method FROM a2 x JOIN b2 y ON x.k2 = y.k2)
SELECT * FROM u1 UNION ALL SELECT * FROM u2 UNION ALL SELECT pid, NULL, 'unmatched' FROM a2 WHERE pid NOT IN (SELECT pid FROM u2) UNION ALL SELECT NULL, sid, 'unmatched' FROM b2 WHERE sid NOT IN (SELECT sid FROM u2)""")
def cascade_match(spark, sf_dir):
    a = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pid"), "p_name")
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sid"), "s_name")
    return rel.cascade(a, b, "pid", "sid", [("name", text.name_key(F.col("p_name")), text.name_key(F.col("s_name"))), ("number", F.col("pid"), F.col("sid") * 3)])


@query("""WITH l AS (SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS total FROM lineitem GROUP BY 1)
SELECT o_orderkey, abs(greatest(abs(o_totalprice), 0.0005) - greatest(abs(total), 0.0005)) <= 0.5 * greatest(greatest(abs(o_totalprice), 0.0005), greatest(abs(total), 0.0005)) AS is_same FROM orders JOIN l ON l_orderkey = o_orderkey""")
def reactance_agrees(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("total"))
    return table(spark, sf_dir, "orders").join(li, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", rel.agrees(F.col("o_totalprice"), F.col("total"), 0.5).alias("is_same"))


@query("""WITH k AS (SELECT c_custkey, left(sha1(upper(trim(c_mktsegment)) || '|' || CAST(c_nationkey AS VARCHAR)), 16) AS base FROM customer)
SELECT c_custkey, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN base || '#' || CAST(row_number() OVER (PARTITION BY base ORDER BY c_custkey) AS VARCHAR) ELSE base END AS bus_key, count(*) OVER (PARTITION BY base) > 1 AS is_ambiguous FROM k""")
def bus_key(spark, sf_dir):
    from ..operators.identity import with_keys

    c = table(spark, sf_dir, "customer").withColumn("label", F.concat_ws("|", text.squeezed(F.col("c_mktsegment")), F.col("c_nationkey").cast("string")))
    return with_keys(c, "label", "c_custkey").select("c_custkey", "bus_key", "is_ambiguous")


def with_order(li: DataFrame, o: DataFrame) -> DataFrame:
    """Lines with their orders, a million lines a task at most, however many there are: what a task sorts doesn't grow with the tables."""
    tasks = -(-li.count() // 1_000_000)
    if tasks > int(li.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))


def grid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A network for each return flag: every line joins its customer (even node) and supplier (odd); first lines of the largest quantity are in service."""
    j = with_order(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_linenumber", "l_quantity"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    edges = j.select(F.col("l_returnflag").alias("snap"), (F.col("o_custkey") * 2).alias("a"), (F.col("l_suppkey") * 2 + 1).alias("b"), ((F.col("l_linenumber") == 1) & (F.col("l_quantity") == 50)).alias("live"))
    return edges.select("snap", F.explode(F.array("a", "b")).alias("node")).distinct(), edges


_GRID = """edges AS (SELECT l_returnflag AS snap, o_custkey * 2 AS a, l_suppkey * 2 + 1 AS b, l_linenumber = 1 AND l_quantity = 50 AS live FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
nodes AS (SELECT snap, a AS node FROM edges UNION SELECT snap, b FROM edges),
e AS (SELECT snap, a, b FROM edges WHERE live AND a <> b UNION SELECT snap, b, a FROM edges WHERE live AND a <> b),
reach(snap, node, other) AS (SELECT snap, node, node FROM nodes UNION SELECT r.snap, r.node, e.b FROM reach r JOIN e ON r.snap = e.snap AND r.other = e.a),
comp AS (SELECT snap, node, min(other) AS component FROM reach GROUP BY ALL)"""


@query(f"WITH RECURSIVE {_GRID} SELECT snap, node, component FROM comp")
def connected_components(spark, sf_dir):
    nodes, edges = grid(spark, sf_dir)
    return graph.components(nodes, edges.where("live and a <> b"), "node", "a", "b", "snap")


def whole_grid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The same network with every line's edge; all but those of the largest quantity (one in fifty) are in service."""
    j = with_order(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_linenumber", "l_quantity"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    edges = j.select(F.col("l_returnflag").alias("snap"), (F.col("o_custkey") * 2).alias("a"), (F.col("l_suppkey") * 2 + 1).alias("b"), (F.col("l_quantity") < 50).alias("live"))
    return edges.select("snap", F.explode(F.array("a", "b")).alias("node")).distinct(), edges


def _whole_grid(live: str) -> str:
    return f"""edges AS (SELECT l_returnflag AS snap, o_custkey * 2 AS a, l_suppkey * 2 + 1 AS b, l_quantity < 50 AS live FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
nodes AS (SELECT snap, a AS node FROM edges UNION SELECT snap, b FROM edges),
e AS (SELECT snap, a, b FROM edges WHERE {live} UNION SELECT snap, b, a FROM edges WHERE {live}),
comp(snap, node, component) USING KEY (snap, node) AS (SELECT snap, node, node FROM nodes
 UNION SELECT e.snap, e.b, min(c.component) FROM comp c JOIN e ON c.snap = e.snap AND c.node = e.a JOIN recurring.comp r ON r.snap = e.snap AND r.node = e.b WHERE c.component < r.component GROUP BY e.snap, e.b)"""


@query(f"WITH RECURSIVE {_whole_grid('true')} SELECT snap, node, component FROM comp")
def whole_connected_components(spark, sf_dir):
    nodes, edges = whole_grid(spark, sf_dir)
    return graph.components(nodes, edges, "node", "a", "b", "snap")


@query(f"""WITH RECURSIVE {_whole_grid('true')}, size AS (SELECT snap, component, count(*) AS n FROM comp GROUP BY ALL), top AS (SELECT snap, component AS main FROM (SELECT *, row_number() OVER (PARTITION BY snap ORDER BY n DESC, component DESC) AS k FROM size) WHERE k = 1)
SELECT snap, node, CASE WHEN component = main THEN NULL WHEN n = 1 THEN 'isolated' ELSE 'island' END AS reason FROM comp JOIN size USING (snap, component) JOIN top USING (snap)""")
def main_component(spark, sf_dir):
    nodes, edges = whole_grid(spark, sf_dir)
    return graph.main_component(nodes, edges, "node", "a", "b", "snap", F.lit(True))[0]


@query(f"""WITH RECURSIVE {_whole_grid('live')}, size AS (SELECT snap, component, count(*) AS n FROM comp GROUP BY ALL), top AS (SELECT snap, component AS main FROM (SELECT *, row_number() OVER (PARTITION BY snap ORDER BY n DESC, component DESC) AS k FROM size) WHERE k = 1)
SELECT snap, node, CASE WHEN component = main THEN NULL WHEN n = 1 THEN 'isolated' ELSE 'island' END AS reason FROM comp JOIN size USING (snap, component) JOIN top USING (snap)""")
def whole_main_component(spark, sf_dir):
    nodes, edges = whole_grid(spark, sf_dir)
    return graph.main_component(nodes, edges, "node", "a", "b", "snap", F.col("live"))[0]


@query("""SELECT p_partkey, CASE WHEN p_size > 20 AND p_retailprice > 0 THEN p_retailprice ELSE 'inf'::DOUBLE END AS limit_mw,
CASE WHEN p_size > 20 AND p_retailprice > 0 THEN CASE WHEN p_size * 40.0 > p_retailprice THEN p_size * 40.0 ELSE p_retailprice END ELSE 'inf'::DOUBLE END AS contingency_mw FROM part""")
def limits_or_inf(spark, sf_dir):
    from ..operators.network import limits

    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") > 20).alias("is_secured"), F.col("p_retailprice").alias("base_mw"), F.when(F.col("p_size") * 40.0 > F.col("p_retailprice"), F.col("p_size") * 40.0).alias("emergency_mw"))
    return limits(p).select("p_partkey", "limit_mw", "contingency_mw")


@query("""SELECT l_orderkey, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), '|' ORDER BY CAST(l_suppkey AS VARCHAR)) FILTER (l_returnflag <> 'R') AS branches, count(*) FILTER (l_returnflag = 'R') AS n_dropped,
count(*) FILTER (l_linestatus = 'O') AS n_unresolved, count(*) FILTER (l_returnflag <> 'R') = 0 AS is_empty FROM lineitem GROUP BY l_orderkey""")
def contingency_sets(spark, sf_dir):
    from ..operators.network import outage_sets

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("branch"), (F.col("l_returnflag") == "R").alias("is_dropped"), (F.col("l_linestatus") == "O").alias("is_unresolved"))
    return outage_sets(li, ["l_orderkey"], "branch")


@query("""SELECT l_orderkey, round(sum(l_discount * CASE WHEN l_returnflag = 'A' THEN -1 ELSE 1 END * CASE WHEN l_linestatus = 'O' THEN -1 ELSE 1 END), 4) + 0.0 AS factor, count(*) AS n_members FROM lineitem GROUP BY 1""")
def signed_members(spark, sf_dir):
    from ..operators.network import signed_factor

    sign = signed_factor(F.col("l_discount"), F.when(F.col("l_returnflag") == "A", "TO-FROM").otherwise("FROM-TO"), F.col("l_linestatus") == "O")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.round(F.sum(sign), 4) + 0.0).alias("factor"), F.count("*").alias("n_members"))


@query("""WITH s AS (SELECT s_nationkey AS point, s_suppkey AS bus, 1.0::DOUBLE / count(*) OVER (PARTITION BY s_nationkey) AS weight, s_acctbal > 0 AS inside FROM supplier),
k AS (SELECT *, sum(CASE WHEN inside THEN weight ELSE 0 END) OVER (PARTITION BY point) AS kept, sum(weight) OVER (PARTITION BY point) AS total FROM s)
SELECT point, bus, round(weight / kept, 6) AS weight, round(total - kept, 6) AS weight_dropped FROM k WHERE inside AND kept > 0""")
def renormalized_points(spark, sf_dir):
    from pyspark.sql import Window

    s = table(spark, sf_dir, "supplier")
    w = s.select(F.col("s_nationkey").alias("point"), F.col("s_suppkey").alias("bus"), (1.0 / F.count("*").over(Window.partitionBy("s_nationkey"))).alias("weight"))
    out = rel.renormalized(w, s.where("s_acctbal > 0").select(F.col("s_suppkey").alias("bus")), "point", "bus")
    return out.withColumns({"weight": money(F.col("weight"), 6), "weight_dropped": F.abs(money(F.col("weight_dropped"), 6))})


@query("""WITH a AS (SELECT o_custkey AS bus, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS bus, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT coalesce(a.bus, b.bus) AS bus, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b, CASE WHEN b.bus IS NULL THEN 'a_only' WHEN a.bus IS NULL THEN 'b_only' ELSE 'matched' END AS side, coalesce(a.n, 0) = coalesce(b.n, 0) AS same_n FROM a FULL JOIN b ON a.bus = b.bus""")
def diff_side_by_side(spark, sf_dir):
    from ..operators.diff import side_by_side

    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("bus"), "o_orderstatus")
    a, b = (o.where(F.col("o_orderstatus") == s).groupBy("bus").agg(F.count("*").alias("n")) for s in "FO")
    return side_by_side(a, b, "bus", "n")


@query("""SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_filled, count(*) FILTER (o_totalprice > 150000) AS n_large, count(DISTINCT o_custkey) + CASE WHEN count(*) > count(o_custkey) THEN 1 ELSE 0 END AS n_customers FROM orders""")
def coverage_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_filled"), F.count_if(F.col("o_totalprice") > 150000).alias("n_large"), (F.count_distinct("o_custkey") + F.when(F.count("*") > F.count("o_custkey"), 1).otherwise(0)).alias("n_customers"))


@query("""SELECT l_returnflag, count(l_extendedprice) AS n, round(quantile_cont(abs(l_extendedprice), 0.5), 4) AS abs_p50, round(quantile_cont(abs(l_extendedprice), 0.9), 4) AS abs_p90, round(quantile_cont(abs(l_extendedprice), 0.99), 4) AS abs_p99,
round(max(abs(l_extendedprice)), 4) AS abs_max, round(median(l_extendedprice), 4) AS median, count(*) FILTER (abs(l_extendedprice) <= 10000) AS within_0 FROM lineitem GROUP BY 1""")
def quantile_report(spark, sf_dir):
    return stats.quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"], (10000,), 4)


@query("""SELECT CASE WHEN l_quantity = 50 THEN 50.0 WHEN l_quantity < 10 THEN 10.0 WHEN l_quantity < 25 THEN 25.0 ELSE 50.0 END::DOUBLE AS upper_edge, count(*) AS n FROM lineitem WHERE l_quantity >= 1 AND l_quantity <= 50 GROUP BY 1""")
def histogram_bins(spark, sf_dir):
    return stats.histogram(table(spark, sf_dir, "lineitem"), "l_quantity", [1, 10, 25, 50])


@query("SELECT c_custkey, c_nationkey, round(abs(c_acctbal) / sum(abs(c_acctbal)) OVER (PARTITION BY c_nationkey), 8) AS share FROM customer")
def share_within_zone(spark, sf_dir):
    from pyspark.sql import Window

    x = F.abs("c_acctbal")
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", money(F.try_divide(x, F.sum(x).over(Window.partitionBy("c_nationkey"))), 8).alias("share"))


@query("SELECT o_orderpriority, round(max(o_totalprice) - min(o_totalprice), 2) AS spread FROM orders GROUP BY 1")
def group_spread(spark, sf_dir):
    return stats.spread(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderpriority"]).withColumn("spread", money(F.col("spread")))


@query("""WITH p AS (SELECT c_nationkey AS point, round(avg(c_acctbal), 4) AS price, 16 + c_nationkey % 3 AS hours FROM customer GROUP BY ALL),
a AS (SELECT s_suppkey AS id, s_nationkey AS source, CAST(s_suppkey % 25 AS INTEGER) AS sink FROM supplier)
SELECT id, round(k.price - s.price, 4) AS price, round((s.price * s.hours + k.price * k.hours) / (s.hours + k.hours), 6) AS mean_price FROM a LEFT JOIN p s ON s.point = source LEFT JOIN p k ON k.point = sink""")
def obligation_prices(spark, sf_dir):
    from ..operators.prices import obligations

    p = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("point")).agg(F.round(F.avg("c_acctbal"), 4).alias("price")).withColumn("hours", 16 + F.col("point") % 3)
    a = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("source"), (F.col("s_suppkey") % 25).cast("int").alias("sink"))
    return obligations(a, p).select("id", money(F.col("price"), 4).alias("price"), money(F.col("mean_price"), 6).alias("mean_price"))


@query("""WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders), d AS (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM m),
f AS (SELECT *, isodow(day) AS w, month(day) AS mm, day(day) AS dd FROM d),
h AS (SELECT *, ((mm, dd) IN ((1, 1), (7, 4), (12, 25)) AND w <> 7) OR ((mm, dd) IN ((1, 2), (7, 5), (12, 26)) AND w = 1) OR (mm = 5 AND w = 1 AND dd > 24) OR (mm = 9 AND w = 1 AND dd <= 7) OR (mm = 11 AND w = 4 AND dd BETWEEN 22 AND 28) AS off FROM f)
SELECT month, 16 * count(*) FILTER (w <= 5 AND NOT off) AS peak_wd, 16 * count(*) FILTER (NOT (w <= 5 AND NOT off)) AS peak_we, 8 * count(*) AS off_peak FROM h GROUP BY 1""")
def block_hours(spark, sf_dir):
    return clock.block_hours(table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("month")))


@query("""WITH e AS (SELECT event_id, CAST(ts AS DATE) AS d FROM events), y AS (SELECT *, year(d) AS yy FROM e),
s AS (SELECT *, make_date(yy, 3, 1) AS m1, make_date(yy, 11, 1) AS n1 FROM y), t AS (SELECT *, m1 + CAST(7 - isodow(m1) + 7 AS INTEGER) AS spring, n1 + CAST(7 - isodow(n1) AS INTEGER) AS fall FROM s)
SELECT event_id, CAST(d AS TIMESTAMP) + INTERVAL 13 HOUR + CASE WHEN d >= spring AND d < fall THEN INTERVAL 5 HOUR ELSE INTERVAL 6 HOUR END AS start_utc FROM t""")
def local_hour_instant(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("d"))
    return e.select("event_id", clock.hour_ending_start(F.col("d"), F.lit("14:00")).cast("timestamp_ntz").alias("start_utc"))


@query("""SELECT p_partkey, 'p_size' AS name, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""")
def unpivot_wide(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return p.unpivot("p_partkey", ["p_size", "p_retailprice"], "name", "value")


@query("SELECT c_custkey AS key, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier")
def schema_union(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    one = c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    return one.unionByName(s.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal")), allowMissingColumns=True)


@query("SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS parts, max(l_shipdate) AS last_ship, min(l_returnflag) AS flag FROM lineitem GROUP BY 1")
def packages_listagg(spark, sf_dir):
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"].cast("string")), ",")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(parts.alias("parts"), F.max("l_shipdate").alias("last_ship"), F.min("l_returnflag").alias("flag"))


@query("SELECT event_type, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY 1")
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").cast("long")).alias("total"))


def triangle(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Buses 0 to 2 in a ring, bus 3 hanging on bus 2, slack 1, for each row of (snapshot_id, x_pu), the reactance of all."""
    ship(spark)
    ends = F.array(*[F.struct(F.lit(j).cast("long").alias("branch_index"), F.lit(a).cast("long").alias("from_index"), F.lit(b).cast("long").alias("to_index")) for j, (a, b) in enumerate([(0, 1), (1, 2), (2, 0), (2, 3)])])
    return rows.select("snapshot_id", "x_pu", F.explode(ends).alias("e")).select("snapshot_id", "e.*", "x_pu", F.lit(None).cast("double").alias("tap_ratio"), F.lit(1).cast("long").alias("slack_index"))


def triangles(spark, sf_dir) -> DataFrame:
    """One for each supplier."""
    return triangle(spark, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("snapshot_id"), ((F.col("s_suppkey") % 7 + 1) / 10.0).alias("x_pu")))


def _factors(rows: list[list[float]]) -> str:
    values = ", ".join(f"({m}, {b}, {v!r}::DOUBLE)" for m, r in enumerate(rows) for b, v in enumerate(r))
    return f"SELECT CAST(s_suppkey AS VARCHAR) AS snapshot_id, CAST(branch_index AS BIGINT) AS branch_index, CAST(bus_index AS BIGINT) AS bus_index, round(factor, 9) AS factor FROM supplier, (VALUES {values}) v(branch_index, bus_index, factor)"


@query(_factors([[2 / 3, 0.0, 1 / 3, 1 / 3], [-1 / 3, 0.0, -2 / 3, -2 / 3], [-1 / 3, 0.0, 1 / 3, 1 / 3], [0.0, 0.0, 0.0, -1.0]]))
def dc_shift_factors(spark, sf_dir):
    return dc.shift_factors(triangles(spark, sf_dir))


@query(_factors([[1.0, 0.0, 0.0, 0.0], [0.0, 0.0, -1.0, -1.0], [0.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, -1.0]]))
def dc_outage(spark, sf_dir):
    return dc.shift_factors(triangles(spark, sf_dir), outage=2)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS snapshot_id, CAST(m AS BIGINT) AS branch_index, round(s_acctbal * f, 4) + 0.0 AS flow_mw FROM supplier, (VALUES (0, 5/9::DOUBLE), (1, -1/9::DOUBLE), (2, -4/9::DOUBLE), (3, 3/9::DOUBLE)) v(m, f)")
def dc_flows(spark, sf_dir):
    """A supplier's balance goes in at bus 0, a third of it out at bus 3."""
    s = table(spark, sf_dir, "supplier")
    q = s.select(F.col("s_suppkey").cast("string").alias("snapshot_id"), F.explode(F.array(F.struct(F.lit(0).cast("long").alias("bus_index"), F.col("s_acctbal").alias("mw")), F.struct(F.lit(3).cast("long").alias("bus_index"), (-F.col("s_acctbal") / 3).alias("mw")))).alias("q"))
    return dc.flows(triangles(spark, sf_dir), q.select("snapshot_id", "q.*")).withColumn("flow_mw", money(F.col("flow_mw"), 4) + 0.0)


@query("""WITH sf AS (SELECT * FROM (VALUES (0, 0, 2/3::DOUBLE), (0, 1, 0.0), (0, 2, 1/3::DOUBLE), (0, 3, 1/3::DOUBLE)) v(m, bus, factor)),
w AS (SELECT n_nationkey AS point, n_nationkey % 4 AS bus, 1.0::DOUBLE AS weight FROM nation)
SELECT CAST(point AS BIGINT) AS point, round(25.0 - sum(weight * factor * 12.0), 6) AS price FROM w JOIN sf USING (bus) GROUP BY 1""")
def price_identity(spark, sf_dir):
    from ..operators.prices import node_prices

    w = table(spark, sf_dir, "nation").select(F.lit("t").alias("snapshot_id"), F.col("n_nationkey").cast("long").alias("point"), (F.col("n_nationkey") % 4).cast("long").alias("bus_index"), F.lit(1.0).alias("weight"))
    mu = spark.createDataFrame([("t", 0, 1, 12.0, 25.0)], "snapshot_id string, branch_index long, sign int, shadow_price double, system_price double")
    ring = table(spark, sf_dir, "nation").limit(1).select(F.lit("t").alias("snapshot_id"), F.lit(0.1).alias("x_pu"))
    return node_prices(w, dc.shift_factors(triangle(spark, ring)), mu).select("point", money(F.col("price"), 6).alias("price"))


@query("""WITH p AS (SELECT o_orderpriority AS emil_id, CAST(o_orderkey AS VARCHAR) AS blob, o_orderdate AS posted, CASE o_orderstatus WHEN 'F' THEN 'dam' WHEN 'O' THEN 'monthly' ELSE 'annual' END AS kind, CAST(o_orderdate AS DATE) AS d, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(year(o_orderdate) AS VARCHAR) AS term, CAST(quarter(o_orderdate) AS BIGINT) AS seq FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY emil_id, kind, CASE WHEN kind = 'dam' THEN d WHEN kind = 'monthly' THEN m END, CASE WHEN kind = 'annual' THEN term END, CASE WHEN kind = 'annual' THEN seq END ORDER BY posted, blob) AS rev FROM p)
SELECT emil_id, blob AS blob_sha256, CAST(rev AS BIGINT) AS revision, CASE kind WHEN 'dam' THEN 'dam:' || CAST(d AS VARCHAR) || ':he0' || CAST(h AS VARCHAR) || ':r' || CAST(rev AS VARCHAR) WHEN 'monthly' THEN 'crr:monthly:' || strftime(m, '%Y-%m') || ':r' || CAST(rev AS VARCHAR) ELSE 'crr:annual:' || term || ':seq' || CAST(seq AS VARCHAR) || ':' || strftime(m, '%Y-%m') || ':r' || CAST(rev AS VARCHAR) END AS snapshot_id
FROM r, (VALUES (1), (2)) v(h) WHERE kind = 'dam' OR h = 1""")
def snapshot_ids(spark, sf_dir):
    from ..operators.core import snapshots

    status, date = F.col("o_orderstatus"), F.to_date("o_orderdate")
    annual = status == "P"
    packages = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("emil_id"), F.col("o_orderkey").cast("string").alias("doc_id"), F.col("o_orderkey").cast("string").alias("blob_sha256"), F.col("o_orderdate").alias("posted_at"),
        F.when(status == "F", "dam").when(status == "O", "monthly").otherwise("annual").alias("kind"), F.when(status == "F", date).alias("operating_date"),
        F.when(status == "F", F.array(F.lit(2).cast("long"), F.lit(1).cast("long"))).alias("hours"), F.when(status != "F", F.array(F.trunc(date, "month"))).alias("months"),
        F.when(annual, F.year(date).cast("string")).alias("term"), F.when(annual, F.quarter(date).cast("long")).alias("sequence"),
    )
    return snapshots(packages).select("emil_id", "blob_sha256", "revision", "snapshot_id")


@query("""WITH src AS (SELECT c_nationkey AS snap, c_mktsegment AS point, c_custkey AS node, abs(c_acctbal) AS raw FROM customer),
j AS (SELECT snap, point, 'B' || CAST(s_nationkey AS VARCHAR) AS bus, raw, s_suppkey IS NOT NULL AS ok FROM src LEFT JOIN supplier ON node = s_suppkey)
SELECT CAST(snap AS VARCHAR) AS snapshot_id, point AS settlement_point_id, CASE WHEN starts_with(point, 'HB_') THEN 'hub' WHEN starts_with(point, 'LZ_') THEN 'load_zone' WHEN starts_with(point, 'DC') THEN 'dc_tie' ELSE 'resource_node' END AS kind,
 count(DISTINCT bus) FILTER (ok) AS n_buses, count(*) FILTER (NOT ok) AS n_unresolved, round(coalesce(sum(raw) FILTER (ok), 0), 2) AS weight_sum_raw FROM j GROUP BY snap, point""")
def auction_points(spark, sf_dir):
    from ..operators.core import crr_settlement_points

    c = table(spark, sf_dir, "customer")
    nodes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("node_number"), F.concat(F.lit("B"), F.col("s_nationkey").cast("string")).alias("bus_key"))
    nodes = c.select(F.col("c_nationkey").cast("string").alias("snapshot_id"), F.col("c_custkey").alias("node_number")).distinct().join(nodes, "node_number")
    sources = c.select(F.col("c_nationkey").cast("string").alias("snapshot_id"), F.col("c_mktsegment").alias("name"), F.concat(F.col("c_custkey").cast("string"), F.lit(" STN")).alias("bus_name"), F.abs("c_acctbal").alias("participation_factor"))
    points, _ = crr_settlement_points(nodes, sources)
    return points.select("snapshot_id", "settlement_point_id", "kind", "n_buses", "n_unresolved", F.round("weight_sum_raw", 2).alias("weight_sum_raw"))


@query("""WITH a AS (SELECT c_custkey % 1000 AS name, 'L' || CAST(c_nationkey AS VARCHAR) AS br FROM customer), b AS (SELECT s_suppkey AS name, 'L' || CAST(s_nationkey AS VARCHAR) AS br FROM supplier),
ca AS (SELECT name, list_sort(list_distinct(list(br))) AS sa FROM a GROUP BY name), cb AS (SELECT name, list_sort(list_distinct(list(br))) AS sb FROM b GROUP BY name),
n AS (SELECT name AS x, name AS y, sa, sb FROM ca JOIN cb USING (name)), ra AS (SELECT * FROM ca WHERE name NOT IN (SELECT x FROM n)), rb AS (SELECT * FROM cb WHERE name NOT IN (SELECT y FROM n)),
ub AS (SELECT sb, min(name) AS y FROM rb GROUP BY sb HAVING count(*) = 1), m0 AS (SELECT ra.name AS x, y, sa, sb FROM ra JOIN ub ON sa = sb), m AS (SELECT * FROM m0 WHERE y IN (SELECT y FROM m0 GROUP BY y HAVING count(*) = 1)),
done AS (SELECT *, 'name' AS method FROM n UNION ALL SELECT *, 'members' FROM m)
SELECT CAST(x AS VARCHAR) AS crr_contingency_id, CAST(y AS VARCHAR) AS dam_contingency_id, method AS match_method, CAST(len(list_intersect(sa, sb)) AS BIGINT) AS n_shared_branches FROM done
UNION ALL SELECT CAST(name AS VARCHAR), NULL, 'unmatched', 0 FROM ca WHERE name NOT IN (SELECT x FROM done) UNION ALL SELECT NULL, CAST(name AS VARCHAR), 'unmatched', 0 FROM cb WHERE name NOT IN (SELECT y FROM done)""")
def contingency_match(spark, sf_dir):
    from ..operators.match import match_contingencies

    pair = F.lit("p").alias("pair_id")
    c = table(spark, sf_dir, "customer").select(pair, (F.col("c_custkey") % 1000).cast("string").alias("contingency_id"), F.concat(F.lit("L"), F.col("c_nationkey").cast("string")).alias("branch_id"))
    s = table(spark, sf_dir, "supplier").select(pair, F.col("s_suppkey").cast("string").alias("contingency_id"), F.concat(F.lit("L"), F.col("s_nationkey").cast("string")).alias("branch_id"), F.lit("branch").alias("element_kind"), F.lit("outage").alias("operation"))
    same = c.select("pair_id", F.col("branch_id").alias("crr_branch_id"), F.col("branch_id").alias("dam_branch_id"), F.lit("exact").alias("match_method")).distinct()
    return match_contingencies(c, s, same).select("crr_contingency_id", "dam_contingency_id", "match_method", "n_shared_branches")


@query("""WITH f AS (SELECT p_brand, regexp_replace(regexp_replace(p_name, '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g') AS pattern, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY ALL)
SELECT p_brand, pattern, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, pattern) AS rank FROM f) WHERE rank <= 3""")
def masked_patterns(spark, sf_dir):
    from ..operators.checks import patterns

    return patterns(table(spark, sf_dir, "part"), ["p_brand"], "p_name")


@query("""WITH m AS (SELECT upper(c_mktsegment) || CAST(c_custkey // 20 AS VARCHAR) AS substation, c_nationkey AS zone, sum(abs(c_acctbal)) AS mw FROM customer GROUP BY ALL),
w AS (SELECT substation, sum(mw) AS model_mw, max_by(zone, {'mw': mw, 'zone': zone}) AS zone FROM m GROUP BY substation),
p AS (SELECT upper(c_mktsegment) || CAST(c_custkey // 20 AS VARCHAR) AS substation, sum(o_totalprice) AS published FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT substation, zone, round(model_mw / sum(model_mw) OVER (PARTITION BY zone), 6) AS model_share, round(published / sum(published) OVER (PARTITION BY zone), 6) AS published_share FROM w JOIN p USING (substation)""")
def load_shares(spark, sf_dir):
    from ..operators.checks import load_shares as shares

    c = table(spark, sf_dir, "customer").withColumn("substation", F.concat("c_mktsegment", F.expr("c_custkey div 20").cast("string")))
    o = table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("substation", F.col("o_totalprice").alias("factor"))
    df = shares(c.select("substation", F.col("c_nationkey").alias("zone"), F.abs("c_acctbal").alias("mw")), o)
    return df.select("substation", "zone", money(F.col("model_share"), 6).alias("model_share"), money(F.col("published_share"), 6).alias("published_share"))


@query("SELECT CAST(o_orderdate AS DATE) AS day FROM orders INTERSECT SELECT CAST(l_shipdate AS DATE) FROM lineitem")
def common_days(spark, sf_dir):
    from ..operators.checks import common_days as common

    return common(*[table(spark, sf_dir, t).select(F.to_date(c).alias("day")) for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))])
