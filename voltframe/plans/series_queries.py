"""Queries of what comes before: as-of joins, revisions compared, exact quantiles of one huge group, observed measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats
from ..operators import asof, build, measures
from ..workers import shared
from .queries import query, table


@query("""WITH p AS (SELECT user_id, ts, max(event_id) AS posting FROM events WHERE event_type IN ('signup', 'view') GROUP BY 1, 2),
e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT e.event_id, e.user_id, p.posting FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def newest_posting(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    posted = e.where("event_type in ('signup', 'view')").select("user_id", F.col("ts").alias("posted_at"), F.col("event_id").alias("posting"))
    asked = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return asof.newest_before(asked, posted, ["user_id"], "ts", "posted_at", ["posting"], tie="posting").select("event_id", "user_id", "posting")


@query("""WITH d AS (SELECT DISTINCT o_orderpriority AS m, year(o_orderdate) AS y, o_custkey AS e, o_orderstatus AS a FROM orders),
s AS (SELECT m, y, e, string_agg(a, '' ORDER BY a) AS a FROM d GROUP BY ALL),
i AS (SELECT m, y, lag(y) OVER (PARTITION BY m ORDER BY y) AS was FROM (SELECT DISTINCT m, y FROM d)),
j AS (SELECT i.m, i.y, x.e AS xe, z.e AS ze, x.a AS xa, z.a AS za FROM i JOIN s x ON x.m = i.m AND x.y = i.y LEFT JOIN s z ON z.m = i.m AND z.y = i.was AND z.e = x.e WHERE was IS NOT NULL),
g AS (SELECT i.m, i.y, count(*) FILTER (x.e IS NULL) AS gone FROM i JOIN s z ON z.m = i.m AND z.y = i.was LEFT JOIN s x ON x.m = i.m AND x.y = i.y AND x.e = z.e GROUP BY ALL)
SELECT j.m AS model, CAST(j.y AS INTEGER) AS revision, count(*) FILTER (za = xa) AS kept, count(*) FILTER (za <> xa) AS changed, count(*) FILTER (ze IS NULL) AS new, any_value(gone) AS gone FROM j JOIN g ON g.m = j.m AND g.y = j.y GROUP BY j.m, j.y""")
def revision_stability(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderpriority").alias("model"), F.year("o_orderdate").alias("revision"), F.col("o_custkey").alias("entity"), F.col("o_orderstatus").alias("attribute"))
    return build.revisions(rows, "model", "revision", "entity", "attribute")


@query("""SELECT count(l_extendedprice) AS n, round(quantile_cont(abs(l_extendedprice), 0.5), 4) AS abs_p50, round(quantile_cont(abs(l_extendedprice), 0.9), 4) AS abs_p90, round(quantile_cont(abs(l_extendedprice), 0.99), 4) AS abs_p99,
round(max(abs(l_extendedprice)), 4) AS abs_max, round(median(l_extendedprice), 4) AS median, count(*) FILTER (abs(l_extendedprice) <= 10000) AS within_0 FROM lineitem""")
def quantiles_of_one_group(spark, sf_dir):
    """All items are one group; no task sorts more than a thousand values."""
    return stats.quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", None, (10000,), 4, few=1000)


@query("""SELECT measure, value FROM (SELECT CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS returned, CAST(count(*) FILTER (l_quantity > 25 AND l_linestatus = 'O') AS DOUBLE) AS large_open, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem) UNPIVOT (value FOR measure IN (returned, large_open, quantity))""")
def observed_measures(spark, sf_dir):
    """Counted while the items are written; the written rows aren't read."""
    seen = measures.Observed(table(spark, sf_dir, "lineitem"), {"returned": "l_returnflag = 'R'", "large_open": "l_quantity > 25 and l_linestatus = 'O'", "quantity": "= sum(l_quantity)"})
    shared(seen.frame)
    return spark.createDataFrame(seen.rows(), "measure string, value double")
