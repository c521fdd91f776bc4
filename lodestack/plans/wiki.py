"""Queries on graphs: degrees, two steps, reachability, co-mentions, upserts, staleness."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import query
from ..operators import graph, wiki
from ..sources.sinks import upsert
from ..session import table


def _customer_supplier(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("src"), F.col("l_suppkey").alias("dst"))


@query("AGG-17", "SELECT o_custkey AS src, count(DISTINCT l_suppkey) AS degree FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def degree_hub(spark, sf):
    return graph.degrees(_customer_supplier(spark, sf), "src", "dst")


#: Who refers to whom: each customer to the first supplier of its nation, each supplier to the next of its nation, the last to the first.
_REFERRALS = """e AS (SELECT 'c' || c_custkey AS src, 's' || f.s AS dst FROM customer JOIN (SELECT s_nationkey, min(s_suppkey) AS s FROM supplier GROUP BY 1) f ON s_nationkey = c_nationkey
 UNION ALL SELECT 's' || s_suppkey, 's' || coalesce(lead(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey), min(s_suppkey) OVER (PARTITION BY s_nationkey)) FROM supplier)"""


def _referrals(spark, sf):
    """All customers and suppliers; a graph that is sparse at any size, as each node has one edge at most."""
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    first = s.groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.min("s_suppkey").alias("s"))
    name = lambda kind, key: F.concat(F.lit(kind), key.cast("string"))
    mine = Window.partitionBy("s_nationkey")
    after = F.coalesce(F.lead("s_suppkey").over(mine.orderBy("s_suppkey")), F.min("s_suppkey").over(mine))
    to_supplier = c.join(first, "c_nationkey").select(name("c", F.col("c_custkey")).alias("src"), name("s", F.col("s")).alias("dst"))
    return to_supplier.unionByName(s.select(name("s", F.col("s_suppkey")).alias("src"), name("s", after).alias("dst")))


@query("JOIN-19", f"WITH {_REFERRALS} SELECT DISTINCT a.src, b.dst FROM e a JOIN e b ON b.src = a.dst WHERE a.src <> b.dst AND NOT EXISTS (SELECT 1 FROM e x WHERE x.src = a.src AND x.dst = b.dst)")
def second_degree(spark, sf):
    return graph.second_degree(_referrals(spark, sf))


@query("AGG-18 UDF-3", f"WITH RECURSIVE {_REFERRALS}, n AS (SELECT 'c' || c_custkey AS node FROM customer UNION ALL SELECT 's' || s_suppkey FROM supplier), r AS (SELECT src, dst, 1 AS d FROM e UNION SELECT r.src, e.dst, r.d + 1 FROM r JOIN e ON e.src = r.dst WHERE r.d < 4) SELECT node, count(DISTINCT r.dst) FILTER (r.dst <> node) AS downstream FROM n LEFT JOIN r ON r.src = node GROUP BY 1")
def downstream_effects(spark, sf):
    nodes = table(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node")).unionByName(table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("node")))
    return graph.downstream(nodes, _referrals(spark, sf), 4)


@query("UDF-3", f"WITH RECURSIVE {_REFERRALS}, r AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM r JOIN e ON e.src = r.dst) SELECT src AS node FROM r WHERE src = dst")
def feedback_loops(spark, sf):
    return graph.on_cycle(_referrals(spark, sf))


@query("JOIN-12 SET-2", "WITH m AS (SELECT DISTINCT o_orderkey AS grp, l_suppkey AS node FROM orders JOIN lineitem ON l_orderkey = o_orderkey), p AS (SELECT DISTINCT a.node AS src, b.node AS dst FROM m a JOIN m b ON a.grp = b.grp AND a.node < b.node), e AS (SELECT DISTINCT least(s_suppkey, (s_suppkey + 1) % 50) AS src, greatest(s_suppkey, (s_suppkey + 1) % 50) AS dst FROM supplier) SELECT src, dst FROM p EXCEPT SELECT src, dst FROM e")
def missing_links(spark, sf):
    """Suppliers met in one order without a link; an order stands for a page."""
    m = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("grp"), F.col("l_suppkey").alias("node")).distinct()
    e = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("src"), ((F.col("s_suppkey") + 1) % 50).alias("dst"))
    return wiki.missing_links(m, e, "grp", "node")


@query("JOIN-13", "SELECT c_custkey AS page_id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def unpromoted_sources(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("page_id"), F.when(F.col("c_mktsegment") == "BUILDING", "sources").otherwise("topics").alias("type"))
    e = table(spark, sf, "orders").select(F.col("o_custkey").alias("src"), F.when(F.col("o_orderstatus") == "F", "promote").otherwise("link").alias("kind"))
    return wiki.unpromoted(c, e).select("page_id")


@query("JOIN-14", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def undocumented_parts(spark, sf):
    done = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return wiki.undocumented(table(spark, sf, "part"), done, "p_partkey").select("p_partkey")


@query("FN-D2", "WITH l AS (SELECT l_orderkey, max(l_shipdate) AS newest FROM lineitem GROUP BY 1) SELECT o_orderkey AS page_id, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(newest AS DATE)) AS INT) AS days FROM orders JOIN l ON l_orderkey = o_orderkey WHERE date_diff('day', CAST(o_orderdate AS DATE), CAST(newest AS DATE)) > 0")
def stale_claims(spark, sf):
    pages = table(spark, sf, "orders").select(F.col("o_orderkey").alias("page_id"), F.to_date("o_orderdate").alias("updated"))
    evidence = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page_id"), F.to_date("l_shipdate").alias("updated"))
    return wiki.stale(pages, evidence)


@query("SNK-8", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer UNION ALL SELECT -1, 5.0")
def upserted_balances(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    new = c.where("c_acctbal < 0").select("c_custkey", F.lit(0.0).alias("c_acctbal")).unionByName(spark.createDataFrame([(-1, 5.0)], "c_custkey long, c_acctbal double"))
    return upsert(c, new, "c_custkey")


@query("JOIN-17", "SELECT e.event_id, p.r_name AS pattern FROM events e LEFT JOIN region p ON p.r_regionkey = e.user_id % 5 AND contains(e.props, '\"k\": 1') WHERE e.event_type = 'error'")
def known_patterns(spark, sf):
    from ..operators.evolve import known_patterns as known

    f = table(spark, sf, "events").where("event_type = 'error'").select("event_id", (F.col("user_id") % 5).cast("string").alias("category"), F.col("props").alias("condition"))
    p = table(spark, sf, "region").select(F.col("r_name").alias("id"), F.col("r_regionkey").cast("string").alias("category"), F.lit('"k": 1').alias("when_to_apply"))
    return known(f, p).select("event_id", "pattern")


@query("D15 AGG-9", "SELECT o_orderpriority AS dimension, CAST(max(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice / 100000) END) AS BIGINT) AS f, CAST(max(CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice / 100000) END) AS BIGINT) AS o, CAST(max(CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice / 100000) END) - max(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice / 100000) END) AS BIGINT) AS gap FROM orders GROUP BY 1")
def capability_matrix(spark, sf):
    from ..operators.evolve import capability_matrix as matrix

    s = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("dimension"), F.lower("o_orderstatus").alias("agent"), F.floor(F.col("o_totalprice") / 100000).alias("score"))
    return matrix(s, ["f", "o"])
