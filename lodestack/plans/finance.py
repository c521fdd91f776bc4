"""Queries over orders, customers, suppliers and events: series, ratios, screens."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions import finance as fn
from ..operators import metrics
from ..session import table

_QUARTERS = "q AS (SELECT year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS period, sum(o_totalprice) AS value FROM orders GROUP BY 1)"
_MONTHS = "m AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS period, month(o_orderdate) AS season, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2)"


def _quarters(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy((F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 1).cast("long").alias("period")).agg(F.sum("o_totalprice").alias("value"))


def _months(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy((F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("long").alias("period"), F.month("o_orderdate").cast("long").alias("season")).agg(F.sum("o_totalprice").alias("value"))


@query("WIN-3", f"WITH {_QUARTERS} SELECT period, round(CASE WHEN count(*) OVER w = 4 THEN sum(value) OVER w END, 2) AS ttm FROM q WINDOW w AS (ORDER BY period ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
def ttm_revenue(spark, sf):
    return metrics.trailing_sum(_quarters(spark, sf), "value", [], "period").select("period", F.round("ttm", 2).alias("ttm"))


@query("WIN-1", f"WITH {_QUARTERS} SELECT period, round(value / lag(value) OVER (ORDER BY period) - 1, 6) AS qoq FROM q")
def qoq(spark, sf):
    return metrics.change(_quarters(spark, sf), "value", [], "period", 1, "qoq").select("period", F.round("qoq", 6).alias("qoq"))


@query("WIN-2", f"WITH {_QUARTERS} SELECT period, round(value / lag(value, 4) OVER (ORDER BY period) - 1, 6) AS yoy FROM q")
def yoy(spark, sf):
    return metrics.change(_quarters(spark, sf), "value", [], "period", 4, "yoy").select("period", F.round("yoy", 6).alias("yoy"))


@query("WIN-4", f"WITH {_QUARTERS}, t AS (SELECT period, CASE WHEN count(*) OVER w = 4 THEN sum(value) OVER w END AS ttm FROM q WINDOW w AS (ORDER BY period ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)) SELECT period, round(ttm / lag(ttm, 4) OVER (ORDER BY period) - 1, 6) AS ttm_yoy FROM t")
def ttm_yoy(spark, sf):
    t = metrics.trailing_sum(_quarters(spark, sf), "value", [], "period")
    return metrics.change(t, "ttm", [], "period", 4, "ttm_yoy").select("period", F.round("ttm_yoy", 6).alias("ttm_yoy"))


@query("WIN-1 WIN-2 WIN-3", "WITH q AS (SELECT c_mktsegment AS entity, year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS period, sum(o_totalprice) AS value FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2) SELECT entity, period, round(value, 2) AS value, round(value / lag(value) OVER w - 1, 6) AS qoq, round(value / lag(value, 4) OVER w - 1, 6) AS yoy FROM q WINDOW w AS (PARTITION BY entity ORDER BY period)")
def segment_series(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    q = o.groupBy(F.col("c_mktsegment").alias("entity"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 1).cast("long").alias("period")).agg(F.sum("o_totalprice").alias("value"))
    q = metrics.change(metrics.change(q, "value", ["entity"], "period", 1, "qoq"), "value", ["entity"], "period", 4, "yoy")
    return q.select("entity", "period", F.round("value", 2).alias("value"), F.round("qoq", 6).alias("qoq"), F.round("yoy", 6).alias("yoy"))


@query("WIN-5", "WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS value FROM orders GROUP BY 1) SELECT strftime(day, '%Y-%m-%d') AS day, round(avg(value) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS average FROM d")
def moving_average(spark, sf):
    d = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("value"))
    return metrics.moving_average(d, "value", [], "day", 7).select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("average", 2).alias("average"))


@query("WIN-6", f"WITH {_MONTHS} SELECT period, round(percent_rank() OVER (ORDER BY value), 6) AS position FROM m")
def percentile_position(spark, sf):
    return metrics.percentile_position(_months(spark, sf), "value", []).select("period", F.round("position", 6).alias("position"))


@query("WIN-7", f"WITH {_MONTHS} SELECT period, round(value - avg(value) OVER (PARTITION BY season), 1) AS deviation FROM m")
def seasonal_deviation(spark, sf):
    return metrics.seasonal_deviation(_months(spark, sf), "value", ["season"]).select("period", F.round("deviation", 1).alias("deviation"))


@query("WIN-11 CLS-21", f"WITH {_MONTHS}, c AS (SELECT period, value - lag(value) OVER (ORDER BY period) AS mom, value - lag(value, 12) OVER (ORDER BY period) AS yoy FROM m) SELECT period, round(mom, 2) AS mom, round(yoy, 2) AS yoy, CASE WHEN mom IS NULL OR yoy IS NULL OR mom = 0 THEN NULL WHEN mom > 0 AND yoy > 0 THEN 'active build-up' WHEN mom > 0 THEN 'passive build-up' WHEN yoy < 0 THEN 'active draw-down' ELSE 'passive draw-down' END AS regime FROM c")
def stock_regimes(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy(F.lit(0)).orderBy("period")  # one row a month
    m = _months(spark, sf).select("period", (F.col("value") - F.lag("value").over(w)).alias("mom"), (F.col("value") - F.lag("value", 12).over(w)).alias("yoy"))
    return m.select("period", F.round("mom", 2).alias("mom"), F.round("yoy", 2).alias("yoy"), fn.stock_regime(F.col("mom"), F.col("yoy")).alias("regime"))


@query("WIN-8 FN-M8 CLS-22", "WITH d AS (SELECT CAST(ts AS DATE) AS day, sum(CASE event_type WHEN 'signup' THEN value WHEN 'purchase' THEN -value ELSE 0 END) AS net FROM events GROUP BY 1), p AS (SELECT day, net, 100 + sum(net) OVER (ORDER BY day) AS stock FROM d) SELECT strftime(day, '%Y-%m-%d') AS day, round(stock, 2) AS stock, CASE WHEN stock < 1000 THEN 'tight balance' WHEN stock > 6000 THEN 'surplus' WHEN net > 0 THEN 'building' ELSE 'drawing' END AS state FROM p")
def stock_path(spark, sf):
    net = F.when(F.col("event_type") == "signup", F.col("value")).when(F.col("event_type") == "purchase", -F.col("value")).otherwise(0.0)
    d = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.sum(net).alias("net"))
    p = metrics.running_path(d, "net", [], "day", 100.0)
    return p.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("stock", 2).alias("stock"), fn.market_state(F.col("net"), F.col("stock"), 1000, 6000).alias("state"))


@query("AGG-16", "WITH o AS (SELECT date_trunc('month', o_orderdate) AS m, sum(o_totalprice) AS y FROM orders GROUP BY 1), l AS (SELECT date_trunc('month', o_orderdate) AS m, sum(l_extendedprice) AS x FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) SELECT round(regr_slope(y, x), 6) AS slope, round(corr(y, x), 6) AS correlation, round(regr_r2(y, x), 6) AS r2, CAST(regr_count(y, x) AS BIGINT) AS n FROM o JOIN l USING (m)")
def price_beta(spark, sf):
    o = table(spark, sf, "orders")
    y = o.groupBy(F.date_trunc("month", "o_orderdate").alias("m")).agg(F.sum("o_totalprice").alias("y"))
    # Lines are summed by order first, so the join moves one row an order.
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("x"))
    x = lines.join(o.select("o_orderkey", "o_orderdate"), "o_orderkey").groupBy(F.date_trunc("month", "o_orderdate").alias("m")).agg(F.sum("x").alias("x"))
    b = metrics.beta(y.join(x, "m"), "y", "x")
    return b.select(F.round("slope", 6).alias("slope"), F.round("correlation", 6).alias("correlation"), F.round("r2", 6).alias("r2"), F.col("n").cast("long").alias("n"))


@query("AGG-8", "SELECT c_mktsegment AS segment, count(*) AS n, round(avg(c_acctbal), 4) AS mean, round(stddev_samp(c_acctbal), 4) AS sd FROM customer GROUP BY 1")
def segment_compare(spark, sf):
    from ..operators.evolve import variance

    v = variance(table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "segment"), "segment", "c_acctbal")
    return v.select("segment", "n", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"))


@query("WIN-10", "WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'view') AS x, count(*) FILTER (event_type = 'purchase') AS y FROM events GROUP BY 1), g AS (SELECT x, lag(y, 1) OVER (ORDER BY day) AS y1, lag(y, 2) OVER (ORDER BY day) AS y2, lag(y, 3) OVER (ORDER BY day) AS y3 FROM d) SELECT 1 AS lag, round(corr(x, y1), 6) AS correlation FROM g UNION ALL SELECT 2, round(corr(x, y2), 6) FROM g UNION ALL SELECT 3, round(corr(x, y3), 6) FROM g")
def lag_effect(spark, sf):
    d = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count_if(F.col("event_type") == "view").alias("x"), F.count_if(F.col("event_type") == "purchase").alias("y"))
    return metrics.lag_correlations(d, "x", "y", [], "day", [1, 2, 3]).select("lag", F.round("correlation", 6).alias("correlation"))


@query("CLS-17", f"WITH {_MONTHS}, a AS (SELECT period * 1.0 AS x, value AS y, max(value) OVER () AS top, avg(period) OVER () AS mean FROM m), s AS (SELECT 'linear' AS shape, regr_r2(y, x) AS r2 FROM a UNION ALL SELECT 'exponential', regr_r2(ln(y), x) FROM a UNION ALL SELECT 'log', regr_r2(y, ln(x)) FROM a UNION ALL SELECT 'power', regr_r2(ln(y), ln(x)) FROM a UNION ALL SELECT 'inverted_u', regr_r2(y, pow(x - mean, 2)) FROM a UNION ALL SELECT 'logistic', regr_r2(ln(y / (1.001 * top - y)), x) FROM a UNION ALL SELECT 'periodic', regr_r2(y, sin(2 * 3.141592653589793 * x / 12)) FROM a) SELECT shape, round(r2, 5) AS r2 FROM s")
def function_shape(spark, sf):
    return metrics.function_shape(_months(spark, sf), "period", "value").select("shape", F.round("r2", 5).alias("r2"))


@query("AGG-19", "WITH p AS (SELECT c_mktsegment AS market, c_custkey, sum(o_totalprice) AS v FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2) SELECT market, round(sum(v * v) / (sum(v) * sum(v)), 8) AS hhi FROM p GROUP BY 1")
def concentration(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("v")).join(table(spark, sf, "customer"), "c_custkey")
    return metrics.concentration(o.withColumnRenamed("c_mktsegment", "market"), ["market"], "c_custkey", "v").select("market", F.round("hhi", 8).alias("hhi"))


@query("CLS-13 JOIN-20 FIL-22", "WITH g AS (SELECT s_suppkey, s_acctbal, (s_acctbal > 0)::INT + (s_nationkey < 15)::INT + (s_suppkey % 2 = 0)::INT AS grade FROM supplier) SELECT s_suppkey, grade, rank() OVER (PARTITION BY grade ORDER BY s_acctbal DESC) AS place FROM g WHERE grade > 0")
def model_grade(spark, sf):
    s = table(spark, sf, "supplier")
    g = s.withColumn("grade", fn.model_grade(F.col("s_acctbal") > 0, F.col("s_nationkey") < 15, F.col("s_suppkey") % 2 == 0))
    return metrics.comparable(g, "grade", "s_acctbal").select("s_suppkey", "grade", F.col("place").cast("long").alias("place"))


@query("FIL-23 SORT-7", "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal >= 3000 AND NOT s_nationkey % 5 = 0")
def screen_rank(spark, sf):
    s = table(spark, sf, "supplier").withColumn("shrinking", F.col("s_nationkey") % 5 == 0)
    return metrics.bank_screen(s, "s_acctbal", "shrinking", "s_suppkey", 3000).select("s_suppkey", "s_name", "s_acctbal")


@query("FN-M2", "SELECT o_custkey, round(sum(o_totalprice / pow(1.1, year(o_orderdate) - 1992)), 2) AS present_value FROM orders GROUP BY 1")
def present_value(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum(fn.discounted(F.col("o_totalprice"), F.lit(0.1), F.year("o_orderdate") - 1992)), 2).alias("present_value"))


@query("FIL-24 CLS-15", "SELECT p_partkey, round(CASE WHEN p_size - 10 > 0 THEN p_retailprice / (p_size - 10) END, 6) AS pe, CASE WHEN p_size % 2 = 0 THEN 'PE' ELSE 'PB' END AS method FROM part")
def valuation(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.round(fn.pe(F.col("p_retailprice"), F.col("p_size") - 10), 6).alias("pe"), fn.valuation_method(F.col("p_size") % 2 == 0).alias("method"))


@query("FN-M3", "SELECT s_suppkey, round(CASE WHEN 0.1 > g THEN s_acctbal * (1 + g) / (0.1 - g) END, 4) AS value FROM (SELECT s_suppkey, s_acctbal, (s_nationkey % 13) / 100.0 AS g FROM supplier)")
def perpetuity_value(spark, sf):
    g = (F.col("s_nationkey") % 13) / 100.0
    return table(spark, sf, "supplier").select("s_suppkey", F.round(fn.perpetuity(F.col("s_acctbal"), F.lit(0.1), g), 4).alias("value"))


@query("FN-M4 FN-M6", "WITH n AS (SELECT c_nationkey AS nation, count(*) AS people, avg((c_acctbal > 0)::INT) AS penetration, sum(c_acctbal) AS balance FROM customer GROUP BY 1) SELECT nation, round(people * penetration * 2 * 3 * 0.25 - 1, 6) AS profit, round(balance / sum(balance) OVER (), 6) AS share FROM n")
def nation_profit(spark, sf):
    n = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("people"), F.avg((F.col("c_acctbal") > 0).cast("int")).alias("penetration"), F.sum("c_acctbal").alias("balance"))
    from pyspark.sql import Window

    whole = F.sum("balance").over(Window.partitionBy(F.lit(0)))  # one row a nation
    p = fn.profit(fn.revenue(F.col("people"), F.col("penetration"), F.lit(2.0), F.lit(3.0)), F.lit(0.25), F.lit(1.0))
    return n.select("nation", F.round(p, 6).alias("profit"), F.round(fn.share(F.col("balance"), whole), 6).alias("share"))


@query("FN-M5", "SELECT c_custkey, round(CASE WHEN -c_acctbal > 0 THEN 1400 / -c_acctbal END, 6) AS runway, round(c_acctbal - 1000, 2) AS spread FROM customer")
def cash_runway(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.round(fn.runway(F.lit(1400.0), -F.col("c_acctbal")), 6).alias("runway"), F.round(fn.spread(F.col("c_acctbal"), F.lit(1000.0)), 2).alias("spread"))


@query("FIL-25 CLS-14", "WITH n AS (SELECT c_nationkey AS nation, avg((c_acctbal > 0)::INT) AS p FROM customer GROUP BY 1) SELECT nation, CASE WHEN p >= 0.8 THEN 'saturated' WHEN p > 0.5 THEN 'caution' ELSE 'ok' END AS alert, CASE WHEN p > 0.9 AND nation % 2 = 0 THEN 1 WHEN p > 0.9 THEN 2 WHEN nation % 2 = 0 THEN 3 ELSE 4 END AS quadrant FROM n")
def penetration(spark, sf):
    n = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.avg((F.col("c_acctbal") > 0).cast("int")).alias("p"))
    return n.select("nation", fn.penetration_alert(F.col("p")).alias("alert"), fn.penetration_quadrant(F.col("p") > 0.9, F.col("nation") % 2 == 0).alias("quadrant"))


@query("FN-M14", "SELECT o_orderstatus AS regime, round(corr(o_totalprice, year(o_orderdate)), 6) AS year, round(corr(o_totalprice, month(o_orderdate)), 6) AS month FROM orders GROUP BY 1")
def indicator_validity(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("regime"), "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return metrics.indicator_validity(o, "regime", "o_totalprice", ["year", "month"]).select("regime", F.round("year", 6).alias("year"), F.round("month", 6).alias("month"))


@query("FN-M1 FIL-24", "SELECT p_partkey, round(CASE WHEN p_size > 10 THEN p_retailprice / (p_size - 10) END, 6) AS pe, round(CASE WHEN p_size > 20 THEN p_retailprice / (p_size - 20) END, 6) AS pb, round(CASE WHEN p_size > 0 THEN p_retailprice / p_size END, 6) AS ps FROM part")
def valuation_ratios(spark, sf):
    price, size = F.col("p_retailprice"), F.col("p_size")
    return table(spark, sf, "part").select("p_partkey", F.round(fn.pe(price, size - 10), 6).alias("pe"), F.round(fn.pb(price, size - 20), 6).alias("pb"), F.round(fn.ps(price, size), 6).alias("ps"))


@query("FN-M3", """SELECT s_suppkey, round(CASE WHEN w > 0 THEN c / w END, 4) AS zero_growth, round(CASE WHEN w > 0.02 AND w > 0 THEN c * 1.02 / (w - 0.02) END, 4) AS constant_growth,
 round(CASE WHEN w > 0.02 THEN c * 1.1 / (1 + w) + c * pow(1.1, 2) / pow(1 + w, 2) + c * pow(1.1, 3) / pow(1 + w, 3) + c * pow(1.1, 3) * 1.02 / (w - 0.02) / pow(1 + w, 3) END, 4) AS two_stage FROM (SELECT s_suppkey, s_acctbal AS c, (s_nationkey % 13) / 100.0 AS w FROM supplier)""")
def cash_flow_value(spark, sf):
    """Free cash flow at zero, constant and two-stage growth."""
    c, w = F.col("s_acctbal"), (F.col("s_nationkey") % 13) / 100.0
    return table(spark, sf, "supplier").select("s_suppkey", F.round(fn.perpetuity(c, w), 4).alias("zero_growth"), F.round(fn.perpetuity(c, w, F.lit(0.02)), 4).alias("constant_growth"), F.round(fn.two_stage(c, w, F.lit(0.1), 3, F.lit(0.02)), 4).alias("two_stage"))


@query("FN-M11 FN-M2", "SELECT o_orderkey, round(o_totalprice / pow(1.1, year(o_orderdate) - 1992), 2) AS present_value, round(CAST(0.2 * 3 - 0.05 * 2 AS DOUBLE), 6) AS leveraged, round(o_totalprice * (1 - 0.4) - 50000, 2) AS worst_case FROM orders")
def long_bets(spark, sf):
    """Present value, leveraged return and worst case of each order."""
    v = F.col("o_totalprice")
    return table(spark, sf, "orders").select("o_orderkey", F.round(fn.discounted(v, F.lit(0.1), F.year("o_orderdate") - 1992), 2).alias("present_value"), F.round(fn.leveraged(F.lit(0.2), F.lit(0.05), F.lit(3)), 6).alias("leveraged"), F.round(fn.worst_case(v, F.lit(0.4), F.lit(50000)), 2).alias("worst_case"))


@query("FN-M7 FN-M9 FN-M13", """WITH l AS (SELECT l_partkey, sum(l_quantity) AS sold, sum(l_extendedprice) AS sales, count(*) FILTER (l_returnflag = 'R') AS bad, count(*) AS n FROM lineitem GROUP BY 1)
SELECT p_partkey, round(sales / sum(sales) OVER (), 9) AS chain_share, round(CASE WHEN p_size > 0 THEN p_retailprice / p_size END, 6) AS value_per_area, round(CASE WHEN sold > 0 THEN p_size / sold END, 6) AS stock_to_sales, round(bad / n, 6) AS defects, round(CASE WHEN sales - 1000 > 0 THEN p_retailprice / (sales - 1000) END, 6) AS payback,
 round(p_retailprice - sales / sold, 2) AS basis, round(p_retailprice + 5 - 0.8 * p_retailprice, 3) AS production_profit FROM part JOIN l ON l_partkey = p_partkey""")
def chain_ratios(spark, sf):
    """Shares, value per area, stock to sales, defects, payback, basis and production profit of each part that was sold."""
    l = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("sold"), F.sum("l_extendedprice").alias("sales"), F.count_if(F.col("l_returnflag") == "R").alias("bad"), F.count("*").alias("n"))  # noqa: E741
    total = l.agg(F.sum("sales").alias("total"))
    p = table(spark, sf, "part").join(l, F.col("l_partkey") == F.col("p_partkey")).crossJoin(F.broadcast(total))  # one row
    price, size, sales, sold = F.col("p_retailprice"), F.col("p_size"), F.col("sales"), F.col("sold")
    r = lambda c, n, k=6: F.round(c, k).alias(n)
    return p.select("p_partkey", r(fn.share(sales, F.col("total")), "chain_share", 9), r(fn.value_per_area(price, size), "value_per_area"), r(fn.stock_to_sales(size, sold), "stock_to_sales"), r(fn.share(F.col("bad"), F.col("n")), "defects"), r(fn.payback(price, sales - 1000), "payback"), r(fn.basis(price, sales / sold), "basis", 2), r(fn.production_profit(price, 0.8 * price, F.lit(5)), "production_profit", 3))


@query("AGG-15", "WITH m AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS x, sum(o_totalprice) AS y FROM orders GROUP BY 1), s AS (SELECT sign(x - lag(x) OVER (ORDER BY m)) AS s, sign(lead(y) OVER (ORDER BY m) - y) AS o FROM m) SELECT count(*) AS n, count(*) FILTER (s = o) AS hits, round(count(*) FILTER (s = o) / nullif(count(*), 0), 6) AS rate FROM s WHERE s IS NOT NULL AND o IS NOT NULL AND s <> 0")
def signal_backtest(spark, sf):
    """Whether a month with more orders than the one before foretold a higher total in the next."""
    m = table(spark, sf, "orders").groupBy(F.date_trunc("month", "o_orderdate").alias("m")).agg(F.count("*").alias("x"), F.sum("o_totalprice").alias("y"))
    return metrics.backtest(m, "x", "y", [], "m").withColumn("rate", F.round("rate", 6))
