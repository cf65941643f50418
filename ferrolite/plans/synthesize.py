"""Queries: feature synthesis over customer -> orders -> lineitem and events per user."""

from pyspark.sql import functions as F

from ..functions.cols import r
from ..operators import synthesize as M
from .registry import query


def es(t):
    return M.EntitySet(
        {"nation": M.Entity(t.nation, "n_nationkey"), "customer": M.Entity(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), "c_custkey"),
         "orders": M.Entity(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), "o_orderkey", "o_orderdate", ("o_orderkey",)),
         "lineitem": M.Entity(t.lineitem.select("l_orderkey", "l_quantity", "l_tax", "l_shipdate"), None, "l_shipdate", ("l_quantity", "l_tax", "l_shipdate"))},
        [("nation", "customer", "c_nationkey"), ("customer", "orders", "o_custkey"), ("orders", "lineitem", "l_orderkey")])


@query("entityset", "M1", sql="""SELECT 'customer' AS parent, 'orders' AS child, (SELECT count(*) FROM orders) AS child_rows,
    (SELECT count(*) FROM orders ANTI JOIN customer ON c_custkey = o_custkey) AS orphans, 0::BIGINT AS repeated_keys
  UNION ALL SELECT 'nation', 'customer', (SELECT count(*) FROM customer), 0, 0 UNION ALL SELECT 'orders', 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem ANTI JOIN orders ON o_orderkey = l_orderkey), 0""")
def _(t):
    return M.validate(es(t))


def _rounded(df, keep):
    return df.select(*[r(F.col(f"`{c}`"), 4).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes if c not in keep])


def _agg_cols(p, c, x):
    return ", ".join(f"""round({fn}({x}), 4) AS "{n}({c}.{p})" """ for n, fn in (("SUM", "sum"), ("MEAN", "avg"), ("MIN", "min"), ("MAX", "max"), ("STD", "stddev_samp")))


@query("dfs", "M2", sql=f"""WITH l AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q, avg(l_quantity) AS mq FROM lineitem GROUP BY 1),
   o AS (SELECT *, month(o_orderdate)::INT AS m, coalesce(n, 0) AS n0 FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
   a AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS s, avg(o_totalprice) AS a, sum(n0) AS sn, avg(n0) AS an, sum(q) AS sq, avg(q) AS aq, sum(mq) AS smq, avg(mq) AS amq, sum(m) AS sm, avg(m) AS am FROM o GROUP BY 1)
   SELECT c_custkey, c_nationkey, round(c_acctbal, 4) AS c_acctbal, coalesce(n, 0) AS "COUNT(orders)", round(s, 4) AS "SUM(orders.o_totalprice)", round(a, 4) AS "MEAN(orders.o_totalprice)",
     round(sn::DOUBLE, 4) AS "SUM(orders.COUNT(lineitem))", round(an, 4) AS "MEAN(orders.COUNT(lineitem))", round(sq, 4) AS "SUM(orders.SUM(lineitem.l_quantity))", round(aq, 4) AS "MEAN(orders.SUM(lineitem.l_quantity))",
     round(smq, 4) AS "SUM(orders.MEAN(lineitem.l_quantity))", round(amq, 4) AS "MEAN(orders.MEAN(lineitem.l_quantity))", round(sm::DOUBLE, 4) AS "SUM(orders.MONTH(o_orderdate))", round(am, 4) AS "MEAN(orders.MONTH(o_orderdate))"
   FROM customer LEFT JOIN a ON o_custkey = c_custkey""")
def _(t):
    e = es(t)
    e = e.with_table("lineitem", e.tables["lineitem"].df.select("l_orderkey", "l_quantity"), time_index=None)
    return _rounded(M.dfs(e, "customer", ["count", "sum", "mean"], ["month"])[0], [])


@query("aggregation_primitives", "M3", sql=f"""SELECT c_custkey, coalesce(n, 0) AS "COUNT(orders)", {', '.join(f'"{p}(orders.o_totalprice)"' for p in ('SUM', 'MEAN', 'MIN', 'MAX', 'STD'))}, "AVG_TIME_BETWEEN(orders.o_orderdate)"
   FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, {_agg_cols('o_totalprice', 'orders', 'o_totalprice')},
     round(CASE WHEN count(*) > 1 THEN (epoch(max(o_orderdate)) - epoch(min(o_orderdate))) / (count(*) - 1) END, 4) AS "AVG_TIME_BETWEEN(orders.o_orderdate)" FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def _(t):
    prims = ["count", "sum", "mean", "min", "max", "std", "avg_time_between"]
    return _rounded(M.dfs(es(t), "customer", prims, depth=1)[0], ["c_nationkey", "c_acctbal"])


@query("transform_primitives", "M4", sql="""SELECT event_id, round(epoch(ts) - epoch(lag(ts) OVER (ORDER BY ts, event_id)), 4) AS since_any, round(epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)), 4) AS since_own,
   month(ts)::INT AS m, hour(ts)::INT AS h, abs(value - 20) AS a FROM events""")
def _(t):
    df = t.events.select("event_id", "user_id", "ts", F.month("ts").alias("m"), F.hour("ts").alias("h"), F.abs(F.col("value") - 20).alias("a"))
    df = M.time_since_previous(df, "ts", "event_id", out="since_any")
    df = M.time_since_previous(df, "ts", "event_id", "user_id", out="since_own")
    return df.select("event_id", r(F.col("since_any"), 4).alias("since_any"), r(F.col("since_own"), 4).alias("since_own"), "m", "h", "a")


@query("dfs_transforms", "M4", sql="""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, month(o_orderdate)::INT AS "MONTH(o_orderdate)", hour(o_orderdate)::INT AS "HOUR(o_orderdate)", abs(o_totalprice) AS "ABSOLUTE(o_totalprice)",
   round(epoch(o_orderdate) - epoch(lag(o_orderdate) OVER (ORDER BY o_orderdate, o_orderkey)), 4) AS "TIME_SINCE_PREVIOUS(o_orderdate)" FROM orders""")
def _(t):
    return _rounded(M.dfs(es(t), "orders", [], ["month", "hour", "absolute", "time_since_previous"], depth=0)[0], [])


CUT = "(SELECT o_custkey AS k, max(o_orderdate) - INTERVAL 200 DAY AS cutoff FROM orders GROUP BY 1)"
LAST = "(SELECT o_orderkey AS ok, greatest(o_orderdate, max(l_shipdate)) AS last_time FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate)"


def _cutoffs(t):
    return t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.max("o_orderdate") - F.expr("INTERVAL 200 DAYS")).alias("cutoff"))


@query("dfs_cutoff", "M5", sql=f"""WITH o AS (SELECT o.*, cutoff FROM orders o JOIN {CUT} ON k = o_custkey JOIN {LAST} ON ok = o_orderkey WHERE o_orderdate <= cutoff AND last_time > cutoff - INTERVAL 700 DAY),
   l AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem JOIN o ON l_orderkey = o_orderkey WHERE l_shipdate <= cutoff AND l_shipdate > cutoff - INTERVAL 700 DAY GROUP BY 1),
   a AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS s, sum(coalesce(n, 0)) AS sn, sum(q) AS sq FROM o LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1)
   SELECT c_custkey, cutoff, coalesce(n, 0) AS "COUNT(orders)", round(s, 4) AS "SUM(orders.o_totalprice)", round(sn::DOUBLE, 4) AS "SUM(orders.COUNT(lineitem))", round(sq, 4) AS "SUM(orders.SUM(lineitem.l_quantity))"
   FROM customer JOIN {CUT} ON k = c_custkey LEFT JOIN a ON o_custkey = c_custkey""")
def _(t):
    e = es(t)
    e = e.with_table("lineitem", t.lineitem.select("l_orderkey", "l_quantity", "l_shipdate"))
    e = M.at_cutoff(e, "customer", _cutoffs(t), F.expr("INTERVAL 700 DAYS"))
    return _rounded(M.dfs(e, "customer", ["count", "sum"])[0], ["c_nationkey", "c_acctbal"])


@query("last_time_index", "M6", sql="SELECT ok AS o_orderkey, last_time FROM " + LAST)
def _(t):
    return M.last_time_index(es(t), "orders").select("o_orderkey", F.col("last_time").cast("timestamp_ntz").alias("last_time"))


@query("series_features", "M7", sql="""WITH e AS (SELECT user_id, value AS x, row_number() OVER w - 1 AS pos, lag(value) OVER w AS p, lead(value) OVER w AS n1, lead(value, 2) OVER w AS n2, avg(value) OVER (PARTITION BY user_id) AS mu,
     var_pop(value) OVER (PARTITION BY user_id) AS v FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
   SELECT user_id, count(*) AS length, count(*) FILTER (x > p AND x > n1) AS peaks, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS sd, round(min(x), 4) AS min, round(max(x), 4) AS max, round(var_pop(x), 4) AS variance,
     round(avg(n2 * n2 * n1 - n1 * x * x) FILTER (n2 IS NOT NULL), 4) AS asymmetry, round(regr_slope(x, pos), 4) + 0.0 AS slope, round(sum((x - mu) * (n1 - mu)) FILTER (n1 IS NOT NULL) / ((count(*) - 1) * max(v)), 4) + 0.0 AS autocorrelation
   FROM e GROUP BY 1""")
def _(t):
    return M.series_features(t.events, "user_id", ["ts", "event_id"], "value", 4)


APEN = """{n} AS (SELECT a.user_id, a.pos, count(*) AS c FROM w a, w b WHERE a.user_id = b.user_id AND {both} AND {close} GROUP BY 1, 2),
  p{n} AS (SELECT user_id, avg(ln(c)) - ln(count(*)) AS phi FROM {n} GROUP BY 1)"""


@query("approx_entropy", "M8", sql="""WITH w AS (SELECT user_id, row_number() OVER w AS pos, value AS x0, lead(value) OVER w AS x1, lead(value, 2) OVER w AS x2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), """
       + APEN.format(n="m2", both="a.x1 IS NOT NULL AND b.x1 IS NOT NULL", close="abs(a.x0 - b.x0) <= 15 AND abs(a.x1 - b.x1) <= 15") + ", "
       + APEN.format(n="m3", both="a.x2 IS NOT NULL AND b.x2 IS NOT NULL", close="abs(a.x0 - b.x0) <= 15 AND abs(a.x1 - b.x1) <= 15 AND abs(a.x2 - b.x2) <= 15")
       + " SELECT user_id, round(pm2.phi - pm3.phi, 6) AS approx_entropy FROM pm2 JOIN pm3 USING (user_id)")
def _(t):
    return M.approx_entropy(t.events, "user_id", ["ts", "event_id"], "value", 2, 15.0)


PROBLEMS = {"clicks": "event_type = 'click'", "large": "value > 50"}
WHEN = "(SELECT user_id AS k, min(ts) + INTERVAL 5 DAY AS cutoff FROM events GROUP BY 1)"


@query("prediction_problems", "M9", sql=" UNION ALL ".join(
    f"""SELECT user_id, '{a}({v}) of {f} in {d}d' AS problem, round(({fn} FILTER ({c} AND ts > cutoff AND ts <= cutoff + INTERVAL {d} DAY))::DOUBLE, 6) AS label FROM events JOIN {WHEN} ON k = user_id GROUP BY 1"""
    for f, c in PROBLEMS.items() for a, v, fn in (("count", "*", "count(*)"), ("mean", "value", "avg(value)")) for d in (3, 7)))
def _(t):
    cutoffs = t.events.groupBy("user_id").agg((F.min("ts") + F.expr("INTERVAL 5 DAYS")).alias("cutoff"))
    problems = M.enumerate_problems(PROBLEMS, ["count", "mean"], ["value"], [3, 7])
    return M.prediction_problems(t.events, "user_id", "ts", "event_id", cutoffs, problems)


@query("parent_path", "M10", sql="""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, c_nationkey AS "customer.c_nationkey", c_acctbal AS "customer.c_acctbal", n_name AS "customer.nation.n_name", n_regionkey AS "customer.nation.n_regionkey"
   FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")
def _(t):
    return M.parent_path(es(t), "orders")
