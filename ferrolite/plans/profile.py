"""Queries: profiling and statistics."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..functions.cols import r, vec_to_array
from ..operators import profile as P
from .registry import query


def _quantiles(c):
    probs = {"q1": .25, "median": .5, "q3": .75, "p0_5": .005, "p1": .01, "p5": .05, "p95": .95, "p99": .99, "p99_5": .995}
    return ", ".join(f"round(quantile_cont({c}, {p}), 8) AS {n}" for n, p in probs.items())


def _summary(table, c):
    x = f"{c}::DOUBLE"
    return f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS "distinct",
      round(min({x}), 8) AS min, round(max({x}), 8) AS max, round(avg({x}), 8) AS mean, round(var_samp({x}), 8) AS variance, round(stddev_samp({x}), 8) AS sd,
      round(avg(power((v - mu) / sp, 3)), 8) + 0.0 AS skewness, round(kurtosis_pop({x}), 8) AS kurtosis, {_quantiles(x)}
      FROM (SELECT *, {x} AS v, avg({x}) OVER () AS mu, stddev_pop({x}) OVER () AS sp FROM {table})"""


LINE_DERIVED = "(SELECT CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity, l_discount, l_linenumber FROM lineitem)"


def _line_derived(t):
    return t.lineitem.select(F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("quantity"), "l_discount", "l_linenumber")


@query("summarize", "C1", sql=" UNION ALL ".join(_summary(LINE_DERIVED, c) for c in ("quantity", "l_discount", "l_linenumber")))
def _(t):
    return P.summarize(_line_derived(t), digits=8)


@query("summarize_orders", "C1", sql=_summary("orders", "o_totalprice"))
def _(t):
    return P.summarize(t.orders, ["o_totalprice"], digits=8)


@query("describe", "C2", sql="""
  SELECT 'c_acctbal' AS "column", count(*) AS count, round(avg(c_acctbal), 6) AS mean, round(stddev_samp(c_acctbal), 6) AS sd, min(c_acctbal) AS min,
    max(c_acctbal) AS max, round(quantile_cont(c_acctbal, .25), 6) AS q1, round(quantile_cont(c_acctbal, .5), 6) AS median,
    round(quantile_cont(c_acctbal, .75), 6) AS q3, NULL::BIGINT AS "distinct", NULL::VARCHAR AS top, NULL::BIGINT AS freq FROM customer
  UNION ALL SELECT 'c_mktsegment', sum(n)::BIGINT, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*), min_by(c_mktsegment, (-n, c_mktsegment)), max(n)
    FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)""")
def _(t):
    return P.describe(t.customer, ["c_acctbal", "c_mktsegment"])


@query("compare", "C3", sql="""SELECT 'o_totalprice' AS "column", count(*) FILTER (o_orderstatus = 'F') AS count_1,
    count(*) FILTER (o_orderstatus <> 'F') AS count_2, 0::BIGINT AS missing_1, 0::BIGINT AS missing_2,
    round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 6) AS mean_1, round(avg(o_totalprice) FILTER (o_orderstatus <> 'F'), 6) AS mean_2,
    round((avg(o_totalprice) FILTER (o_orderstatus <> 'F') - avg(o_totalprice) FILTER (o_orderstatus = 'F')) / stddev_samp(o_totalprice) FILTER (o_orderstatus = 'F'), 6) AS mean_shift
  FROM orders""")
def _(t):
    return P.compare(t.orders.where("o_orderstatus = 'F'"), t.orders.where("o_orderstatus <> 'F'"), ["o_totalprice"])


@query("compare_shares", "C3", sql="""SELECT 'o_orderpriority' AS "column", o_orderpriority AS value,
    round(count(*) FILTER (o_orderstatus = 'F') / (SELECT count(*) FROM orders WHERE o_orderstatus = 'F'), 6) AS share_1,
    round(count(*) FILTER (o_orderstatus <> 'F') / (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F'), 6) AS share_2
  FROM orders GROUP BY o_orderpriority""")
def _(t):
    return P.compare_shares(t.orders.where("o_orderstatus = 'F'"), t.orders.where("o_orderstatus <> 'F'"), ["o_orderpriority"])


@query("association", "C4", sql="""
  SELECT 'l_quantity' AS "column", 'pearson' AS measure, round(abs(corr(l_quantity, l_extendedprice)), 6) AS strength FROM lineitem
  UNION ALL SELECT 'l_tax', 'pearson', round(abs(corr(l_tax, l_extendedprice)), 6) FROM lineitem
  UNION ALL SELECT 'l_returnflag', 'correlation_ratio', round(sqrt(sum(n * (m - mu) * (m - mu)) / max(sst)), 6) FROM (
    SELECT count(*) AS n, avg(l_extendedprice) AS m FROM lineitem GROUP BY l_returnflag),
    (SELECT avg(l_extendedprice) AS mu, var_pop(l_extendedprice) * count(*) AS sst FROM lineitem)""")
def _(t):
    return P.association(t.lineitem, "l_extendedprice", ["l_quantity", "l_tax"], ["l_returnflag"])


CHI = """WITH c AS (SELECT o_orderpriority AS v, o_orderstatus AS y, count(*) AS n FROM orders GROUP BY 1, 2),
    e AS (SELECT a.v, b.y, a.n * b.n / (SELECT sum(n) FROM c)::DOUBLE AS e FROM (SELECT v, sum(n) AS n FROM c GROUP BY 1) a, (SELECT y, sum(n) AS n FROM c GROUP BY 1) b)
    SELECT sum(power(coalesce(c.n, 0) - e.e, 2) / e.e) AS x2, (count(DISTINCT e.v) - 1) * (count(DISTINCT e.y) - 1) AS degrees,
    count(DISTINCT e.v) AS rows, count(DISTINCT e.y) AS cols FROM e LEFT JOIN c ON c.v = e.v AND c.y = e.y"""


@query("chi_square", "C6", sql=f"SELECT 'o_orderpriority' AS feature, round(x2, 5) AS statistic, degrees, rows, cols FROM ({CHI})")
def _(t):
    return P.chi_square(t.orders, ["o_orderpriority"], "o_orderstatus")


@query("cramers_v", "C4", sql=f"SELECT 'o_orderpriority' AS feature, round(sqrt(x2 / ((SELECT count(*) FROM orders) * least(rows - 1, cols - 1))), 6) AS cramers_v FROM ({CHI})")
def _(t):
    return P.cramers_v(t.orders, "o_orderstatus", ["o_orderpriority"])


GAPS = "SELECT CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS p, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS s FROM orders"
CHI_GAPS = f"""WITH o AS ({GAPS}), k AS (SELECT * FROM o WHERE p IS NOT NULL AND s IS NOT NULL), c AS (SELECT p, s, count(*) AS n FROM k GROUP BY ALL),
   a AS (SELECT p, sum(n) AS rn FROM c GROUP BY 1), b AS (SELECT s, sum(n) AS cn FROM c GROUP BY 1)
   SELECT sum(n)::DOUBLE AS total, sum(n) * (sum(n * n::DOUBLE / (rn::DOUBLE * cn)) - 1) AS x2, count(DISTINCT p) AS rows, count(DISTINCT s) AS cols FROM c JOIN a USING (p) JOIN b USING (s)"""


def _gaps(t):
    return t.orders.select(F.expr("CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS p"), F.expr("CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS s"))


@query("chi_square_gaps", "C6", sql=f"SELECT 'p' AS feature, round(x2, 5) AS statistic, (rows - 1) * (cols - 1) AS degrees, rows, cols FROM ({CHI_GAPS})")
def _(t):
    return P.chi_square(_gaps(t), ["p"], "s")


@query("cramers_v_gaps", "C4", sql=f"SELECT 'p' AS feature, round(sqrt(x2 / (total * least(rows - 1, cols - 1))), 6) AS cramers_v FROM ({CHI_GAPS})")
def _(t):
    return P.cramers_v(_gaps(t), "s", ["p"])


@query("chi_square_test", "C6")
def _(t):
    df = t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("y"), "l_linenumber", "l_quantity")
    return P.chi_square_test(df, ["l_linenumber", "l_quantity"], "y")


_PAIRS = [("l_quantity", "l_quantity"), ("l_quantity", "l_extendedprice"), ("l_extendedprice", "l_extendedprice")]


@query("corr_matrix", "C5", sql=" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a, b in _PAIRS))
def _(t):
    return P.corr_matrix(t.lineitem, ["l_quantity", "l_extendedprice"])


@query("corr_matrix_spearman", "C5", sql="""WITH k AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS l_quantity,
   rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE AS l_extendedprice FROM lineitem) """
       + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM k" for a, b in _PAIRS))
def _(t):
    return P.corr_matrix(t.lineitem, ["l_quantity", "l_extendedprice"], "spearman")


@query("weighted_summary", "C7", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS count, round(sum(l_quantity), 4) AS weight_sum, round(sum(l_quantity * {c}) / sum(l_quantity), 6) AS mean FROM lineitem"""
    for c in ("l_discount", "l_tax")))
def _(t):
    return P.weighted_summary(t.lineitem, ["l_discount", "l_tax"], "l_quantity")


@query("weighted_vector_summary", "C7", sql="""SELECT [round(sum(l_quantity * l_discount) / sum(l_quantity), 6), round(sum(l_quantity * l_tax) / sum(l_quantity), 6)] AS mean,
   count(*) AS count FROM lineitem""")
def _(t):
    vec = VectorAssembler(inputCols=["l_discount", "l_tax"], outputCol="v").transform(t.lineitem)
    return vec_to_array(P.weighted_vector_summary(vec, "v", "l_quantity"), "mean", digits=6)


@query("value_counts", "C8", sql="SELECT event_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 6) AS share FROM events GROUP BY 1")
def _(t):
    return P.value_counts(t.events, "event_type")


@query("distinct_counts", "C9", sql=" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "distinct" FROM lineitem""" for c in ("l_orderkey", "l_partkey", "l_returnflag")))
def _(t):
    return P.distinct_counts(t.lineitem, ["l_orderkey", "l_partkey", "l_returnflag"])


@query("top_groups", "C10", sql="SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 7")
def _(t):
    return P.top_groups(t.events, "user_id", 7)


@query("bottom_groups", "C10", sql="SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n, user_id LIMIT 7")
def _(t):
    return P.top_groups(t.events, "user_id", 7, most=False)


@query("describe_by", "C11", sql="""SELECT lang, count(*) AS count, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS sd, min(n_chars)::DOUBLE AS min,
   max(n_chars)::DOUBLE AS max, round(quantile_cont(n_chars, .25), 6) AS q1, round(quantile_cont(n_chars, .5), 6) AS median, round(quantile_cont(n_chars, .75), 6) AS q3
   FROM documents GROUP BY 1""")
def _(t):
    return P.describe_by(t.documents, "lang", "n_chars")


@query("group_sum_mean", "C12", sql="SELECT source, sum(n_chars)::BIGINT AS sum_chars, round(avg(n_chars), 6) AS mean_chars FROM documents GROUP BY 1")
def _(t):
    return P.group_sum_mean(t.documents, "source", "n_chars", "chars")


@query("histogram", "C13", sql="""SELECT bin, count(*) AS n, round(0.0::DOUBLE + bin * 4.0::DOUBLE, 6) AS "left" FROM (
   SELECT least(floor(value / 4.0::DOUBLE)::INT, 24) AS bin FROM events WHERE value BETWEEN 0 AND 100) GROUP BY 1""")
def _(t):
    return P.histogram(t.events, "value", 25, 0.0, 100.0)


@query("density", "C14", sql="""SELECT x::DOUBLE AS x, round(avg(exp(-0.5 * power((x - value) / 5.0::DOUBLE, 2)) / (5.0::DOUBLE * sqrt(2 * pi()))), 9) AS density
   FROM events, (SELECT unnest(range(0, 101, 5)) AS x) GROUP BY 1""")
def _(t):
    return P.density(t.events, "value", range(0, 101, 5), 5.0)


@query("overall_max_row", "C15", sql="SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def _(t):
    return P.overall_max_row(t.orders, "o_totalprice", "o_orderkey")


@query("shape", "C16", sql="SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def _(t):
    return P.shape(t.lineitem)


@query("dataset_metafeatures", "C17", sql="""WITH e AS (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS v, nullif(user_id % 10, 3)::VARCHAR AS g FROM events),
   s AS (SELECT count(*) AS n_rows, round((count(*) * 2 - count(v) - count(g)) / (count(*) * 2), 6) AS missing_share,
      round(kurtosis_pop(v), 6) AS mean_kurtosis FROM e),
   k AS (SELECT round(avg(power((v - mu) / sp, 3)), 6) AS mean_skewness FROM e, (SELECT avg(v) AS mu, stddev_pop(v) AS sp FROM e)),
   c AS (SELECT count(*) AS n_classes, round(-sum(p * ln(p)), 6) AS class_entropy FROM (SELECT count(*) / (SELECT count(*) FROM e) AS p FROM e GROUP BY event_type))
   SELECT *, 1 AS n_numeric, 1 AS n_categorical FROM s, k, c""")
def _(t):
    df = t.events.select("event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("v"),
                         F.nullif(F.col("user_id") % 10, F.lit(3).cast("long")).cast("string").alias("g"))
    return P.dataset_metafeatures(df, "event_type", ["v"], ["g"])
