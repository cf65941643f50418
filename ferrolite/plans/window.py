"""Queries: windows, sorts, samples, set operations, splits and folds."""

from pyspark.sql import functions as F

from ..functions.cols import r
from ..operators import split as H, window as E
from .registry import query
from .trials import TRIALS, trials


@query("rolling_mean", "E1", sql="""SELECT event_id, round(CASE WHEN count(*) OVER w = 5 THEN avg(value) OVER w END, 6) AS rolling
   FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def _(t):
    out = E.rolling_mean(t.events, ["ts", "event_id"], "value", 5)
    return out.select("event_id", r(F.col("rolling")).alias("rolling"))


@query("back_fill", "E1", sql="""WITH e AS (SELECT event_id, ts, CASE WHEN event_type IN ('click', 'error') THEN value END AS v FROM events)
   SELECT event_id, first_value(v IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled FROM e""")
def _(t):
    df = t.events.select("event_id", "ts", F.when(F.col("event_type").isin("click", "error"), F.col("value")).alias("v"))
    return E.back_fill(df, ["ts", "event_id"], "v", "filled").select("event_id", "filled")


@query("rolling_mean_by_user", "E1", sql="""SELECT event_id, round(CASE WHEN count(*) OVER w = 3 THEN avg(value) OVER w END, 6) AS rolling
   FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def _(t):
    out = E.rolling_mean(t.events, ["ts", "event_id"], "value", 3, group="user_id")
    return out.select("event_id", r(F.col("rolling")).alias("rolling"))


@query("top_k_per_group", "E2", sql="""SELECT o_orderpriority, o_orderkey, o_totalprice, rank FROM (
   SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders) WHERE rank <= 7""")
def _(t):
    return E.top_k_per_group(t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice"), "o_orderpriority", ["-o_totalprice", "o_orderkey"], 7, "rank")


@query("best_row", "E3", sql="SELECT event_id, value FROM events ORDER BY value, event_id LIMIT 1")
def _(t):
    return E.best_row(t.events.select("event_id", "value"), ["value", "event_id"])


@query("rank_trials", "E4", sql=f"WITH t AS ({TRIALS}) SELECT study, number, loss, row_number() OVER (ORDER BY loss, number) - 1 AS rank FROM t")
def _(t):
    return E.rank_trials(trials(t).select("study", "number", "loss"))


@query("sort_by", "E5", sql="SELECT p_partkey, p_name, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 50")
def _(t):
    return E.sort_by(t.part.select("p_partkey", "p_name", "p_size"), ["-p_size", "p_partkey"], 50)


@query("shuffle_sample", "E6", sql="SELECT doc_id, lang FROM documents ORDER BY ('0x' || substr(md5('9|' || doc_id), 1, 8))::BIGINT, doc_id LIMIT 200")
def _(t):
    return E.shuffle_sample(t.documents.select("doc_id", "lang"), 200, 9, "doc_id")


@query("sample", "E7", sql="SELECT o_orderkey FROM orders WHERE ('0x' || substr(md5('3|' || o_orderkey), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.1")
def _(t):
    return E.sample(t.orders.select("o_orderkey"), 0.1, 3, "o_orderkey")


@query("union_labelled", "E8", sql="""SELECT s_name AS name, s_acctbal AS balance, 'supplier' AS kind FROM supplier
   UNION ALL SELECT c_name, c_acctbal, 'customer' FROM customer""")
def _(t):
    return E.union_labelled(t.supplier.selectExpr("s_name AS name", "s_acctbal AS balance"),
                            t.customer.selectExpr("c_acctbal AS balance", "c_name AS name"), "kind", "supplier", "customer")


@query("distinct_rows", "E9", sql="SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(t):
    return E.distinct_rows(t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber"))


@query("best_so_far", "E10", sql=f"""WITH t AS ({TRIALS}) SELECT study, number, loss,
   min(loss) OVER (PARTITION BY study ORDER BY number) AS best_so_far FROM t""")
def _(t):
    return E.best_so_far(trials(t).select("study", "number", "loss"), group="study")


@query("best_so_far_overall", "E10", sql=f"WITH t AS ({TRIALS}) SELECT number, min(loss) OVER (ORDER BY number) AS best_so_far FROM t")
def _(t):
    return E.best_so_far(trials(t).select("number", "loss")).drop("loss")


@query("explode_params", "E11", sql=f"WITH t AS ({TRIALS}) SELECT study, number, user_id::VARCHAR AS user, k::VARCHAR AS k FROM t")
def _(t):
    return E.explode_params(trials(t).select("study", "number", "params"), ["user", "k"])


@query("label_series", "E12", sql=f"WITH t AS ({TRIALS}) SELECT number, loss, study AS search FROM t WHERE study IN ('view', 'click')")
def _(t):
    df = trials(t)
    return E.label_series(view=df.where("study = 'view'").select("number", "loss"), click=df.where("study = 'click'").select("number", "loss"))


@query("trend", "E13", sql=f"WITH t AS ({TRIALS}) SELECT study, round(regr_slope(loss, number), 9) AS slope, round(regr_intercept(loss, number), 6) AS intercept FROM t GROUP BY 1")
def _(t):
    return E.trend(trials(t), "loss", group="study")


HASH = "('0x' || substr(md5('{}|' || o_orderkey), 1, 8))::BIGINT"


@query("split", "H1", sql=f"""SELECT o_orderkey, CASE WHEN u < 0.6 THEN 0 WHEN u < 0.8 THEN 1 ELSE 2 END AS part
   FROM (SELECT o_orderkey, {HASH.format(7)} / 4294967296.0::DOUBLE AS u FROM orders)""")
def _(t):
    return H.assign_split(t.orders.select("o_orderkey"), [0.6, 0.2, 0.2], 7, "o_orderkey")


@query("stratified_split", "H2", sql=f"""SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH.format(5)}, o_orderkey)
   <= ceil(count(*) OVER (PARTITION BY o_orderstatus) * 0.7::DOUBLE) AS is_train FROM orders""")
def _(t):
    return H.stratified_split(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", 0.7, 5, "o_orderkey")


@query("head_split", "H3", sql="""SELECT event_id, row_number() OVER (ORDER BY ts, event_id) <= floor(count(*) OVER () * 0.9::DOUBLE) AS is_train FROM events""")
def _(t):
    return H.head_split(t.events.select("event_id", "ts"), ["ts", "event_id"], 0.9).drop("ts")


@query("time_split", "H3", sql="SELECT o_orderkey, (o_orderdate >= TIMESTAMP '2000-01-01')::INT AS part FROM orders")
def _(t):
    old, new = H.time_split(t.orders, "o_orderdate", "2000-01-01")
    return old.select("o_orderkey", F.lit(0).alias("part")).unionByName(new.select("o_orderkey", F.lit(1).alias("part")))


@query("kfold", "H4", sql=f"SELECT o_orderkey, ({HASH.format(1)} % 5)::INT AS fold FROM orders")
def _(t):
    return H.kfold(t.orders.select("o_orderkey"), 5, 1, "o_orderkey")


@query("stratified_kfold", "H5", sql=f"""SELECT o_orderkey, ((row_number() OVER (PARTITION BY o_orderpriority ORDER BY {HASH.format(2)}, o_orderkey) - 1) % 5)::INT AS fold FROM orders""")
def _(t):
    return H.stratified_kfold(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", 5, 2, "o_orderkey").drop("o_orderpriority")


@query("split_by_flag", "H6", sql="SELECT o_orderkey, o_totalprice, (o_orderstatus = 'F')::INT AS train FROM orders")
def _(t):
    a, b = H.split_by_flag(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), "o_orderstatus", "F")
    return a.withColumn("train", F.lit(1)).unionByName(b.withColumn("train", F.lit(0)))
