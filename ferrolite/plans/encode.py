"""Queries: cleaning, scaling and encoding."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.cols import r, vec_to_array
from ..operators import encode as N, scale as S
from .registry import query

GAPS = "(SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v, nullif(user_id, 5) AS u FROM events)"


def gaps(t):
    return t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"),
                           F.nullif("user_id", F.lit(5).cast("long")).alias("u"))


@query("clean_missing_mean", "F1", sql=f"SELECT event_id, round(coalesce(v, avg(v) OVER ()), 6) AS v FROM {GAPS}")
def _(t):
    return S.clean_missing(gaps(t), "v", "mean").select("event_id", r(F.col("v")).alias("v"))


@query("clean_missing_median", "F1", sql=f"SELECT event_id, coalesce(v, median(v) OVER ()) AS v, coalesce(u::DOUBLE, median(u) OVER ()) AS u FROM {GAPS}")
def _(t):
    return S.clean_missing(gaps(t), ["v", "u"], "median")


@query("clean_missing_custom", "F1", sql=f"SELECT event_id, coalesce(v, -1) AS v, u FROM {GAPS}")
def _(t):
    return S.clean_missing(gaps(t), "v", "custom", -1.0)


LEVELS = "(SELECT o_orderpriority AS level, (row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1)::INT AS code FROM orders GROUP BY 1)"
BY_VALUE = "(SELECT o_orderpriority AS level, (row_number() OVER (ORDER BY o_orderpriority) - 1)::INT AS code FROM orders GROUP BY 1)"
SEEN = "(SELECT o_orderpriority AS level, (row_number() OVER (ORDER BY min(o_orderkey), o_orderpriority))::INT AS code FROM orders GROUP BY 1)"


def pri(t, *more):
    return t.orders.select("o_orderkey", "o_orderpriority", *more)


@query("index_categories", "F2", sql=f"SELECT o_orderkey, o_orderpriority, code AS o_orderpriority_index FROM orders JOIN {LEVELS} ON level = o_orderpriority")
def _(t):
    return N.index_categories(pri(t), "o_orderpriority")


@query("one_hot", "F3", sql=f"SELECT o_orderkey, [(code = 0)::INT::DOUBLE, (code = 1)::INT::DOUBLE, (code = 2)::INT::DOUBLE, (code = 3)::INT::DOUBLE] AS vec FROM orders JOIN {LEVELS} ON level = o_orderpriority")
def _(t):
    df = N.one_hot(N.index_categories(pri(t), "o_orderpriority", out="i"), "i", out="vec")
    return vec_to_array(df.select("o_orderkey", "vec"), "vec")


@query("label_encode", "F4", sql="SELECT o_orderkey, o_orderpriority, o_clerk, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::INT AS o_orderpriority_code, (dense_rank() OVER (ORDER BY o_clerk) - 1)::INT AS o_clerk_code FROM (SELECT *, 'c' || (o_custkey % 50)::VARCHAR AS o_clerk FROM orders)")
def _(t):
    clerk = F.concat(F.lit("c"), (F.col("o_custkey") % 50).cast("string")).alias("o_clerk")
    return N.label_encode(pri(t, clerk), ["o_orderpriority", "o_clerk"])


@query("label_encode_scaled", "F5", sql="SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1) / 4 AS o_orderpriority_scaled FROM orders")
def _(t):
    return N.label_encode_scaled(pri(t), "o_orderpriority").drop("o_orderpriority")


@query("assemble", "F6", sql="SELECT l_orderkey, [l_quantity, l_discount, l_tax] AS features FROM lineitem")
def _(t):
    return vec_to_array(N.assemble(t.lineitem, ["l_quantity", "l_discount", "l_tax"]).select("l_orderkey", "features"), "features")


@query("index_vector_categories", "F7")
def _(t):
    df = N.assemble(t.lineitem, ["l_quantity", "l_linenumber"]).select("l_orderkey", "features")
    return vec_to_array(N.index_vector_categories(df, max_categories=8).drop("features"), "indexed")


@query("standardize", "F8", sql="SELECT l_orderkey, round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity, round((l_tax - avg(l_tax) OVER ()) / stddev_pop(l_tax) OVER (), 6) AS l_tax FROM lineitem")
def _(t):
    df = S.scale(t.lineitem.select("l_orderkey", "l_quantity", "l_tax"), ["l_quantity", "l_tax"])
    return df.select("l_orderkey", r(F.col("l_quantity")).alias("l_quantity"), r(F.col("l_tax")).alias("l_tax"))


@query("standardize_from_train", "F8", sql="SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS o_totalprice FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders WHERE o_orderstatus = 'F')")
def _(t):
    df = t.orders.select("o_orderkey", "o_totalprice")
    out = S.scale(df, "o_totalprice", fit_on=t.orders.where("o_orderstatus = 'F'"))
    return out.withColumn("o_totalprice", r(F.col("o_totalprice")))


@query("normalize_rows", "F9", sql="SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE))), 6) + 0.0) AS unit FROM embeddings")
def _(t):
    df = S.normalize_rows(t.embeddings, "embedding", out="unit")
    return df.select("vec_id", F.transform("unit", lambda x: r(x)).alias("unit"))


@query("minmax", "F10", sql="SELECT p_partkey, round((p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ()), 6) AS p_size FROM part")
def _(t):
    return S.scale(t.part.select("p_partkey", "p_size"), "p_size", "minmax").withColumn("p_size", r(F.col("p_size")))


@query("maxabs", "F10", sql="SELECT c_custkey, round(c_acctbal / max(abs(c_acctbal)) OVER (), 6) + 0.0 AS c_acctbal FROM customer")
def _(t):
    return S.scale(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "maxabs").withColumn("c_acctbal", r(F.col("c_acctbal")))


@query("robust_scale", "F11", sql="SELECT event_id, round((value - m) / (q3 - q1), 6) + 0.0 AS value FROM events, (SELECT median(value) AS m, quantile_cont(value, .25) AS q1, quantile_cont(value, .75) AS q3 FROM events)")
def _(t):
    return S.scale(t.events.select("event_id", "value"), "value", "robust").withColumn("value", r(F.col("value")))


@query("quantile_transform", "F12", sql="SELECT event_id, value, round(cume_dist() OVER (ORDER BY value), 9) AS uniform FROM events")
def _(t):
    return S.quantile_transform(t.events.select("event_id", "value"), "value").withColumn("uniform", r(F.col("uniform"), 9))


@query("quantile_transform_sketch", "F12")
def _(t):
    return S.quantile_transform_sketch(t.events.select("event_id", "value"), "value", t.events, 200)


@query("gauss_rank", "F13")
def _(t):
    return S.gauss_rank(t.events.select("event_id", "value"), "value", "event_id")


@query("bin_quantiles", "F14", sql="SELECT o_orderkey, o_totalprice, o_custkey, ntile(7) OVER (ORDER BY o_totalprice, o_orderkey)::INT AS o_totalprice_bin, ntile(7) OVER (ORDER BY o_custkey, o_orderkey)::INT AS o_custkey_bin FROM orders")
def _(t):
    return S.bin_quantiles(t.orders.select("o_orderkey", "o_totalprice", "o_custkey"), ["o_totalprice", "o_custkey"], 7, "o_orderkey")


def _flags(t):
    return N.assemble(t.lineitem.select("l_orderkey", (F.col("l_returnflag") == "R").cast("double").alias("label"), "l_quantity", "l_discount", "l_extendedprice"),
                      ["l_quantity", "l_discount", "l_extendedprice"])


@query("leaf_encode", "F15")
def _(t):
    return N.leaf_encode(_flags(t), "features", "label", "l_orderkey").select("l_orderkey", "leaf")


@query("leaf_encode_unsupervised", "F15")
def _(t):
    return N.leaf_encode(_flags(t), "features", None, "l_orderkey").select("l_orderkey", "leaf")


@query("hash_features", "F16")
def _(t):
    df = N.hash_features(pri(t, "o_orderstatus", "o_totalprice"), ["o_orderpriority", "o_orderstatus", "o_totalprice"], 64)
    return vec_to_array(df.select("o_orderkey", "features"), "features")


def _slot(seed, text):
    return f"('0x' || substr(md5('{seed}|' || {text}), 1, 8))::BIGINT"


@query("hash_features_portable", "F16", sql=f"""SELECT o_orderkey, list_transform(range(0, 8), lambda s: round((CASE WHEN a = s THEN o_totalprice ELSE 0 END) + (b = s)::INT + (c = s)::INT, 4)) AS hashed FROM (
   SELECT o_orderkey, o_totalprice, {_slot('n', "'o_totalprice'")} % 8 AS a, {_slot('c', "'o_orderpriority|' || o_orderpriority")} % 8 AS b, {_slot('c', "'o_orderstatus|' || o_orderstatus")} % 8 AS c FROM orders)""")
def _(t):
    df = N.hash_features_portable(pri(t, "o_orderstatus", "o_totalprice"), "o_totalprice", ["o_orderpriority", "o_orderstatus"], 8)
    return df.select("o_orderkey", F.transform("hashed", lambda x: r(x, 4)).alias("hashed"))


@query("ordinal", "F17", sql=f"SELECT o_orderkey, code AS o_orderpriority_ordinal, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE -1 END AS o_orderstatus_ordinal FROM orders JOIN {SEEN} ON level = o_orderpriority")
def _(t):
    df = N.ordinal(pri(t, "o_orderstatus"), "o_orderpriority", by="o_orderkey")
    return N.ordinal(df, "o_orderstatus", order=["F", "O"]).drop("o_orderpriority", "o_orderstatus")


@query("binary_encode", "F18", sql=f"SELECT o_orderkey, (code // 4) % 2 AS o_orderpriority_0, (code // 2) % 2 AS o_orderpriority_1, code % 2 AS o_orderpriority_2 FROM orders JOIN {SEEN} ON level = o_orderpriority")
def _(t):
    return N.binary_encode(pri(t), "o_orderpriority", "o_orderkey").drop("o_orderpriority")


@query("base_n_encode", "F19", sql=f"SELECT o_orderkey, (code // 3) % 3 AS o_orderpriority_0, code % 3 AS o_orderpriority_1 FROM orders JOIN {SEEN} ON level = o_orderpriority")
def _(t):
    return N.base_n_encode(pri(t), "o_orderpriority", 3, "o_orderkey").drop("o_orderpriority")


@query("hashing_encode", "F20", sql="SELECT o_orderkey, " + ", ".join(f"(a = {i})::INT + (b = {i})::INT AS hash_{i}" for i in range(8)) +
       f" FROM (SELECT o_orderkey, {_slot('h', 'o_orderpriority')} % 8 AS a, {_slot('h', 'o_orderstatus')} % 8 AS b FROM orders)")
def _(t):
    return N.hashing_encode(pri(t, "o_orderstatus"), ["o_orderpriority", "o_orderstatus"]).drop("o_orderpriority", "o_orderstatus")


Y = "(SELECT *, (o_totalprice > 250000)::INT::DOUBLE AS y FROM orders)"
STATS = f"(SELECT o_custkey AS level, count(*) AS n, sum(y) AS s, avg(y) AS m, var_samp(y) AS v FROM {Y} GROUP BY 1), (SELECT avg(y) AS prior, var_samp(y) AS pv FROM {Y})"


def _target(t):
    return t.orders.select("o_orderkey", "o_custkey", (F.col("o_totalprice") > 250000).cast("int").alias("y"))


def _encoded(name, expr):
    return f"SELECT o_orderkey, round({expr}, 6) + 0.0 AS code FROM orders JOIN (SELECT * FROM {STATS}) ON level = o_custkey"


for _name, _item, _expr in (("target", "F21", "prior * (1 - 1 / (1 + exp(-(n - 1)))) + m * (1 / (1 + exp(-(n - 1))))"),
                            ("m_estimate", "F23", "(s + prior) / (n + 1)"),
                            ("james_stein", "F24", "CASE WHEN coalesce(v, pv) = 0 THEN m ELSE (1 - (coalesce(v, pv) / n) / (coalesce(v, pv) / n + pv)) * m + (coalesce(v, pv) / n) / (coalesce(v, pv) / n + pv) * prior END")):
    @query(f"{_name}_encode", _item, sql=_encoded(_name, _expr))
    def _(t, method=_name):
        out = N.target_family_encode(_target(t), "o_custkey", "y", method, out="code")
        return out.select("o_orderkey", r(F.col("code")).alias("code"))


@query("target_encode_unseen", "F21", sql=f"""WITH tr AS (SELECT * FROM {Y} WHERE o_orderstatus = 'P' AND o_custkey < 900), g AS (SELECT o_custkey AS level, count(*) AS n, avg(y) AS m FROM tr GROUP BY 1)
   SELECT o_orderkey, round(coalesce(prior * (1 - 1 / (1 + exp(-(n - 1)))) + m * (1 / (1 + exp(-(n - 1)))), prior), 6) AS code FROM orders LEFT JOIN g ON level = o_custkey, (SELECT avg(y) AS prior FROM tr)""")
def _(t):
    train = t.orders.where("o_orderstatus = 'P' AND o_custkey < 900").withColumn("y", (F.col("o_totalprice") > 250000).cast("int"))
    out = N.target_family_encode(_target(t), "o_custkey", "y", "target", fit_on=train, out="code")
    return out.select("o_orderkey", r(F.col("code")).alias("code"))


@query("leave_one_out_encode", "F22", sql=f"SELECT o_orderkey, round(CASE WHEN n > 1 THEN (s - y) / (n - 1) ELSE prior END, 6) + 0.0 AS code FROM {Y} JOIN (SELECT * FROM {STATS}) ON level = o_custkey")
def _(t):
    out = N.leave_one_out_encode(_target(t), "o_custkey", "y", "code")
    return out.select("o_orderkey", r(F.col("code")).alias("code"))


@query("catboost_encode", "F25", sql=f"""SELECT o_orderkey, round((coalesce(sum(y) OVER w, 0) + (SELECT avg(y) FROM {Y})) / (count(*) OVER w + 1), 9) AS code FROM {Y}
   WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def _(t):
    df = pri(t, (F.col("o_totalprice") > 250000).cast("int").alias("y"))
    return N.catboost_encode(df, "o_orderpriority", "y", "o_orderkey", out="code").select("o_orderkey", r(F.col("code"), 9).alias("code"))


@query("woe_encode", "F26", sql=f"""SELECT o_orderkey, round(ln(((p + 1) / (tp + 2)) / ((q + 1) / (tq + 2))), 6) + 0.0 AS code FROM orders JOIN (SELECT o_custkey AS level, sum(y) AS p, sum(1 - y) AS q FROM {Y} GROUP BY 1) ON level = o_custkey,
   (SELECT sum(y) AS tp, sum(1 - y) AS tq FROM {Y})""")
def _(t):
    out = N.target_family_encode(_target(t), "o_custkey", "y", "woe", out="code")
    return out.select("o_orderkey", r(F.col("code")).alias("code"))


_CONTRAST = {
    "sum": [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1], [-1, -1, -1, -1]],
    "helmert": [[-1, -1, -1, -1], [1, -1, -1, -1], [0, 2, -1, -1], [0, 0, 3, -1], [0, 0, 0, 4]],
    "backward_difference": [[-.8, -.6, -.4, -.2], [.2, -.6, -.4, -.2], [.2, .4, -.4, -.2], [.2, .4, .6, -.2], [.2, .4, .6, .8]],
    "polynomial": [["-2/sqrt(10)", "2/sqrt(14)", "-1/sqrt(10)", "1/sqrt(70)"], ["-1/sqrt(10)", "-1/sqrt(14)", "2/sqrt(10)", "-4/sqrt(70)"],
                   ["0", "-2/sqrt(14)", "0", "6/sqrt(70)"], ["1/sqrt(10)", "-1/sqrt(14)", "-2/sqrt(10)", "-4/sqrt(70)"], ["2/sqrt(10)", "2/sqrt(14)", "1/sqrt(10)", "1/sqrt(70)"]],
}
for _kind, _rows in _CONTRAST.items():
    @query(f"contrast_{_kind}", "F27", sql="SELECT o_orderkey, " + ", ".join(
        f"round((CASE code {' '.join(f'WHEN {i} THEN ({row[j]})::DOUBLE' for i, row in enumerate(_rows))} END), 6) + 0.0 AS o_orderpriority_{_kind}_{j}" for j in range(4)) +
        f" FROM orders JOIN {BY_VALUE} ON level = o_orderpriority")
    def _(t, kind=_kind):
        out = N.contrast_encode(pri(t), "o_orderpriority", kind)
        return out.select("o_orderkey", *[r(F.col(c)).alias(c) for c in out.columns[2:]])


@query("polynomial_features", "F28", sql="""SELECT l_orderkey, l_quantity, l_tax, round(l_quantity * l_quantity, 6) AS "l_quantity^2", round(l_quantity * l_tax, 6) AS "l_quantity l_tax", round(l_tax * l_tax, 6) AS "l_tax^2", 1.0::DOUBLE AS "1" FROM lineitem""")
def _(t):
    df = S.polynomial_features(t.lineitem.select("l_orderkey", "l_quantity", "l_tax"), ["l_quantity", "l_tax"], bias=True)
    return df.select("l_orderkey", *[r(F.col(f"`{c}`")).alias(c) for c in df.columns[1:]])


@query("polynomial_interactions", "F28", sql="""SELECT l_orderkey, round(l_quantity * l_tax, 6) AS "l_quantity l_tax", round(l_quantity * l_discount, 6) AS "l_quantity l_discount",
   round(l_tax * l_discount, 6) AS "l_tax l_discount", round(l_quantity * l_tax * l_discount, 6) AS "l_quantity l_tax l_discount" FROM lineitem""")
def _(t):
    df = S.polynomial_features(t.lineitem.select("l_orderkey", "l_quantity", "l_tax", "l_discount"), ["l_quantity", "l_tax", "l_discount"], 3, interaction_only=True)
    return df.select("l_orderkey", *[r(F.col(f"`{c}`")).alias(c) for c in df.columns[4:]])


@query("log_label", "F29", sql="SELECT o_orderkey, round(ln(o_totalprice), 9) AS log_label, round(o_totalprice, 4) AS label FROM orders")
def _(t):
    df = S.exp_label(S.log_label(t.orders, "o_totalprice"), "log_label")
    return df.select("o_orderkey", r(F.col("log_label"), 9).alias("log_label"), r(F.col("label"), 4).alias("label"))


@query("date_features", "F30", sql="""SELECT event_id, month(ts)::INT AS ts_month, (isodow(ts) - 1)::INT AS ts_weekday, hour(ts)::INT AS ts_hour,
   CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning' WHEN hour(ts) < 18 THEN 'afternoon' ELSE 'evening' END AS ts_part FROM events""")
def _(t):
    return S.date_features(t.events.select("event_id", "ts"), "ts").drop("ts")


@query("class_weights", "F31", sql="SELECT doc_id, quality, round(count(*) OVER () / ((SELECT count(DISTINCT quality) FROM labels) * count(*) OVER (PARTITION BY quality)), 6) AS weight FROM labels")
def _(t):
    return S.class_weights(t.labels.select("doc_id", "quality"), "quality").withColumn("weight", r(F.col("weight")))


@query("oversample", "F31", sql="""WITH s AS (SELECT quality, max(count(*)) OVER () / count(*) AS ratio FROM labels GROUP BY quality),
   c AS (SELECT doc_id, l.quality, floor(ratio) + (('0x' || substr(md5('4|' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < ratio - floor(ratio))::INT AS k FROM labels l JOIN s ON s.quality = l.quality)
   SELECT doc_id, quality, unnest(range(1, k::BIGINT + 1)) AS copy FROM c""")
def _(t):
    return S.oversample(t.labels.select("doc_id", "quality"), "quality", 4, "doc_id")


@query("array_to_unit_rows", "F32", sql="SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS flat FROM embeddings")
def _(t):
    grid = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8))
    return S.array_to_unit_rows(t.embeddings.select("vec_id", grid.alias("image")), "image").drop("image")


@query("multi_label_encode", "F33", sql=f"""SELECT o_orderkey, p.code AS o_orderpriority_index, s.code AS o_orderstatus_index FROM orders JOIN {LEVELS} p ON p.level = o_orderpriority
   JOIN {LEVELS.replace('o_orderpriority', 'o_orderstatus')} s ON s.level = o_orderstatus""")
def _(t):
    return N.multi_label_encode(pri(t, "o_orderstatus"), ["o_orderpriority", "o_orderstatus"]).drop("o_orderpriority", "o_orderstatus")


@query("densify", "F34", sql=f"SELECT o_orderkey, list_transform(range(0, 5), lambda i: (i = code)::INT::DOUBLE) AS dense FROM orders JOIN {LEVELS} ON level = o_orderpriority")
def _(t):
    df = N.one_hot(N.index_categories(pri(t), "o_orderpriority", out="i"), "i", drop_last=False, out="vec")
    return N.densify(df, "vec").select("o_orderkey", "dense")
