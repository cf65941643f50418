"""Queries: projection, filter, conversion, nested data."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..functions.cols import r
from ..operators import shape as S
from .registry import query


@query("select_columns", "B1", "A5", sql="SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    return S.select_columns(t.orders, ["o_orderkey", "o_totalprice"])


@query("read_parquet", "A5", sql="SELECT * FROM supplier")
def _(t):
    return t.supplier


@query("drop_columns", "B2", sql="SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _(t):
    return S.drop_columns(t.customer, ["c_name", "c_acctbal"])


@query("rename", "B3", sql="SELECT p_partkey AS part_id, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _(t):
    return S.rename(t.part, "p_partkey", "part_id")


@query("add_constant", "B4", sql="SELECT *, 'upload' AS action FROM nation")
def _(t):
    return S.add_constant(t.nation, "action", "upload")


@query("where", "B5", sql="SELECT * FROM lineitem WHERE l_quantity < 10 AND l_discount >= 0.05")
def _(t):
    return S.where(t.lineitem, "l_quantity < 10 AND l_discount >= 0.05")


@query("where_any", "B6", sql="SELECT * FROM orders WHERE o_orderstatus IN ('F') OR o_orderpriority IN ('1-URGENT','2-HIGH')")
def _(t):
    return S.where_any(t.orders, {"o_orderstatus": ["F"], "o_orderpriority": ["1-URGENT", "2-HIGH"]})


@query("binarize_label", "B7", sql="""SELECT o_orderkey, (contains(o_orderpriority, 'HIGH'))::INT AS is_high,
  (o_totalprice > 250000)::INT AS high_value, (o_orderstatus = 'F')::INT AS finished FROM orders""")
def _(t):
    df = S.binarize_label(t.orders, "o_orderpriority", "is_high", contains="HIGH")
    df = S.binarize_label(df, "o_totalprice", "high_value", above=250000)
    df = S.binarize_label(df, "o_orderstatus", "finished", equals="F")
    return df.select("o_orderkey", "is_high", "high_value", "finished")


@query("convert", "B8", sql="""WITH s AS (SELECT o_orderkey, substr(o_orderpriority,1,1) AS p, o_orderpriority AS word,
    strftime(o_orderdate, '%Y/%m/%d') AS d FROM orders)
  SELECT o_orderkey, try_cast(p AS INTEGER) AS as_integer, try_cast(word AS INTEGER) AS as_null, try_cast(p AS BIGINT) AS as_long,
    try_cast(p AS TINYINT) AS as_byte, try_cast(p AS SMALLINT) AS as_short, try_cast(p AS FLOAT) AS as_float,
    try_cast(p AS DOUBLE) AS as_double, try_strptime(d, '%Y/%m/%d')::DATE AS as_date,
    CASE p WHEN '1' THEN true END AS as_boolean, o_orderkey::VARCHAR AS as_string FROM s""")
def _(t):
    p = F.substring("o_orderpriority", 1, 1)
    df = t.orders.select(
        "o_orderkey", p.alias("as_integer"), F.col("o_orderpriority").alias("as_null"), p.alias("as_long"),
        p.alias("as_byte"), p.alias("as_short"), p.alias("as_float"), p.alias("as_double"),
        F.date_format("o_orderdate", "yyyy/MM/dd").alias("as_date"),
        F.when(p == "1", "true").otherwise("maybe").alias("as_boolean"), F.col("o_orderkey").alias("as_string"))
    df = S.convert(df, ["as_integer", "as_null"], "integer")
    for kind in ("long", "byte", "short", "float", "double", "boolean", "string"):
        df = S.convert(df, f"as_{kind}", kind)
    return S.convert(df, "as_date", "date", "yyyy/MM/dd")


@query("to_categorical", "B9", sql="""WITH l AS (SELECT o_orderpriority AS level, (row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1)::INT AS code
    FROM orders GROUP BY 1)
  SELECT o_orderkey, code AS o_orderpriority, o_orderpriority AS restored FROM orders JOIN l ON level = o_orderpriority""")
def _(t):
    df = t.orders.select("o_orderkey", "o_orderpriority")
    coded, tables = S.to_categorical(df, "o_orderpriority")
    back = S.clear_categorical(coded.withColumn("restored", F.col("o_orderpriority")),
                               {"restored": tables["o_orderpriority"]})
    return back


@query("sql_stage", "B10", sql="SELECT l_orderkey, round(l_extendedprice * (1 - l_discount), 4) AS net, l_returnflag FROM lineitem WHERE l_tax > 0.04")
def _(t):
    stage = S.sql_stage("SELECT l_orderkey, round(l_extendedprice * (1 - l_discount), 4) AS net, l_returnflag FROM __THIS__ WHERE l_tax > 0.04")
    return Pipeline(stages=[stage]).fit(t.lineitem).transform(t.lineitem)


@query("predictions_by", "B11", sql="""SELECT o_orderstatus, o_orderpriority, count(*) AS n,
  round(avg(CASE WHEN o_totalprice > 250000 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS mean_prediction FROM orders GROUP BY 1, 2""")
def _(t):
    df = t.orders.withColumn("prediction", F.when(F.col("o_totalprice") > 250000, 1.0).otherwise(0.0))
    return S.predictions_by(df, ["o_orderstatus", "o_orderpriority"], "prediction")


@query("udf_stage", "B12", sql="SELECT doc_id, length(regexp_replace(text, '[^ ]', '', 'g'))::INT AS blanks FROM documents")
def _(t):
    stage = S.udf_stage("text", "blanks", lambda c: F.length(F.regexp_replace(c, "[^ ]", "")))
    df = t.documents.select("doc_id", "text")
    return Pipeline(stages=[stage]).fit(df).transform(df).drop("text")


@query("residual", "B14", sql="""SELECT round(avg(o_totalprice - (1000.0::DOUBLE * o_custkey)), 4) AS mean_residual,
  count(*) AS n FROM orders""")
def _(t):
    df = S.residual(t.orders.withColumn("pred", F.col("o_custkey") * 1000.0), "o_totalprice", "pred")
    return df.agg(r(F.avg("residual"), 4).alias("mean_residual"), F.count(F.lit(1)).alias("n"))


@query("argmax", "B15", sql="SELECT vec_id, list_position(embedding, list_max(embedding))::BIGINT - 1 AS argmax FROM embeddings")
def _(t):
    return S.argmax(t.embeddings, "embedding").select("vec_id", "argmax")


@query("drop_na", "B16", sql="SELECT event_id, value FROM events WHERE nullif(event_type, 'error') IS NOT NULL AND (CASE WHEN value >= 1 THEN value END) IS NOT NULL")
def _(t):
    df = t.events.select("event_id", F.when(F.col("value") >= 1, F.col("value")).alias("value"),
                         F.nullif("event_type", F.lit("error")).alias("kind"))
    return S.drop_na(df, ["value", "kind"]).drop("kind")


@query("map_values", "B17", sql="SELECT event_id, CASE event_type WHEN 'view' THEN 1.0::DOUBLE WHEN 'click' THEN 2.0 WHEN 'purchase' THEN 5.0 END AS weight FROM events")
def _(t):
    return S.map_values(t.events, "event_type", {"view": 1.0, "click": 2.0, "purchase": 5.0}, "weight").select("event_id", "weight")


@query("split_to_array", "B18", sql="SELECT c_custkey, string_split(c_name, '#') AS parts FROM customer")
def _(t):
    return S.split_to_array(t.customer, "c_name", "#", "parts").select("c_custkey", "parts")


@query("expand_struct", "B19", sql="SELECT event_id, (props::JSON->>'k')::INT AS k FROM events")
def _(t):
    df = S.parse_json_response(t.events.select("event_id", "props"), "props", "k INT")
    return S.expand_struct(df.drop("props"), "response", drop="error")


def _sections(t):
    """Nested result per document: one struct (idx, text, size) per line of its text."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("idx"), x.alias("text"), F.length(x).alias("size")))
    return t.documents.select("doc_id", lines.alias("sections"))


@query("flatten_results", "B20", sql="SELECT doc_id, length(unnest(string_split(text, chr(10))))::INT AS size FROM documents")
def _(t):
    return S.flatten_results(_sections(t), "sections", "size", "size")


@query("first_of", "B21", sql="""SELECT doc_id, length(list_filter(string_split(text, chr(10)), lambda x: length(x) > 200)[1])::INT AS size
  FROM documents""")
def _(t):
    df = _sections(t).withColumn("sections", F.filter("sections", lambda e: e["size"] > 200))
    return S.first_of(df, "sections", "size", "size").drop("sections")


@query("join_lines", "B22", sql="SELECT doc_id, md5(replace(text, chr(10), ' / ')) AS digest FROM documents")
def _(t):
    return S.join_lines(_sections(t), "sections", "text", "lines", " / ").select("doc_id", F.md5("lines").alias("digest"))


@query("to_json_request", "B23", sql="""SELECT l_quantity AS quantity, count(*) AS n,
    '{"quantity":' || l_quantity::VARCHAR || '}' AS request FROM lineitem GROUP BY 1""")
def _(t):
    df = t.lineitem.groupBy(F.col("l_quantity").alias("quantity")).agg(F.count(F.lit(1)).alias("n"))
    return S.to_json_request(df, ["quantity"])


@query("parse_json_response", "B23", sql="""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN (props::JSON->>'k')::INT END AS k,
    event_id % 7 = 0 AS failed FROM events""")
def _(t):
    broken = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("<"), "props")).otherwise(F.col("props"))
    df = S.parse_json_response(t.events.select("event_id", broken.alias("reply")), "reply", "k INT")
    return df.select("event_id", F.col("response.k").alias("k"), F.col("error").isNotNull().alias("failed"))


@query("page_offsets", "B24", sql="SELECT n_name AS term, u.v::INT AS \"offset\" FROM nation, (SELECT unnest([0, 50, 100, 150]) AS v) u")
def _(t):
    return S.page_offsets(t.nation.select(F.col("n_name").alias("term")), 4, 50)


@query("dict_columns", "B25", sql="""SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN value ELSE 0 END AS click,
   CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS purchase FROM events""")
def _(t):
    df = t.events.select("user_id", "event_id", F.create_map("event_type", "value").alias("bag"))
    return S.dict_columns(df, "bag", ["click", "purchase"])


@query("dict_features", "B25", sql="""
    WITH t AS (SELECT event_id, unnest([{term: 'k', x: (props->>'k')::DOUBLE}, {term: 'kind=' || event_type, x: 1.0::DOUBLE}], recursive := true) FROM events),
    s AS (SELECT event_id, (('0x' || substr(md5('0|' || term), 1, 8))::BIGINT % 16) AS slot, sum(x) AS x FROM t GROUP BY ALL)
    SELECT event_id, list_transform(range(16), lambda i: coalesce(m[i], 0.0))::DOUBLE[] AS features
    FROM (SELECT event_id, map(list(slot), list(x)) AS m FROM s GROUP BY 1)""")
def _(t):
    bag = F.map_concat(F.from_json("props", "MAP<STRING, STRING>"), F.create_map(F.lit("kind"), F.col("event_type")))
    return S.dict_features(t.events.select("event_id", bag.alias("bag")), "bag", 16).select("event_id", S.vector_to_array("features").alias("features"))


@query("align_columns", "D3", sql="SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey < 10")
def _(t):
    a, b = S.align_columns(t.orders.select("o_orderkey", "o_orderstatus", "o_custkey"),
                           t.orders.where("o_custkey < 10").select("o_custkey", "o_totalprice", "o_orderkey"))
    return a.unionByName(b)
