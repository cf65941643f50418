"""Queries: source and sink round trips of the given tables, and streams over their files."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..functions.cols import r, vec_to_array
from ..functions.store import work_dir
from ..operators import models as I, search as S
from ..sources import readers as R, writers as W
from ..streaming import streams as N
from .registry import query
from .trials import TRIALS, trials


@query("read_csv", "A1", "A9", sql="SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    path = work_dir(t.spark, "csv")
    W.write_csv(t.customer.select("c_name", "c_acctbal", "c_custkey"), path, "c_custkey")
    return R.read_csv(t.spark, path, "c_custkey long, c_name string, c_acctbal double", header=True)


@query("read_csv_infer", "A2", sql="SELECT p_partkey::INT AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _(t):
    path = work_dir(t.spark, "csv")
    W.write_csv(t.part, path)
    return R.read_csv(t.spark, path, header=True, infer=True)


@query("read_delimited", "A3", sql=r"SELECT doc_id::VARCHAR AS ID, md5(regexp_replace(lang || '||' || text, '[\r\n]+', ' ', 'g')) AS digest FROM documents")
def _(t):
    path = work_dir(t.spark, "delimited")
    W.write_delimited(t.documents.select("doc_id", "lang", "text"), path, header="Number||Body", line_breaks="space")
    return R.read_delimited(t.spark, path, ["ID", "Text"]).select("ID", F.md5("Text").alias("digest"))


@query("read_tsv", "A4", sql="SELECT (l_returnflag = 'R')::INT::DOUBLE AS label, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem")
def _(t):
    path = work_dir(t.spark, "tsv")
    t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("label"), "l_quantity", "l_discount", "l_tax").write.option("sep", "\t").csv(path)
    return R.read_tsv(t.spark, path, 3)


@query("read_libsvm", "A6", sql="SELECT (l_returnflag = 'R')::INT::DOUBLE AS label, [l_quantity, l_discount, l_tax] AS features FROM lineitem")
def _(t):
    path = work_dir(t.spark, "libsvm")
    vec = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(t.lineitem.withColumn("label", (F.col("l_returnflag") == "R").cast("double")))
    W.write_libsvm(vec, path)
    return vec_to_array(R.read_libsvm(t.spark, path, 3), "features")


@query("read_binary_files", "A7")
def _(t):
    return R.read_images(t.spark, f"{t.dir}/*.parquet", decode=False).select(F.element_at(F.split("path", "/"), -1).alias("file"), "length")


@query("from_rows", "A8", sql="SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    rows = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per status
    return R.from_rows(t.spark, [tuple(row) for row in rows], "o_orderstatus string, n long")


@query("json_round_trip", "A10", sql=f"WITH t AS ({TRIALS}) SELECT study, number, loss, state FROM t")
def _(t):
    path = work_dir(t.spark, "json")
    W.write_json(trials(t).select("study", "number", "loss", "params", "state"), path)
    return R.read_json(t.spark, path, "study string, number long, loss double, params map<string,string>, state string").drop("params")


@query("append_history", "A11", sql=f"WITH t AS ({TRIALS}) SELECT study, number, loss FROM t")
def _(t):
    path = work_dir(t.spark, "history")
    rows = trials(t).select("study", "number", F.col("number").cast("int").alias("iteration"), "loss", "params", "state", F.lit(0.0).alias("train_time"), F.lit("derived").alias("source"))
    S.append_history(rows.where("state = 'COMPLETE'"), path)
    S.append_history(rows.where("state <> 'COMPLETE'"), path)
    return S.read_history(t.spark, path).select("study", "number", "loss")


@query("save_model", "A12")
def _(t):
    stages = [VectorAssembler(inputCols=["l_quantity", "l_tax"], outputCol="features"), I.estimator("linear", label="l_extendedprice")]
    path = work_dir(t.spark, "model")
    W.save_model(Pipeline(stages=stages).fit(t.lineitem), path)
    return R.load_model(path).transform(t.lineitem).select("l_orderkey", r(F.col("prediction"), 3).alias("prediction"))


@query("stream_to_memory", "N1", "N2", sql="SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def _(t):
    stream = N.stream_files(t.spark, t.dir, t.events.schema, pattern="events*.parquet")
    counts = stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return N.stream_to_memory(counts, "event_totals", "complete").select("event_type", "n", r(F.col("total"), 4).alias("total"))


@query("stream_score", "N3")
def _(t):
    stages = [VectorAssembler(inputCols=["k"], outputCol="features", handleInvalid="keep"), I.estimator("linear", label="value")]
    model = Pipeline(stages=stages).fit(t.events.select("value", F.from_json("props", "k double").alias("p")).select("value", "p.k"))
    stream = N.stream_files(t.spark, t.dir, t.events.schema, pattern="events*.parquet")
    sink = work_dir(t.spark, "replies")
    N.stream_score(stream, "props", "k double", model, sink, work_dir(t.spark, "checkpoint"), keep=["event_id"])
    return t.spark.read.parquet(sink).select("event_id", r(F.col("prediction")).alias("prediction"))
