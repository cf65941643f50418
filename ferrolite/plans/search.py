"""Queries: search spaces, suggestions, tuning loops and trial history."""

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.sql import functions as F

from ..functions.cols import r
from ..functions.store import work_dir
from ..operators import models as I, profile as P, search as S, space as K, split as H
from .models import lines, orders_frame
from .registry import query
from .trials import TRIALS, trials


def U(label, index="event_id", seed=5):
    return f"(('0x' || substr(md5('{seed}|{label}|' || {index}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


DISTS = {
    "a": (K.choice("x", "y", "z"), f"(['x', 'y', 'z'])[floor({U('a')} * 3)::INT + 1]"),
    "b": (K.pchoice((0.7, 1), (0.2, 2), (0.1, 3)), f"CASE WHEN {U('b')} < 0.7 THEN 1 WHEN {U('b')} < 0.7 + 0.2 THEN 2 ELSE 3 END"),
    "c": (K.uniform(-2, 5), f"round(-2 + {U('c')} * 7, 9)"),
    "d": (K.quniform(0, 100, 5), f"round({U('d')} * 100 / 5) * 5"),
    "e": (K.loguniform(-5, 0), f"round(exp(-5 + {U('e')} * 5), 9)"),
    "f": (K.qloguniform(0, 6, 2), f"round(exp({U('f')} * 6) / 2) * 2"),
    "g": (K.randint(3, 17), f"floor(3 + {U('g')} * 14)::BIGINT"),
    "h": (K.integer(1, 6), f"floor(1 + {U('h')} * 6)::BIGINT"),
    "i": (K.normal(10, 2), f"""round(10 + 2 * (sqrt(-2 * ln(1 - {U('i')})) * cos({U("i''")} * 6.283185307179586)), 9)"""),
    "j": (K.lognormal(0, 1), f"""round(exp(sqrt(-2 * ln(1 - {U('j')})) * cos({U("j''")} * 6.283185307179586)), 9)"""),
    "k": (K.discrete_uniform(0.1, 0.9, 0.2), f"round(0.1 + floor({U('k')} * 5) * 0.2::DOUBLE, 9)"),
}


@query("sample_space", "K1", "K2", sql="SELECT event_id, " + ", ".join(f"{sql} AS {n}" for n, (_, sql) in DISTS.items()) + " FROM events")
def _(t):
    df = K.draw_columns(t.events.select("event_id"), {n: d for n, (d, _) in DISTS.items()}, "event_id", 5)
    return df.select(*[r(F.col(c), 9).alias(c) if c in "ceijk" else c for c in df.columns])


NESTED = {"model": K.choice({"forest": {"numTrees": K.integer(2, 8), "maxDepth": K.integer(2, 5)}, "logistic": {"regParam": K.loguniform(-6, 0)}, "tree": {"maxDepth": K.integer(2, 9)}})}
_M = f"(['forest', 'logistic', 'tree'])[floor({U('model')} * 3)::INT + 1]"
NESTED_SQL = f"""SELECT event_id, {_M} AS model, CASE WHEN {_M} = 'forest' THEN floor(2 + {U('model__forest__numTrees')} * 7)::BIGINT END AS model__forest__numTrees,
   CASE WHEN {_M} = 'forest' THEN floor(2 + {U('model__forest__maxDepth')} * 4)::BIGINT END AS model__forest__maxDepth,
   CASE WHEN {_M} = 'logistic' THEN round(exp(-6 + {U('model__logistic__regParam')} * 6), 9) END AS model__logistic__regParam,
   CASE WHEN {_M} = 'tree' THEN floor(2 + {U('model__tree__maxDepth')} * 8)::BIGINT END AS model__tree__maxDepth FROM events"""


def nested(t):
    df = K.draw_columns(t.events.select("event_id"), NESTED, "event_id", 5)
    return df.withColumn("model__logistic__regParam", r(F.col("model__logistic__regParam"), 9))


@query("conditional_space", "K3", sql=NESTED_SQL)
def _(t):
    return nested(t)


@query("flatten_branch", "K4", sql=f"SELECT event_id, model, coalesce(model__forest__maxDepth, model__tree__maxDepth, 5) AS maxDepth FROM ({NESTED_SQL})")
def _(t):
    return K.flatten_branch(nested(t), NESTED, "maxDepth", 5).select("event_id", "model", F.col("maxDepth").cast("long").alias("maxDepth"))


@query("operator_config", "K24", sql=f"SELECT event_id, (['pca', 'tree'])[floor({U('model')} * 2)::INT + 1] AS model, CASE floor({U('model')} * 2) WHEN 0 THEN ([2, 4])[floor({U('model__pca__k')} * 2)::INT + 1] END AS model__pca__k, CASE floor({U('model')} * 2) WHEN 1 THEN ([3, 5, 7])[floor({U('model__tree__maxDepth')} * 3)::INT + 1] END AS model__tree__maxDepth FROM events")
def _(t):
    spec = K.operator_config({"pca": {"k": [2, 4]}, "tree": {"maxDepth": [3, 5, 7]}})
    return K.draw_columns(t.events.select("event_id"), spec, "event_id", 5)


# --- suggestions over the history derived from events

TPE_SPEC = {"user_id": K.uniform(0, 150), "k": K.uniform(0, 100), "study": K.choice("click", "error", "purchase", "signup", "view")}
_CAND = f"""SELECT draw, 150 * {U('user_id', 'draw', 9)} AS y1, 100 * {U('k', 'draw', 9)} AS y2, (['click', 'error', 'purchase', 'signup', 'view'])[floor({U('study', 'draw', 9)} * 5)::INT + 1] AS y3 FROM (SELECT unnest(range(0, 24)) AS draw)"""


def _dens(x, y, width, side):
    bw = width * 0.1
    return f"(sum(exp(-0.5 * power(({y} - {x}) / {bw}::DOUBLE, 2)) / ({bw}::DOUBLE * 2.5066282746310002)) FILTER ({side}) + 1 / {width}::DOUBLE) / (count(*) FILTER ({side}) + 1)"


TPE_SQL = f"""WITH t AS ({TRIALS}), q AS (SELECT quantile_cont(loss, 0.25) AS cut FROM t), c AS ({_CAND}),
   s AS (SELECT draw, round({' + '.join(f"ln({_dens(x, y, w, 'loss <= cut')}) - ln({_dens(x, y, w, 'loss > cut')})" for x, y, w in (('user_id', 'y1', 150.0), ('k', 'y2', 100.0)))}
     + ln((count(*) FILTER (loss <= cut AND study = y3) + 0.2::DOUBLE) / (count(*) FILTER (loss <= cut) + 1)) - ln((count(*) FILTER (loss > cut AND study = y3) + 0.2::DOUBLE) / (count(*) FILTER (loss > cut) + 1)), 6) AS score FROM t, q, c GROUP BY draw)"""


def _tpe_input(t):
    return trials(t).select("study", "loss", "user_id", "k"), K.sample_space(t.spark, TPE_SPEC, 24, 9)


@query("tpe_scores", "K11", sql=TPE_SQL + " SELECT * FROM s")
def _(t):
    return S.tpe_scores(*_tpe_input(t), TPE_SPEC).withColumn("score", r(F.col("score")))


@query("tpe_suggest", "K11", sql=TPE_SQL + " SELECT draw FROM s ORDER BY score DESC, draw LIMIT 1")
def _(t):
    return S.tpe_suggest(*_tpe_input(t), TPE_SPEC).select("draw")


@query("forest_suggest", "K12")
def _(t):
    return S.forest_suggest(*_tpe_input(t), TPE_SPEC, trees=8)


@query("trials_dataframe", "K15", sql=f"WITH t AS ({TRIALS}) SELECT study, number, loss AS value, state, user_id::VARCHAR AS params_user FROM t WHERE study = 'view'")
def _(t):
    return S.trials_dataframe(trials(t), "view", "user")


@query("best_trial", "K16", sql=f"WITH t AS ({TRIALS}) SELECT study, number, loss FROM t WHERE state = 'COMPLETE' QUALIFY row_number() OVER (PARTITION BY study ORDER BY loss, number) = 1")
def _(t):
    return S.best_trial(trials(t).select("study", "number", "loss", "state"), group="study").drop("state")


@query("median_prune", "K17", sql="""WITH s AS (SELECT user_id AS trial, day(ts)::INT AS step, round(avg(value), 6) AS value FROM events GROUP BY 1, 2), m AS (SELECT step, median(value) AS median FROM s WHERE trial < 100 GROUP BY 1)
   SELECT trial, step, value, round(median, 6) AS median, coalesce(value > median, false) AS prune FROM s LEFT JOIN m USING (step) WHERE trial >= 100""")
def _(t):
    steps = t.events.groupBy(F.col("user_id").alias("trial"), F.dayofmonth("ts").alias("step")).agg(r(F.avg("value")).alias("value"))
    return S.median_prune(steps, 100).withColumn("median", r(F.col("median")))


@query("rung_survivors", "K18", sql="""SELECT rung, trial, loss FROM (SELECT (user_id % 4)::INT AS rung, event_id AS trial, value AS loss, row_number() OVER (PARTITION BY user_id % 4 ORDER BY value, event_id) AS p, count(*) OVER (PARTITION BY user_id % 4) AS n FROM events) WHERE p <= greatest(n // 3, 1)""")
def _(t):
    return S.rung_survivors(t.events.select((F.col("user_id") % 4).cast("int").alias("rung"), F.col("event_id").alias("trial"), F.col("value").alias("loss")), 3)


@query("param_importance", "K19", sql=f"""WITH t AS ({TRIALS}), l AS (SELECT loss, 'study' AS param, study AS level FROM t UNION ALL SELECT loss, 'k', least(floor((k - (SELECT min(k) FROM t)) / ((SELECT max(k) FROM t) - (SELECT min(k) FROM t))::DOUBLE * 8), 7)::VARCHAR FROM t),
   g AS (SELECT param, level, count(*) AS n, avg(loss) AS m FROM l GROUP BY 1, 2) SELECT param, round(sum(n * power(m - (SELECT avg(loss) FROM t), 2)) / (SELECT var_pop(loss) * count(*) FROM t), 6) AS importance FROM g GROUP BY 1""")
def _(t):
    return S.param_importance(trials(t), ["study", "k"])


@query("param_importance_forest", "K19")
def _(t):
    return S.param_importance_forest(trials(t), ["user_id", "k"], trees=6)


@query("compare_searches", "K21", sql=f"""WITH t AS ({TRIALS}), b AS (SELECT study, min_by(number, (loss, number)) AS best FROM t GROUP BY 1)
   SELECT study, count(*) AS n, round(avg(loss), 6) AS mean_loss, min(loss) AS best_loss, count(*) FILTER (number <= best) AS evaluations_to_best FROM t JOIN b USING (study) GROUP BY 1""")
def _(t):
    return S.compare_searches(trials(t))


@query("nearest_datasets", "C18", sql="""WITH m AS (SELECT user_id, count(*) AS n, avg(value) AS a, stddev_samp(value) AS s FROM events GROUP BY 1), w AS (SELECT max(n) - min(n) AS wn, max(a) - min(a) AS wa, max(s) - min(s) AS ws FROM m)
   SELECT m.user_id, round(abs(m.n - x.n) / wn::DOUBLE + abs(m.a - x.a) / wa + abs(m.s - x.s) / ws, 9) AS distance FROM m, w, (SELECT * FROM m WHERE user_id = 7) x WHERE m.user_id <> 7 ORDER BY distance, m.user_id LIMIT 5""")
def _(t):
    meta = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("a"), F.stddev_samp("value").alias("s"))
    return P.nearest_datasets(meta, "user_id", 7, ["n", "a", "s"], 5)


@query("feature_set_selector", "K25", sql="SELECT l_orderkey, l_quantity, l_extendedprice, l_tax FROM lineitem")
def _(t):
    sets = t.spark.createDataFrame([("size", 2, ["l_quantity", "l_extendedprice"]), ("duty", 1, ["l_tax"]), ("flags", 2, ["l_returnflag", "l_linestatus"])], "name string, n int, features array<string>")
    return S.feature_set_selector(t.lineitem, sets, ["size", "duty"], "l_orderkey")


# --- tuning loops; a handful of trials each, on the whole tables

def _parts(t):
    return H.split(lines(t, "flag"), [0.6, 0.2, 0.2], 13, "row_id")


def auc():
    return BinaryClassificationEvaluator(labelCol="label")


TREES = {"model": K.choice({"decision_tree": {"maxDepth": K.integer(2, 5)}, "logistic": {"regParam": K.loguniform(-6, 0)}})}
RESULT = ("number", "loss", "state")


def _tune(t, algo, n, **kw):
    train, valid, _ = _parts(t)
    train, valid = train.persist(), valid.persist()
    try:
        objective = S.validation_objective(train, valid, auc())
        return S.tune(t.spark, objective, TREES, work_dir(t.spark, algo), algo, algo, n, n_candidates=12, n_startup=2, **kw)
    finally:
        train.unpersist(), valid.unpersist()


@query("random_search", "K6")
def _(t):
    return _tune(t, "random", 3, parallelism=3).select(*RESULT)


@query("tune_tpe", "K13")
def _(t):
    return _tune(t, "tpe", 4).select(*RESULT)


@query("tune_forest", "K12", "K13")
def _(t):
    return _tune(t, "forest", 4).select(*RESULT)


@query("resume", "K14", "A11")
def _(t):
    train, valid, _ = _parts(t)
    objective, path = S.validation_objective(train, valid, auc()), work_dir(t.spark, "resume")
    S.tune(t.spark, objective, TREES, path, "s", "random", 2)
    return S.resume(t.spark, objective, TREES, path, "s", algo="random", max_evals=2).select(*RESULT)


@query("cross_validate_grid", "K5", "K7", "K10")
def _(t):
    est = I.estimator("decision_tree")
    df = H.kfold(lines(t, "flag"), 2, 3, "row_id").select("features", "label", "fold")
    cv = S.cross_validate_grid(df, est, K.grid(est, {"maxDepth": [2, 4], "maxBins": [8, 16]}), auc(), "fold", 2)
    return S.cv_results(t.spark, cv)


@query("tune_on_validation", "K8")
def _(t):
    train, valid, _ = _parts(t)
    est = I.estimator("decision_tree")
    return S.tune_on_validation(train, valid, [(est, {"maxDepth": d}) for d in (2, 3, 4)], auc())[1]


@query("find_best_model", "K9")
def _(t):
    train, valid, _ = _parts(t)
    fitted = {"tree": I.fit("decision_tree", train, maxDepth=3), "logistic": I.fit("logistic", train, maxIter=5)}
    return S.find_best_model(fitted, valid, ["areaUnderROC", "accuracy"])[1]


@query("successive_halving", "K18")
def _(t):
    train, valid = (part.select("features", "label").persist() for part in _parts(t)[:2])  # every fit and score reads them

    def objective(params, budget):
        est = I.estimator("gbt", maxIter=budget, maxDepth=int(params["maxDepth"]), seed=1)
        return S.loss_of(auc(), auc().evaluate(est.fit(train).transform(valid)))

    try:
        return S.successive_halving(t.spark, objective, {"maxDepth": K.integer(2, 4)}, 4, 2, 1, 4, parallelism=2)
    finally:
        train.unpersist(), valid.unpersist()


@query("log_run", "K22")
def _(t):
    path = work_dir(t.spark, "runs")
    for e in ("view", "click"):
        stats = trials(t).where(F.col("study") == e).agg(F.avg("loss").alias("mean"), F.count(F.lit(1)).alias("n")).first()
        S.log_run(t.spark, path, e, {"study": e}, stats.asDict(), {"source": "events"})
    return S.search_runs(t.spark, path, "metrics['n'] > 0", "metrics['mean']").select("run_id", r(F.col("metrics")["mean"]).alias("mean"))


@query("evolve", "K23")
def _(t):
    train, valid = (part.select("features", "label").persist() for part in _parts(t)[:2])  # every fit and score reads them many times
    try:
        return S.evolve(t.spark, S.validation_objective(train, valid, auc()), TREES, 2, 4, start=[{"model": "decision_tree", "model__decision_tree__maxDepth": 3}])
    finally:
        train.unpersist(), valid.unpersist()


@query("cached_prefix", "K26")
def _(t):
    train, valid, _ = _parts(t)
    prefix = S.CachedPrefix(Pipeline(stages=[StandardScaler(inputCol="features", outputCol="scaled")]), train)
    try:
        fitted = {f"depth{d}": prefix.fit(I.estimator("decision_tree", "scaled", maxDepth=d)) for d in (2, 4)}
    finally:
        prefix.close()
    return S.find_best_model(fitted, valid, "areaUnderROC")[1]


@query("leaderboard", "K27")
def _(t):
    families = {"decision_tree": {"maxDepth": 3}, "logistic": {"maxIter": 5}, "naive_bayes": {"modelType": "gaussian"}}
    return S.leaderboard(lines(t, "flag"), "label", "row_id", families, "areaUnderROC", k=2).drop("seconds")


@query("predictor", "K28", "A12")
def _(t):
    train, test = H.split(orders_frame(t), [0.7, 0.3], 4, "o_orderkey")
    roles = {"label": "output", "o_orderkey": "ignore", "month": "categorical"}
    p = S.Predictor("classifier", roles).train(train, "logistic", maxIter=5)
    path = work_dir(t.spark, "predictor")
    p.save(path)
    return S.Predictor("classifier", roles).load(path).score(test)
