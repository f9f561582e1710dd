"""Split, preprocessing, training, scoring and metrics."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from medallion.operators.categories import CategoryIndexer
from medallion.operators.clean import split_target
from medallion.operators.features import (
    MedianImputer,
    ModeImputer,
    NumericScaler,
    build_preprocessor,
    feature_columns,
    hash_split,
)
from medallion.operators.metrics import (
    auc_roc,
    binary_metrics,
    class_report,
    classification_metrics,
    confusion,
    regression_metrics,
)
from medallion.operators.models import build_model, load_model, make_estimator, save_model, score, score_python_model, train_model
from medallion.operators.runs import read_runs
from medallion.plans.config import InferenceConfig, TrainConfig
from medallion.plans.jobs import inference_job, train_job
from medallion.session import scratch_dir
from workload import query, table

BUCKET = "('0x' || substr(md5({key} || ':42'), 1, 8))::BIGINT % 100 < 20"
ORDER_TEST = BUCKET.format(key="o_orderkey")


@query(f"SELECT o_orderkey, o_totalprice, CASE WHEN {ORDER_TEST} THEN 'test' ELSE 'train' END AS part FROM orders")
def split_hashed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    train, test = hash_split(orders, key=["o_orderkey"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("""
SELECT o_orderkey, o_totalprice, CASE WHEN h <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part
FROM (SELECT *, rank() OVER (ORDER BY ('0x' || substr(md5(o_orderkey || ':42'), 1, 13))::BIGINT) AS h, count(*) OVER () AS n FROM orders)
""")
def split_exact(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    train, test = hash_split(orders, key=["o_orderkey"], exact=True)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN n_chars END AS n_chars FROM documents)
SELECT doc_id, coalesce(CAST(n_chars AS DOUBLE), (SELECT median(n_chars) FROM d)) AS filled FROM d
""")
def impute_median(spark, sf_dir):
    """Every seventh length is made null, then filled."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("n_chars")).alias("n_chars"))
    imputer = MedianImputer(inputCols=["n_chars"], outputCols=["filled"])
    return imputer.fit(documents).transform(documents).select("doc_id", "filled")


@query("""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN source END AS source, CASE WHEN doc_id % 3 <> 0 THEN lang END AS lang FROM documents)
SELECT doc_id, coalesce(source, (SELECT source FROM d WHERE source IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 1)) AS source_filled,
       coalesce(lang, (SELECT lang FROM d WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)) AS lang_filled
FROM d
""")
def impute_mode(spark, sf_dir):
    """Every fifth source and every third language is made null, then filled."""
    doc = F.col("doc_id")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(doc % 5 != 0, F.col("source")).alias("source"), F.when(doc % 3 != 0, F.col("lang")).alias("lang")
    )
    imputer = ModeImputer(inputCols=["source", "lang"], outputCols=["source_filled", "lang_filled"])
    return imputer.fit(documents).transform(documents).select("doc_id", "source_filled", "lang_filled")


PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "SELECT p_partkey, "
    + ", ".join(f"CASE WHEN p_partkey % 11 <> 0 AND p_type = '{t}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_{t.lower()}" for t in PART_TYPES)
    + " FROM part"
)
def one_hot(spark, sf_dir):
    """Fitted on all types, then applied to rows of which every eleventh has an unknown type."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    index = CategoryIndexer(inputCols=["p_type"], outputCols=["index"])
    onehot = OneHotEncoder(inputCols=["index"], outputCols=["hot"], dropLast=True)
    fitted = Pipeline(stages=[index, onehot]).fit(parts)
    strange = parts.withColumn("p_type", F.when(F.col("p_partkey") % 11 == 0, "UNKNOWN").otherwise(F.col("p_type")))
    hot = fitted.transform(strange).withColumn("hot", vector_to_array("hot"))
    places = {r.value: r["index"] for r in fitted.stages[0].categories(spark).where(F.col("value").isin(PART_TYPES)).collect()}
    return hot.select("p_partkey", *[F.col("hot")[places[t]].alias(f"is_{t.lower()}") for t in PART_TYPES])


@query("""
WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_suppkey,
         CASE WHEN l_returnflag = 'A' THEN 'common' ELSE concat(l_orderkey, '-', l_linenumber, '-', l_partkey) END AS v, concat('s', l_suppkey) AS s FROM lineitem),
v AS (SELECT v, row_number() OVER (ORDER BY count(*) DESC, v) - 1 AS i FROM lines GROUP BY v),
s AS (SELECT s, row_number() OVER (ORDER BY count(*) DESC, s) - 1 AS j FROM lines GROUP BY s)
SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 11 = 0 THEN (SELECT count(*) FROM v) ELSE i END::DOUBLE AS line, j::DOUBLE AS supplier
FROM lines JOIN v USING (v) JOIN s USING (s)
""")
def many_categories(spark, sf_dir):
    """A column with a category for two of three rows, and one category with the others, numbered; then applied where a part is unseen."""
    line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "A", "common").otherwise(line).alias("v"), F.concat(F.lit("s"), "l_suppkey").alias("s"), "l_suppkey"
    )
    fitted = CategoryIndexer(inputCols=["v", "s"], outputCols=["line", "supplier"]).fit(lines)
    strange = lines.withColumn("v", F.when(F.col("l_suppkey") % 11 == 0, F.lit(None)).otherwise(F.col("v")))
    return fitted.transform(strange).select("l_orderkey", "l_linenumber", "line", "supplier")


@query("""
WITH s AS (SELECT avg(l_quantity) AS qa, stddev_pop(l_quantity) AS qs, avg(l_extendedprice) AS pa, stddev_pop(l_extendedprice) AS ps FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - qa) / qs, 4) AS quantity, round((l_extendedprice - pa) / ps, 4) AS price
FROM lineitem, s
""")
def standardize(spark, sf_dir):
    """Scaled columns through the feature vector and back."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    scaler = NumericScaler(inputCols=["l_quantity", "l_extendedprice"], outputCols=["q", "p"])
    assembler = VectorAssembler(inputCols=["q", "p"], outputCol="features")
    scaled = Pipeline(stages=[scaler, assembler]).fit(lines).transform(lines)
    parts = vector_to_array("features")
    return scaled.select(
        "l_orderkey", "l_linenumber", F.round(parts[0], 4).alias("quantity"), F.round(parts[1], 4).alias("price")
    )


@query("""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS p_size, p_retailprice,
                  CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS p_type FROM part),
m AS (SELECT median(p_size) AS size FROM p),
t AS (SELECT p_type AS top FROM p WHERE p_type IS NOT NULL GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1),
f AS (SELECT p_partkey, coalesce(p_size, size)::DOUBLE AS s, p_retailprice AS r, coalesce(p_type, top) AS k FROM p, m, t),
z AS (SELECT avg(s) AS sa, stddev_pop(s) AS ss, avg(r) AS ra, stddev_pop(r) AS rs FROM f),
n AS (SELECT k, count(*) AS freq FROM f GROUP BY k),
i AS (SELECT k, row_number() OVER (ORDER BY freq DESC, k) AS slot FROM n)
SELECT p_partkey, round((r - ra) / rs, 4) AS price, round((s - sa) / ss, 4) AS size, CAST(slot AS INTEGER) AS slot
FROM f JOIN i USING (k), z
""")
def preprocess(spark, sf_dir):
    """The whole preprocessor: impute, scale, encode, assemble. ``slot`` is the place of the one-hot 1."""
    key = F.col("p_partkey")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_retailprice",
        F.when(key % 7 != 0, F.col("p_size")).alias("p_size"), F.when(key % 5 != 0, F.col("p_type")).alias("p_type"),
    )
    numeric, text = feature_columns(parts, exclude=["p_partkey"])
    ready = build_preprocessor(numeric, text).fit(parts).transform(parts).withColumn("f", vector_to_array("features"))
    hot = F.slice("f", len(numeric) + 1, F.size("f") - len(numeric))
    return ready.select(
        "p_partkey", F.round(F.col("f")[0], 4).alias("price"), F.round(F.col("f")[1], 4).alias("size"),
        F.array_position(hot, 1.0).cast("int").alias("slot"),
    )


def _line(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


FITTED_LINE = """
SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 1) AS prediction
FROM lineitem, (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
"""


def _fitted_line(lines):
    vector = VectorAssembler(inputCols=["l_quantity"], outputCol="features")
    estimator = make_estimator("linear_regression", solver="normal")
    return vector, build_model(vector.transform(lines), estimator, "l_extendedprice")


@query(FITTED_LINE)
def linreg_single(spark, sf_dir):
    lines = _line(spark, sf_dir)
    vector, model = _fitted_line(lines)
    predicted = model.transform(vector.transform(lines))
    return predicted.select("l_orderkey", "l_linenumber", F.round("prediction", 1).alias("prediction"))


@query(FITTED_LINE)
def model_roundtrip(spark, sf_dir):
    """The same line, stored and loaded before scoring."""
    lines, path = _line(spark, sf_dir), scratch_dir(spark, "model")
    vector, model = _fitted_line(lines)
    save_model(model, path)
    predicted = load_model(path).transform(vector.transform(lines))
    return predicted.select("l_orderkey", "l_linenumber", F.round("prediction", 1).alias("prediction"))


def _counted(scored, *keys):
    """How many rows a model scored and how many predictions are numbers, by ``keys``."""
    good = F.count_if(F.col("predictions").isNotNull() & ~F.isnan("predictions"))
    return scored.groupBy(*keys).agg(F.count("*").alias("n"), good.alias("scored"))


@query(f"SELECT l_returnflag, count(*) AS n, count(*) AS scored FROM lineitem WHERE {BUCKET.format(key='l_orderkey')} GROUP BY 1")
def rf_regress(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_extendedprice"
    )
    train, test = hash_split(lines, key=["l_orderkey"])
    forest = make_estimator("random_forest_regressor", numTrees=20, maxDepth=5)
    model = train_model(train, forest, "l_extendedprice", exclude=["l_orderkey"])
    return _counted(score(test, model), "l_returnflag")


@query(f"""
SELECT CAST(event_type = 'purchase' AS DOUBLE) AS bought, count(*) AS n, count(*) AS scored FROM events
WHERE {BUCKET.format(key='event_id')} GROUP BY 1
""")
def rf_classify(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "value", (F.col("user_id") % 24).alias("cohort"), (F.col("event_type") == "purchase").cast("double").alias("bought")
    )
    train, test = hash_split(events, key=["event_id"])
    forest = make_estimator("random_forest_classifier", maxDepth=5)
    model = train_model(train, forest, "bought", exclude=["event_id"])
    return _counted(score(test, model), "bought")


def _price_rule():
    class PriceRule:
        def predict(self, frame):
            return 1000.0 * frame["l_quantity"] + 0.5 * frame["l_extendedprice"]

    return PriceRule()


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, 1000.0::DOUBLE * l_quantity + 0.5::DOUBLE * l_extendedprice AS predictions
FROM lineitem
""")
def score_udf(spark, sf_dir):
    return score_python_model(_line(spark, sf_dir), _price_rule())


def _errors_sql(y, p):
    e = f"({y} - {p})"
    return (
        f"round(avg(abs({e})), 4) AS mae, round(avg({e} * {e}), 2) AS mse, round(sqrt(avg({e} * {e})), 4) AS rmse, "
        f"round(1 - avg({e} * {e}) / var_pop({y}), 6) AS r2"
    )


def _errors(df):
    return [F.round("MAE", 4).alias("mae"), F.round("MSE", 2).alias("mse"), F.round("RMSE", 4).alias("rmse"), F.round("R2", 6).alias("r2")]


@query(f"SELECT {_errors_sql('l_extendedprice', '(2000 * l_quantity)')} FROM lineitem")
def errors_regression(spark, sf_dir):
    lines = _line(spark, sf_dir).withColumn("prediction", 2000 * F.col("l_quantity"))
    found = regression_metrics(lines, "l_extendedprice")
    return found.select(*_errors(found))


# A rule that guesses the kind of an event from its value.
RULE_SQL = "CASE WHEN value < 15 THEN 'view' WHEN value < 35 THEN 'click' WHEN value < 70 THEN 'error' ELSE 'purchase' END"


def _ruled(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", "value", F.expr(RULE_SQL).alias("prediction"))


@query("""
WITH e AS (SELECT length(event_type) AS y, CASE WHEN value < 35 THEN 5 ELSE 8 END AS p FROM events)
SELECT round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy, """ + _errors_sql("y", "p") + " FROM e")
def errors_classification(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    coded = events.select(F.length("event_type").alias("label"), F.when(F.col("value") < 35, 5).otherwise(8).alias("prediction"))
    found = classification_metrics(coded, "label")
    return found.select(F.round("Accuracy", 6).alias("accuracy"), *_errors(found))


@query("""
WITH e AS (SELECT event_type = 'click' AS y, value > 60 AS p FROM events),
c AS (SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS a, count(*) FILTER (y AND p) AS tp, count(*) FILTER (NOT y AND p) AS fp,
             count(*) FILTER (y AND NOT p) AS fn FROM e)
SELECT round(a, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c
""")
def errors_binary(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        (F.col("event_type") == "click").cast("int").alias("label"), (F.col("value") > 60).cast("int").alias("prediction")
    )
    found = binary_metrics(events, "label")
    return found.select(*[F.round(c, 6).alias(c.lower()) for c in ("Accuracy", "Precision", "Recall", "F1")])


@query(f"SELECT event_type AS label, {RULE_SQL} AS prediction, count(*) AS count FROM events GROUP BY 1, 2")
def confusion_matrix(spark, sf_dir):
    return confusion(_ruled(spark, sf_dir), "event_type")


@query(f"""
WITH e AS (SELECT event_type AS y, {RULE_SQL} AS p FROM events),
c AS (SELECT y AS class FROM e UNION SELECT p FROM e),
t AS (SELECT class, (SELECT count(*) FROM e WHERE y = class AND p = class) AS hits,
             (SELECT count(*) FROM e WHERE y = class) AS support, (SELECT count(*) FROM e WHERE p = class) AS predicted FROM c)
SELECT class, round(CASE WHEN predicted = 0 THEN 0.0 ELSE hits / predicted END, 6) AS precision,
       round(CASE WHEN support = 0 THEN 0.0 ELSE hits / support END, 6) AS recall,
       round(2 * hits / (support + predicted), 6) AS f1, support FROM t
""")
def class_quality(spark, sf_dir):
    report = class_report(_ruled(spark, sf_dir), "event_type")
    return report.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("""
WITH r AS (SELECT event_type = 'click' AS y, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS r FROM events),
s AS (SELECT sum(r) FILTER (y) AS rs, count(*) FILTER (y) AS p, count(*) FILTER (NOT y) AS n FROM r)
SELECT round((rs - p * (p + 1) / 2.0) / (p * n), 9) AS auc FROM s
""")
def auc(spark, sf_dir):
    events = table(spark, sf_dir, "events").select((F.col("event_type") == "click").cast("int").alias("label"), "value")
    return auc_roc(events, "label", "value").select(F.round("AUC", 9).alias("auc"))


LINE_TEST = BUCKET.format(key="(l_orderkey || chr(31) || l_linenumber)")
FITTED_TRAIN = f"""
WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, {LINE_TEST} AS test FROM lineitem),
m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM s WHERE NOT test)
"""


def _trained(spark, sf_dir):
    silver, models, runs = (scratch_dir(spark, n) for n in ("silver", "models", "runs"))
    _line(spark, sf_dir).write.parquet(silver)
    config = TrainConfig(
        source=silver, target_feature="l_extendedprice", experiment_name="price_", models=models, runs=runs,
        estimator="linear_regression", params={"solver": "normal"}, split_key=["l_orderkey", "l_linenumber"],
    )
    run_id, _ = train_job(spark, config)
    return silver, f"{models}/{run_id}", runs


@query(
    FITTED_TRAIN
    + """, e AS (SELECT l_extendedprice AS y, l_extendedprice - (a + b * l_quantity) AS e FROM s, m WHERE test)
SELECT 'price_' AS experiment, round(avg(abs(e)), 2) AS mae, round(sqrt(avg(e * e)), 2) AS rmse,
       round(1 - avg(e * e) / var_pop(y), 6) AS r2 FROM e"""
)
def train_run(spark, sf_dir):
    """The training job, seen through the run it recorded."""
    runs = read_runs(spark, _trained(spark, sf_dir)[2])
    return runs.select(
        "experiment",
        F.round(F.col("metrics")["MAE"], 2).alias("mae"),
        F.round(F.col("metrics")["RMSE"], 2).alias("rmse"),
        F.round(F.col("metrics")["R2"], 6).alias("r2"),
    )


@query(FITTED_TRAIN + "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, round(a + b * l_quantity, 1) AS predictions FROM s, m")
def inference_run(spark, sf_dir):
    """The inference job with the model of the training job, its output read back."""
    silver, model, _ = _trained(spark, sf_dir)
    gold = scratch_dir(spark, "gold")
    inference_job(spark, InferenceConfig(source=silver, destination=gold, model=model, destination_format="parquet"))
    scored = spark.read.parquet(gold)
    return scored.withColumn("predictions", F.round("predictions", 1))


@query("""
WITH p AS (SELECT p_partkey, p_size, p_retailprice, p_type FROM part),
n AS (SELECT avg(p_size) AS sa, stddev_samp(p_size) AS ss, avg(p_retailprice) AS ra, stddev_samp(p_retailprice) AS rs,
             avg((p_type = (SELECT p_type FROM p GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1))::INT) AS ta,
             stddev_samp((p_type = (SELECT p_type FROM p GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1))::INT) AS ts FROM p)
SELECT p_partkey, round((p_retailprice - ra) / rs, 4) AS price, round((p_size - sa) / ss, 4) AS size,
       round(((p_type = (SELECT p_type FROM p GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1))::INT - ta) / ts, 4) AS first
FROM p, n
""")
def scaled_vector(spark, sf_dir):
    """The preprocessor that standardises the whole vector, one-hot slots included; features and target named by ``split_target``."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    names, _ = split_target(parts, "p_partkey")
    numeric, text = feature_columns(parts.select(*names))
    ready = build_preprocessor(numeric, text, scope="all").fit(parts).transform(parts).withColumn("f", vector_to_array("features"))
    return ready.select("p_partkey", *[F.round(F.col("f")[i], 4).alias(c) for i, c in enumerate(("price", "size", "first"))])


# One tree of one split is a rule that SQL can find: the cut with the largest sum of squared totals by count on both sides.
ONE_SPLIT = {"numTrees": 1, "maxDepth": 1, "maxBins": 64, "bootstrap": False, "featureSubsetStrategy": "all"}
NOISY = "CASE WHEN l_quantity > 30 THEN l_linenumber <> 1 ELSE l_linenumber = 1 END"


def _one_split_sql(target):
    return f"""
WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, CAST({target} AS DOUBLE) AS y, {LINE_TEST} AS test FROM lineitem),
c AS (SELECT q, count(*) AS n, sum(y) AS t FROM s WHERE NOT test GROUP BY 1),
w AS (SELECT q, lead(q) OVER (ORDER BY q) AS above, sum(n) OVER (ORDER BY q) AS nl, sum(t) OVER (ORDER BY q) AS tl,
             sum(n) OVER () AS n, sum(t) OVER () AS t FROM c),
k AS (SELECT (q + above) / 2 AS cut, tl / nl AS low, (t - tl) / (n - nl) AS high FROM w WHERE above IS NOT NULL
      ORDER BY tl * tl / nl + (t - tl) * (t - tl) / (n - nl) DESC LIMIT 1),
p AS (SELECT l_orderkey, l_linenumber, y, CASE WHEN q <= cut THEN low ELSE high END AS p FROM s, k WHERE test)
"""


def _targets(spark, sf_dir, target):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", F.expr(target).cast("double").alias("y"))


def _split_once(spark, sf_dir, target, name):
    train, test = hash_split(_targets(spark, sf_dir, target), key=["l_orderkey", "l_linenumber"])
    return test, train_model(train, make_estimator(name, **ONE_SPLIT), "y", exclude=["l_orderkey", "l_linenumber"])


@query(_one_split_sql("l_extendedprice") + "SELECT l_orderkey, l_linenumber, round(p, 3) AS prediction FROM p")
def tree_regress(spark, sf_dir):
    test, model = _split_once(spark, sf_dir, "l_extendedprice", "random_forest_regressor")
    return score(test, model).select("l_orderkey", "l_linenumber", F.round("predictions", 3).alias("prediction"))


@query(_one_split_sql(NOISY) + "SELECT l_orderkey, l_linenumber, round(p, 6) AS score, CAST(p > 0.5 AS DOUBLE) AS prediction FROM p")
def tree_classify(spark, sf_dir):
    test, model = _split_once(spark, sf_dir, NOISY, "random_forest_classifier")
    scored = score(test, model, raw="score")
    return scored.select("l_orderkey", "l_linenumber", F.round("score", 6).alias("score"), F.col("predictions").alias("prediction"))


@query(
    _one_split_sql(NOISY)
    + """, r AS (SELECT y, p > 0.5 AS h, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM p),
a AS (SELECT count(*) AS n, sum(y) AS pos, count(*) FILTER (y = 1 AND h) AS tp, count(*) FILTER (y = 0 AND h) AS fp,
             count(*) FILTER (y = 1 AND NOT h) AS fn, sum(r) FILTER (y = 1) AS rs FROM r)
SELECT 'tree_' AS experiment, round((n - fp - fn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((rs - pos * (pos + 1) / 2) / (pos * (n - pos)), 6) AS auc FROM a"""
)
def train_classifier(spark, sf_dir):
    """The training job with a binary classifier, seen through the run it recorded."""
    silver, models, runs = (scratch_dir(spark, n) for n in ("silver", "models", "runs"))
    _targets(spark, sf_dir, NOISY).write.parquet(silver)
    config = TrainConfig(
        source=silver, target_feature="y", experiment_name="tree_", models=models, runs=runs,
        estimator="random_forest_classifier", params=ONE_SPLIT, split_key=["l_orderkey", "l_linenumber"],
    )
    train_job(spark, config)
    names = ("Accuracy", "Precision", "Recall", "F1", "AUC")
    return read_runs(spark, runs).select("experiment", *[F.round(F.col("metrics")[n], 6).alias(n.lower()) for n in names])
