"""Registered ML queries (feature encoding, split, baseline, forest, metrics) and their oracles.

The forest-dependent keys share one fitted pipeline per (application, input
folder) instead of refitting per key. The training frame is cut from its
lineage with a reliable ``checkpoint()`` in the session's checkpoint folder, so
the many passes of the fit and a lost executor never replay preprocessing.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, forest, ml
from ..session import ensure_checkpoint_dir, shared_path
from ..sources.bindings import MOVEMENTS
from . import oracle as O
from .export import portable

M = MOVEMENTS
KEY = ("movement_id",)


_INPUT: dict = {}


def forget() -> None:
    """Drop what is kept for each folder (`registry.forget` calls it)."""
    for kept in (_INPUT, _FITTED, _ENCODED):
        kept.clear()


def ml_input(spark: SparkSession, base: str) -> DataFrame:
    """The model's columns of the preprocessed rows, written once as Parquet for each application and folder."""
    from .registry import _pp
    key = (spark.sparkContext.applicationId, base)
    if key not in _INPUT:
        frame = ml.ml_frame(clean.reduce_columns(_pp(spark, base), M.keep_columns), M)
        path = shared_path(spark, "ml-input")
        frame.write.parquet(path)
        _INPUT[key] = spark.read.schema(frame.schema).parquet(path)
    return _INPUT[key]


_FITTED: dict = {}


def fitted(spark: SparkSession, base: str) -> dict:
    """Train/test frames, fitted pipeline and predictions, built once per application and folder."""
    key = (spark.sparkContext.applicationId, base)
    if key not in _FITTED:
        ensure_checkpoint_dir(spark)
        train, test = ml.hash_split(ml_input(spark, base), KEY)
        model = ml.fit_model(train, M)
        _, cats, inputs = ml.feature_stages(train, M)
        _FITTED[key] = {"train": train, "test": test, "model": model, "inputs": inputs,
                        "train_pred": model.transform(train), "test_pred": model.transform(test)}
    return _FITTED[key]


_ENCODED: dict = {}


def _encoded(spark, base) -> DataFrame:
    """The encoded rows; the encoders are fitted once per application and folder."""
    df = ml_input(spark, base)
    key = (spark.sparkContext.applicationId, base)
    if key not in _ENCODED:
        _ENCODED[key] = ml.feature_pipeline(df, M).fit(df)
    return _ENCODED[key].transform(df)


def _rule(spark, base) -> tuple[DataFrame, DataFrame]:
    train, test = ml.hash_split(ml_input(spark, base), KEY)
    return ml.rule_predictions(train, KEY), ml.rule_predictions(test, KEY)


def string_index(spark, base):
    df = _encoded(spark, base)
    cats = [c for c in M.categorical_columns if c in df.columns]
    return df.select("movement_id", *[f"{c}_idx" for c in cats])


def one_hot(spark, base):
    df = _encoded(spark, base)
    cols = []
    for c in [c for c in M.categorical_columns if c in df.columns]:
        arr = vector_to_array(F.col(f"{c}_ohe"))
        cols += [F.size(arr).cast("long").alias(f"{c}_ohe_size"),
                 F.when(F.array_position(arr, 1.0) > 0, F.array_position(arr, 1.0) - 1).alias(f"{c}_ohe_hot")]
    return df.select("movement_id", *cols)


def features(spark, base):
    df = _encoded(spark, base)
    text = F.array_join(F.transform(vector_to_array(F.col("features")), lambda x: x.cast("string")), ",")
    return df.select("movement_id", "label", text.alias("features"))


def flat_encoded(spark, base):
    df = _encoded(spark, base)
    cats = [c for c in M.categorical_columns if c in df.columns]
    nums = [c for c in M.numeric_columns if c in df.columns]
    return df.select("movement_id", *nums, *[f"{c}_idx" for c in cats], "label")


def split_flags(spark, base):
    return ml.with_split_flag(ml_input(spark, base), KEY).select("movement_id", "is_train")


def majority(spark, base):
    train, _ = ml.hash_split(ml_input(spark, base), KEY)
    return ml.majority_class(train)


def baseline(spark, base):
    train, test = ml.hash_split(ml_input(spark, base), KEY)
    pred = ml.baseline_predictions(train, test)
    maj = ml.majority_class(train).select("label").scalar()
    return ml.classification_metrics(pred).select(maj.alias("majority_label"), "*")


def _scored(df: DataFrame) -> DataFrame:
    return df.select("movement_id", "label", "prediction", vector_to_array("probability")[1].alias("probability"))


def forest_predictions(spark, base):
    """The test rows with the forest's prediction and its probability of a peak."""
    return _scored(fitted(spark, base)["test_pred"])


def predictions_sample(spark, base, n: int = 10):
    return forest_predictions(spark, base).orderBy("movement_id").limit(n)


def forest_compiled(spark, base):
    """The same, from the trees compiled into a column expression; and how often spark.ml's own scores differ."""
    f = fitted(spark, base)
    encoded = f["test_pred"].drop("rawPrediction", "probability", "prediction")
    scored = forest.score(encoded, forest.node_table(f["model"].stages[-1]))
    return scored.select("movement_id", "label", "prediction", F.col("probability")[1].alias("probability"))


def forest_soundness(spark, base):
    """What holds for every forest: a class each, probabilities that sum to 1, and compiled trees that score as spark.ml does."""
    p = vector_to_array("probability")
    own = fitted(spark, base)["test_pred"].select("movement_id", "label", F.col("prediction").isin(0.0, 1.0).alias("is_class"), "prediction", p.alias("p"))
    compiled = forest_compiled(spark, base).select("movement_id", F.col("prediction").alias("again"), F.col("probability").alias("q"))
    return own.join(compiled, "movement_id").select(
        "movement_id", "label", "is_class", (F.abs(F.aggregate("p", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("sums_to_one"),
        ((F.col("prediction") == F.col("again")) & (F.abs(F.col("p")[1] - F.col("q")) < 1e-12)).alias("compiled_agrees"))


def forest_metrics(spark, base):
    f = fitted(spark, base)
    return (ml.classification_metrics(f["train_pred"]).select(F.lit("train").alias("split"), "*")
            .unionByName(ml.classification_metrics(f["test_pred"]).select(F.lit("test").alias("split"), "*")))


def forest_confusion(spark, base):
    return ml.confusion(fitted(spark, base)["test_pred"])


def forest_auc(spark, base):
    return ml.roc_auc(fitted(spark, base)["test_pred"]).select(F.lit("test").alias("split"), "roc_auc")


def forest_metrics_table(spark, base):
    """The whole metrics table of the forest, its importances with it."""
    f = fitted(spark, base)
    groups = ml.feature_importance(f["model"], f["test_pred"].schema, f["inputs"])
    table = ml.metrics_frame(f["train"], f["test"], f["train_pred"], f["test_pred"], f["inputs"])
    return table.unionByName(groups.select(F.concat(F.lit("importance:"), "feature_group").alias("metric"), F.col("importance").alias("value")))


def string_index_joined(spark, base):
    """The codes of ``ml_string_index`` from counted ranges joined back, for columns of any number of categories."""
    df = ml_input(spark, base)
    cats = [c for c in M.categorical_columns if c in df.columns]
    out = df
    for c in cats:
        out = ml.with_frequency_index(out, c, f"{c}_idx")
    return out.select("movement_id", *[f"{c}_idx" for c in cats])


def rule_metrics(spark, base):
    train, test = _rule(spark, base)
    return (ml.classification_metrics(train).select(F.lit("train").alias("split"), "*")
            .unionByName(ml.classification_metrics(test).select(F.lit("test").alias("split"), "*")))


def rule_auc(spark, base):
    _, test = _rule(spark, base)
    return ml.roc_auc(test, raw="score").select(F.lit("test").alias("split"), "roc_auc")


def rule_confusion(spark, base):
    return ml.confusion(_rule(spark, base)[1])


def metrics_table(spark, base):
    train, test = _rule(spark, base)
    _, _, inputs = ml.feature_stages(train, M)
    return ml.metrics_frame(train, test, train, test, inputs, raw="score")


def importance(spark, base):
    f = fitted(spark, base)
    return ml.feature_importance(f["model"], f["test_pred"].schema, f["inputs"])


def importance_soundness(spark, base):
    """Each feature group's importance is a share of 1 (of 0 for a forest that never splits, on rows of one label)."""
    groups = importance(spark, base)
    total = groups.agg(F.round(F.sum("importance"), 9).alias("total"))
    return groups.select("feature_group", F.col("importance").between(0.0, 1.0).alias("is_share"), total.scalar().alias("total"))


def model_roundtrip(spark, base):
    """Save the fitted pipeline to the shared folder, load it back, and compare both on the test rows."""
    f = fitted(spark, base)
    path = shared_path(spark, "rf-pipeline")
    f["model"].write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = f["test_pred"].select("movement_id", "prediction")
    b = loaded.transform(f["test"]).select("movement_id", F.col("prediction").alias("again"))
    return a.join(b, "movement_id").agg(F.count(F.lit(1)).alias("test_rows"), F.count_if(F.col("prediction") != F.col("again")).alias("different"))


def _p(fn):
    return lambda spark, base: portable(fn(spark, base))


QUERIES = {
    "ml_string_index": _p(string_index),
    "ml_one_hot": _p(one_hot),
    "ml_features": _p(features),
    "flat_encoded": _p(flat_encoded),
    "ml_hash_split": _p(split_flags),
    "ml_majority_class": _p(majority),
    "ml_baseline": _p(baseline),
    "ml_random_forest": _p(forest_predictions),
    "ml_classification_metrics": _p(rule_metrics),
    "ml_roc_auc": _p(rule_auc),
    "ml_feature_importance": _p(importance),
    "ml_predictions": _p(predictions_sample),
    "ml_confusion": _p(rule_confusion),
    "ml_metrics_table": _p(metrics_table),
    "ml_model_roundtrip": _p(model_roundtrip),
    "ml_string_index_joined": _p(string_index_joined),
    "ml_forest_compiled": _p(forest_compiled),
    "ml_forest_soundness": _p(forest_soundness),
    "ml_importance_soundness": _p(importance_soundness),
    "ml_forest_metrics": _p(forest_metrics),
    "ml_forest_confusion": _p(forest_confusion),
    "ml_forest_roc_auc": _p(forest_auc),
    "ml_forest_metrics_table": _p(forest_metrics_table),
}

# ---------------------------------------------------------------------------
# DuckDB oracles for the keys without a forest; the forest's own answers are held against spark.ml in tests.
# ---------------------------------------------------------------------------

_CATS = ("carrier", "status", "terminal", "destination")


def _u(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR length(trim({x})) = 0 THEN 'UNKNOWN' ELSE trim({x}) END"


ML_CTES = f""",
mf AS (SELECT movement_id, hour_of_day, day_of_week, is_weekend, isCargo_int,
              {_u("carrier_raw")} AS carrier, {_u("status")} AS status, upper({_u("terminal_raw")}) AS terminal,
              upper({_u("dest_raw")}) AS destination, CAST(peak_traffic_label AS DOUBLE) AS label
       FROM m WHERE peak_traffic_label IS NOT NULL),
""" + ",\n".join(
    f"""ix_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY cnt DESC, {c}) - 1 AS DOUBLE) AS {c}_idx,
                  COUNT(*) OVER () AS {c}_n
           FROM (SELECT {c}, COUNT(*) AS cnt FROM mf GROUP BY {c}))""" for c in _CATS) + """,
enc AS (SELECT * FROM mf """ + " ".join(f"JOIN ix_{c} USING ({c})" for c in _CATS) + """),
sp AS (SELECT *, ('0x' || left(md5('42|' || CAST(movement_id AS VARCHAR)), 8))::BIGINT % 100 < 70 AS is_train
       FROM mf),
maj AS (SELECT label, COUNT(*) AS count FROM sp WHERE is_train GROUP BY label ORDER BY count DESC, label LIMIT 1),
bp AS (SELECT label AS l, (SELECT label FROM maj) AS p FROM sp WHERE NOT is_train),
conf AS (SELECT l, p, COUNT(*) AS n FROM bp GROUP BY l, p),
sup AS (SELECT l, SUM(n) AS support, SUM(CASE WHEN l = p THEN n ELSE 0 END) AS tp FROM conf GROUP BY l),
pre AS (SELECT p AS l, SUM(n) AS predicted FROM conf GROUP BY p),
per AS (SELECT s.l, s.support, s.tp,
               CASE WHEN COALESCE(predicted, 0) > 0 THEN tp / predicted ELSE 0.0 END AS prec,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec
        FROM sup s LEFT JOIN pre USING (l))"""


def _w(body: str) -> str:
    return O.w("").rstrip() + ML_CTES + "\n" + body


# Metrics of any (l, p) predictions: counts by class, then weighted means.
def _metrics(source: str) -> str:
    return f"""(SELECT sum(tp) / sum(n) AS accuracy, sum(n * prec) / sum(n) AS "weightedPrecision", sum(tp) / sum(n) AS "weightedRecall",
   sum(n * CASE WHEN prec + tp / n > 0 THEN 2 * prec * (tp / n) / (prec + tp / n) ELSE 0 END) / sum(n) AS f1
 FROM (SELECT c.l, count(*) FILTER (x.l = c.l) AS n, count(*) FILTER (x.l = c.l AND x.p = c.l) AS tp,
              ifnull(count(*) FILTER (x.l = c.l AND x.p = c.l) / nullif(count(*) FILTER (x.p = c.l), 0), 0) AS prec
       FROM (SELECT DISTINCT l FROM ({source})) c, ({source}) x GROUP BY c.l))"""


RULE = """(SELECT movement_id, label AS l, is_train, (floor((('0x' || left(md5('rule|' || CAST(movement_id AS VARCHAR)), 8))::BIGINT % 10000) / 25)
   + label * 100) / 500 AS score FROM sp)"""
RULE_TEST, RULE_TRAIN = (f"SELECT l, CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END AS p, score FROM {RULE} WHERE {x}is_train" for x in ("NOT ", ""))
#: Share of the pairs of a positive and a negative row that the score orders rightly, ties counting half.
#: (1 where there is only one class, as spark.ml has it.)
AUC = f"""(SELECT CASE WHEN sum(np) * sum(nn) > 0 THEN sum(np * (below + nn / 2)) / (sum(np) * sum(nn)) ELSE 1 END AS roc_auc
 FROM (SELECT score, np, nn, sum(nn) OVER (ORDER BY score) - nn AS below
       FROM (SELECT score, count(*) FILTER (l = 1) AS np, count(*) FILTER (l = 0) AS nn FROM ({RULE_TEST}) GROUP BY score)))"""
NUMERIC = ("hour_of_day", "day_of_week", "is_weekend", "isCargo_int")
INPUTS = [*NUMERIC, *(f"{c}_ohe" for c in _CATS)]


def _metric(name: str, value: str, source: str) -> str:
    return f"SELECT '{name}' AS metric, CAST({value} AS DOUBLE) AS value FROM {source}"


METRICS_TABLE = " UNION ALL ".join([
    _metric("train_rows", "count(*)", "sp WHERE is_train"), _metric("test_rows", "count(*)", "sp WHERE NOT is_train"),
    _metric("majority_label", "label", "maj"),
    _metric("baseline_accuracy", "avg(CASE WHEN l = p THEN 1 ELSE 0 END)", "bp"),
    _metric("train_accuracy", "accuracy", _metrics(RULE_TRAIN)),
    *(_metric(f"test_{n}", f'"{c}"', _metrics(RULE_TEST)) for n, c in (
        ("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("f1", "f1"))),
    _metric("test_roc_auc", "roc_auc", AUC),
    *(f"SELECT 'feature:{c}', CAST({i} AS DOUBLE)" for i, c in enumerate(INPUTS)),
])


def _onehot_list(c: str) -> str:
    return f"list_transform(range({c}_n + 1), lambda i: CASE WHEN i = CAST({c}_idx AS BIGINT) THEN 1.0 ELSE 0.0 END)"


ORACLE = {
    "ml_string_index": _w("SELECT movement_id, " + ", ".join(f"{c}_idx" for c in _CATS) + " FROM enc"),
    "ml_one_hot": _w("SELECT movement_id, " + ", ".join(
        f"{c}_n + 1 AS {c}_ohe_size, CAST({c}_idx AS BIGINT) AS {c}_ohe_hot" for c in _CATS) + " FROM enc"),
    "ml_features": _w(
        "SELECT movement_id, label, array_to_string([CAST(hour_of_day AS DOUBLE), "
        "CAST(day_of_week AS DOUBLE), CAST(is_weekend AS DOUBLE), CAST(isCargo_int AS DOUBLE)] || "
        + " || ".join(_onehot_list(c) for c in _CATS) + ", ',') AS features FROM enc"),
    "flat_encoded": _w("SELECT movement_id, hour_of_day, day_of_week, is_weekend, isCargo_int, "
                       + ", ".join(f"{c}_idx" for c in _CATS) + ", label FROM enc"),
    "ml_hash_split": _w("SELECT movement_id, is_train FROM sp"),
    "ml_majority_class": _w("SELECT label, count FROM maj"),
    "ml_baseline": _w("""SELECT (SELECT label FROM maj) AS majority_label,
       SUM(tp) / SUM(support) AS accuracy,
       SUM(support * prec) / SUM(support) AS weightedPrecision,
       SUM(support * rec) / SUM(support) AS weightedRecall,
       SUM(support * CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END) / SUM(support) AS f1
FROM per"""),
    "ml_classification_metrics": _w(f"SELECT 'train' AS split, * FROM {_metrics(RULE_TRAIN)} UNION ALL SELECT 'test', * FROM {_metrics(RULE_TEST)}"),
    "ml_confusion": _w(f"SELECT l AS label, CAST(p AS DOUBLE) AS prediction, count(*) AS count FROM ({RULE_TEST}) GROUP BY ALL"),
    "ml_roc_auc": _w(f"SELECT 'test' AS split, * FROM {AUC}"),
    "ml_metrics_table": _w(METRICS_TABLE),
    "ml_string_index_joined": _w("SELECT movement_id, " + ", ".join(f"{c}_idx" for c in _CATS) + " FROM enc"),
    # SQL has no forest: its own keys have no oracle; these say what holds for every forest.
    "ml_forest_soundness": _w("SELECT movement_id, label, true AS is_class, true AS sums_to_one, true AS compiled_agrees FROM sp WHERE NOT is_train"),
    "ml_importance_soundness": _w(f"SELECT unnest({INPUTS!r}) AS feature_group, true AS is_share, "
                                "(SELECT CAST(count(DISTINCT label) > 1 AS DOUBLE) FROM sp WHERE is_train) AS total"),
    "ml_model_roundtrip": _w("SELECT count(*) AS test_rows, CAST(0 AS BIGINT) AS different FROM sp WHERE NOT is_train"),
}
