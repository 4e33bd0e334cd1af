from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from peakflow.operators import ml
from peakflow.spec import MovementSpec


def test_one_hot_width(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "c string")
    si = StringIndexer(inputCols=["c"], outputCols=["ci"], handleInvalid="keep").fit(df)
    enc = OneHotEncoder(inputCols=["ci"], outputCols=["co"], handleInvalid="keep").fit(si.transform(df))
    assert enc.transform(si.transform(df)).first()["co"].size == 4


def test_string_index_order_and_unseen(spark):
    spec = MovementSpec(categorical_columns=("c",), numeric_columns=("n",))
    train = spark.createDataFrame([("b", 1), ("a", 1), ("b", 2), ("c", 3), ("a", 0)], "c string, n int")
    test = spark.createDataFrame([("zzz", 5)], "c string, n int")
    model = ml.feature_pipeline(train, spec).fit(train)
    idx = {r["c"]: r["c_idx"] for r in model.transform(train).select("c", "c_idx").distinct().collect()}
    assert idx == {"a": 0.0, "b": 1.0, "c": 2.0}  # frequency desc, ties alphabetical
    row = model.transform(test).first()
    assert row["c_idx"] == 3.0 and row["features"].size == 1 + 4


def test_metrics_match_evaluator(spark):
    rows = [(1.0, 1.0)] * 5 + [(1.0, 0.0)] * 2 + [(0.0, 0.0)] * 4 + [(0.0, 1.0)] * 3 + [(2.0, 1.0)] * 1
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = ml.classification_metrics(df).collect()[0].asDict()
    for name in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert abs(got[name] - ev.evaluate(df)) < 1e-12, name


def test_auc_matches_rank_sum(spark):
    import random
    rnd = random.Random(1)
    rows = [(float(rnd.random() < 0.4), round(rnd.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, s double").withColumn(
        "rawPrediction", F.expr("array(-s, s)"))
    from pyspark.ml.functions import array_to_vector
    df = df.withColumn("rawPrediction", array_to_vector("rawPrediction"))
    auc = ml.roc_auc(df).first()[0]
    assert ml.roc_auc(df, ranges=1).first()[0] == ml.roc_auc(df, ranges=50).first()[0] == auc
    ranked = spark.sql("SELECT label, rank() OVER (ORDER BY s) AS r, COUNT(*) OVER (PARTITION BY s) AS c FROM {d}",
                       d=df).selectExpr("label", "r + (c - 1) / 2.0 AS ar")
    agg = ranked.agg(F.sum(F.when(F.col("label") == 1, F.col("ar"))).alias("rs"),
                     F.sum("label").alias("p"), F.count("*").alias("n")).collect()[0]
    p, n = agg["p"], agg["n"] - agg["p"]
    expected = (float(agg["rs"]) - p * (p + 1) / 2) / (p * n)
    assert abs(auc - expected) < 1e-9


def test_hash_split_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "movement_id")
    a, _ = ml.hash_split(df, ["movement_id"])
    b, _ = ml.hash_split(df.repartition(5), ["movement_id"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert 1300 < a.count() < 1500


def test_majority_and_baseline(spark):
    train = spark.createDataFrame([(1.0,), (1.0,), (0.0,)], "label double")
    test = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], "label double")
    assert ml.majority_class(train).collect()[0]["label"] == 1.0
    m = ml.classification_metrics(ml.baseline_predictions(train, test)).collect()[0]
    assert m["accuracy"] == 0.25


def test_forest_beats_baseline_and_recall_is_accuracy(spark):
    from peakflow.plans.ml_queries import fitted
    from conftest import SF_MID
    f = fitted(spark, SF_MID)
    m = {r["metric"]: r["value"] for r in ml.metrics_frame(f["train"], f["test"], f["train_pred"], f["test_pred"], f["inputs"]).collect()}
    assert m["test_accuracy"] > m["baseline_accuracy"]
    assert abs(m["test_weighted_recall"] - m["test_accuracy"]) < 1e-12
    assert 0.5 < m["test_roc_auc"] <= 1.0
    assert m["train_rows"] + m["test_rows"] == 9800
    assert [m[f"feature:{c}"] for c in f["inputs"]] == [float(i) for i in range(len(f["inputs"]))]


def test_auc_matches_the_evaluator_and_builds_lazily(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = spark.range(3000).select((F.col("id") % 3 == 0).cast("double").alias("label"), (F.rand(1) + F.when(F.col("id") % 3 == 0, 0.3).otherwise(0)).alias("score"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert abs(ml.roc_auc(df, raw="score").first()[0] - ev.evaluate(df)) < 1e-12
    fails = df.withColumn("score", F.raise_error(F.lit("ran")).cast("double"))
    ml.roc_auc(fails, raw="score")  # no action while the plan is built
    assert ml.roc_auc(df.limit(0), raw="score").first()[0] == 1.0
    assert ml.roc_auc(df.where("label = 1"), raw="score").first()[0] == 1.0


def test_compiled_forest_and_importances_equal_the_model(spark):
    from conftest import SF_MID
    from peakflow.operators import forest
    from peakflow.plans.ml_queries import M, fitted
    f = fitted(spark, SF_MID)
    model, names = f["model"].stages[-1], ml.feature_names(f["model"], f["test_pred"].schema)
    nodes = forest.node_table(model)
    want = f["test_pred"].select("movement_id", "prediction", ml.vector_to_array("probability").alias("p"))
    got = forest.score(f["test_pred"].drop("prediction", "probability"), nodes).select("movement_id", F.col("prediction").alias("again"), F.col("probability").alias("q"))
    both = want.join(got, "movement_id").collect()
    assert len(both) == f["test"].count() and len({r.prediction for r in both}) == 2
    assert all(r.prediction == r.again and max(abs(a - b) for a, b in zip(r.p, r.q, strict=True)) < 1e-12 for r in both)
    own = model.featureImportances.toArray()
    found = {r.feature: r.importance for r in forest.importances(nodes).collect()}
    assert max(abs(found.get(i, 0.0) - v) for i, v in enumerate(own)) < 1e-9 and own.max() > 0
    groups = {r.feature_group: r.importance for r in ml.feature_importance(f["model"], f["test_pred"].schema, f["inputs"]).collect()}
    assert set(groups) == set(f["inputs"]) and abs(sum(groups.values()) - 1) < 1e-9
    assert abs(groups["carrier_ohe"] - sum(v for v, n in zip(own, names, strict=True) if n.startswith("carrier_ohe"))) < 1e-9 and M.carrier


def test_compiled_forest_with_thresholds_categories_and_three_classes(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    from peakflow.operators import forest
    df = spark.range(600).select((F.col("id") % 7).cast("double").alias("a"), F.rand(3).alias("b"), F.randn(4).alias("c"))
    df = df.withColumn("label", F.when((F.col("a") % 3 == 1) & (F.col("b") > 0.4), 2.0).when(F.col("c") > 0.2, 1.0).otherwise(0.0))
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="raw").transform(df)
    df = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=10).fit(df).transform(df).cache()
    model = RandomForestClassifier(numTrees=7, maxDepth=5, seed=1).fit(df)
    nodes = forest.node_table(model)
    assert {r[0] for r in nodes.where("left >= 0").select(F.col("categories").isNull()).distinct().collect()} == {True, False}
    want = model.transform(df).select("raw", "prediction", ml.vector_to_array("probability").alias("p")).collect()
    got = forest.score(df, nodes).select("raw", "prediction", "probability").collect()
    assert all(a.raw == b.raw and a.prediction == b.prediction and max(abs(x - y) for x, y in zip(a.p, b.probability, strict=True)) < 1e-12
               for a, b in zip(want, got, strict=True))


def test_frequency_index_equals_string_indexer_without_a_list(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 50 == 0, None).otherwise(F.concat(F.lit("v"), (F.col("id") * F.col("id") % 977).cast("string"))).alias("a.b"))
    want = StringIndexer(inputCol="v", outputCol="i", handleInvalid="skip").fit(df.select(F.col("`a.b`").alias("v")))
    codes = ml.frequency_index(df, "a.b")
    assert {r[0]: r[1] for r in codes.collect()} == {v: float(i) for i, v in enumerate(want.labelsArray[0])}
    new = spark.createDataFrame([("v1",), ("nothing",), (None,)], "`a.b` string")
    out = {r[0]: r["i"] for r in ml.with_frequency_index(new, "a.b", "i", codes).collect()}
    n = float(len(want.labelsArray[0]))
    assert out["nothing"] == n and out[None] == n and out["v1"] < n


def test_forest_keys_agree_with_the_metrics_of_their_rows(spark):
    from conftest import SF_MID
    from peakflow.plans.ml_queries import QUERIES
    rows = QUERIES["ml_random_forest"](spark, SF_MID).collect()
    confusion = {(r.label, r.prediction): r["count"] for r in QUERIES["ml_forest_confusion"](spark, SF_MID).collect()}
    for key, n in confusion.items():
        assert n == sum((r.label, r.prediction) == key for r in rows)
    accuracy = {r.split: r.accuracy for r in QUERIES["ml_forest_metrics"](spark, SF_MID).collect()}["test"]
    assert abs(accuracy - sum(r.label == r.prediction for r in rows) / len(rows)) < 1e-12
    pos, neg = ([r.probability for r in rows if r.label == x] for x in (1, 0))
    auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(QUERIES["ml_forest_roc_auc"](spark, SF_MID).first().roc_auc - auc) < 1e-6  # by raw votes: rounding parts some ties
    table = {r.metric: r.value for r in QUERIES["ml_forest_metrics_table"](spark, SF_MID).collect()}
    assert abs(table["test_accuracy"] - accuracy) < 1e-12 and abs(sum(v for k, v in table.items() if k.startswith("importance:")) - 1) < 1e-9
    sample = QUERIES["ml_predictions"](spark, SF_MID).collect()
    assert len(sample) == 10 and set(sample) <= set(rows)


def test_the_fit_reads_even_parts_however_few_files_hold_the_rows(spark, tmp_path, monkeypatch):
    from datetime import datetime, timedelta
    from pyspark.ml.classification import RandomForestClassifier
    from peakflow.plans.ml_queries import QUERIES
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=7 * i), i % 300, "view", 1.0, "{}") for i in range(2000)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    seen, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, params=None: seen.append(df) or fit(self, df, params))
    monkeypatch.setattr(ml, "FIT_TASK_BYTES", 200_000, raising=False)  # about 100 rows
    confusion = QUERIES["ml_forest_confusion"](spark, str(tmp_path)).collect()
    sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    flags = {r.is_train: r["count"] for r in QUERIES["ml_hash_split"](spark, str(tmp_path)).groupBy("is_train").count().collect()}
    assert sum(sizes) == flags[True] and max(sizes) <= 130  # every training row, in small parts
    assert sum(r["count"] for r in confusion) == flags[False]


def test_spread_leaves_small_parts_and_deals_out_repeated_rows(spark):
    df = spark.range(1000, numPartitions=4)
    assert ml.spread(df, 250) is df and ml.spread(df.limit(0), 1).count() == 0
    same = spark.range(1000, numPartitions=1).select(F.lit(7).alias("a.b"), F.lit(None).cast("string").alias("c"))
    parts = ml.spread(same, 100)
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) <= 110
