"""Feature encoding, split, baseline, random forest and evaluation on ``spark.ml``.

Everything distributed stays in Spark: one multi-column ``StringIndexer`` pass,
``OneHotEncoder``/``VectorAssembler`` (metadata only), the forest fit, and all
metrics as aggregates over the confusion matrix (a classes x classes table).
Only model metadata (feature names, the trees' nodes) is read on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import lateral, present, qcol
from ..session import shared_path
from ..spec import FLIGHTS, LABEL, MAX_DEPTH, NUM_TREES, SEED, TRAIN_FRACTION, MovementSpec
from . import clean, forest

LABEL_COL = "label"
#: Bytes of training rows that one task of the forest's fit reads in a pass.
FIT_TASK_BYTES = 100_000_000


def ml_frame(df: DataFrame, spec: MovementSpec = FLIGHTS) -> DataFrame:
    """Rename dotted names, cast the int columns, add ``label`` (double, non-NULL), clean categoricals."""
    out = clean.rename_dotted(df, spec.rename_map)
    out = clean.cast_columns(out, spec.int_columns, "int")
    out = out.withColumn(LABEL_COL, F.col(LABEL).cast("double")).filter(F.col(LABEL_COL).isNotNull())
    return clean.clean_categoricals(out, spec.categorical_columns, spec.categorical_upper)


def feature_stages(df: DataFrame, spec: MovementSpec = FLIGHTS) -> tuple[list, list[str], list[str]]:
    """Indexer, encoder and assembler for the categoricals and numerics present in ``df``.

    Returns ``(stages, categorical_columns, assembler_inputs)``.
    """
    cats = present(df, spec.categorical_columns)
    nums = present(df, spec.numeric_columns)
    stages = []
    if cats:
        stages.append(StringIndexer(inputCols=cats, outputCols=[f"{c}_idx" for c in cats], handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_ohe" for c in cats],
                                    handleInvalid="keep"))
    inputs = nums + [f"{c}_ohe" for c in cats]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return stages, cats, inputs


def feature_pipeline(df: DataFrame, spec: MovementSpec = FLIGHTS) -> Pipeline:
    return Pipeline(stages=feature_stages(df, spec)[0])


def random_forest(num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, seed: int = SEED,
                  max_memory_mb: int = 1024) -> RandomForestClassifier:
    """The forest of the reference (100 trees, depth 10, seed 42).

    Node-id caching with periodic checkpoints suits deep trees; a larger
    per-iteration node-statistics budget (``max_memory_mb``) splits more nodes
    per pass over the data. Neither changes the fitted model (checked: equal
    predictions), only the number of passes.
    """
    return RandomForestClassifier(labelCol=LABEL_COL, featuresCol="features", predictionCol="prediction",
                                  probabilityCol="probability", rawPredictionCol="rawPrediction",
                                  numTrees=num_trees, maxDepth=max_depth, seed=seed,
                                  cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=max_memory_mb)


def model_pipeline(df: DataFrame, spec: MovementSpec = FLIGHTS, **forest) -> Pipeline:
    return Pipeline(stages=feature_stages(df, spec)[0] + [random_forest(**forest)])


def spread(df: DataFrame, rows_per_task: int) -> DataFrame:
    """``df`` in even parts of ``rows_per_task`` rows, if one of its own parts holds more; as it is otherwise.

    Parquet is split by its bytes, so a part of a narrow table holds more rows the larger the table is. Rows are dealt out in turn,
    so repeated rows and hot keys spread as well. Each part is sorted: computed again, it has the same rows in the same order, by
    which the forest draws their weights.
    """
    sizes = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    if (found["most"] or 0) <= rows_per_task:
        return df
    return df.repartition(math.ceil(found["rows"] / rows_per_task)).sortWithinPartitions(*[qcol(c) for c in df.columns])


def fit_model(train: DataFrame, spec: MovementSpec = FLIGHTS, **options) -> PipelineModel:
    """The fitted ``model_pipeline``, its forest from :func:`spread` rows.

    A pass over the rows reads each row's weight and its node in every tree (16 bytes a tree, as measured) and its bin in every
    slot of the vector (4 bytes).
    """
    encoders = feature_pipeline(train, spec).fit(train)
    trees = random_forest(**options)
    slots = len(feature_names(encoders, encoders.transform(train).schema))
    rows = max(1, FIT_TASK_BYTES // (16 * trees.getNumTrees() + 4 * slots))
    return PipelineModel(stages=[*encoders.stages, trees.fit(encoders.transform(spread(train, rows)))])


def hash_share(keys: Sequence[str], salt: str) -> Column:
    """A number from 0 to 9999 from the md5 of a salt and the key columns."""
    text = F.concat_ws("|", F.lit(salt), *[qcol(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 10_000


def rule_predictions(df: DataFrame, keys: Sequence[str], label: str = LABEL_COL) -> DataFrame:
    """A predictor without training, for the metric operators: a hash score that leans towards the label.

    ``score`` has ties; ``prediction`` is 1 where it is 0.5 or more.
    """
    score = (F.floor(hash_share(keys, "rule") / 25) + F.col(label) * 100) / 500
    return df.withColumn("score", score.cast("double")).withColumn("prediction", F.when(F.col("score") >= 0.5, 1.0).otherwise(0.0))


def split_key(keys: Sequence[str], seed: int = SEED) -> Column:
    """Bucket 0..99 from the md5 of the key columns (stable under repartitioning and retries)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[qcol(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100


def hash_split(df: DataFrame, keys: Sequence[str], train_fraction: float = TRAIN_FRACTION,
               seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split by key hash (same rows on every recomputation)."""
    cut = int(round(train_fraction * 100))
    b = split_key(keys, seed)
    return df.filter(b < cut), df.filter(b >= cut)


def with_split_flag(df: DataFrame, keys: Sequence[str], train_fraction: float = TRAIN_FRACTION,
                    seed: int = SEED) -> DataFrame:
    return df.withColumn("is_train", split_key(keys, seed) < int(round(train_fraction * 100)))


def majority_class(train: DataFrame, label: str = LABEL_COL) -> DataFrame:
    """One row: most frequent label and its count (ties: smaller label)."""
    return (train.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(label)).limit(1))


def baseline_predictions(train: DataFrame, test: DataFrame, label: str = LABEL_COL) -> DataFrame:
    """Test rows with ``prediction`` = the training majority label (a scalar subquery)."""
    majority = majority_class(train, label).select(label).scalar()
    return test.withColumn("prediction", majority)


def confusion(predictions: DataFrame, label: str = LABEL_COL, prediction: str = "prediction") -> DataFrame:
    """Counts per (label, prediction), ordered."""
    return (predictions.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(label, prediction))


def classification_metrics(predictions: DataFrame, label: str = LABEL_COL,
                           prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, weightedPrecision, weightedRecall, f1 (support-weighted, as spark.ml).

    Built from the confusion matrix, so the data is scanned once; the rest is
    arithmetic on a classes x classes table.
    """
    conf = predictions.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    support = conf.groupBy("l").agg(F.sum("n").alias("support"),
                                     F.sum(F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"))
    predicted = conf.groupBy(F.col("p").alias("l")).agg(F.sum("n").alias("predicted"))
    per = support.join(predicted, "l", "left").na.fill(0, ["predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.withColumns({"prec": prec, "rec": rec})
    f1 = F.when(F.col("prec") + F.col("rec") > 0,
                2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec"))).otherwise(F.lit(0.0))
    per = per.withColumn("f1", f1)
    total = F.sum("support")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("support") * F.col("prec")) / total).alias("weightedPrecision"),
        (F.sum(F.col("support") * F.col("rec")) / total).alias("weightedRecall"),
        (F.sum(F.col("support") * F.col("f1")) / total).alias("f1"))


def roc_auc(predictions: DataFrame, label: str = LABEL_COL, raw: str = "rawPrediction", ranges: int | None = None) -> DataFrame:
    """One row, ``roc_auc``: the exact area under ROC as a rank sum, lazily and without a global sort.

    Rows are counted by score first. The scores are cut into ``ranges`` (the shuffle partitions, by default) at approximate
    quantiles; within a range a window counts the negatives below each score, and a prefix sum over the ranges' totals, a
    row each, adds those of lower ranges. The cuts only decide where a score is counted, so the area is exact:
    the share of pairs of a positive and a negative row that the score orders rightly, ties counting half. 1 where there
    is only one class, as spark.ml has it. ``raw`` is a number, or a vector whose second place is the score.
    """
    ranges = ranges or int(predictions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = predictions.schema[raw].dataType.typeName() == "double"
    score = (F.col(raw) if plain else vector_to_array(F.col(raw))[1]).alias("score")
    positive = F.col("l") == 1
    counts = (predictions.select(F.col(label).alias("l"), score).groupBy("score")
              .agg(F.count_if(positive).alias("np"), F.count_if(~positive).alias("nn")))
    cuts = counts.agg(F.percentile_approx("score", [i / ranges for i in range(1, ranges)] or [0.5], 100 * ranges)).scalar()
    parts = (lateral(counts, {"cuts": F.coalesce(cuts, F.array().cast("array<double>"))})
             .withColumn("range", F.size(F.filter("cuts", lambda c: c <= F.col("score")))).drop("cuts"))
    totals = parts.groupBy("range").agg(F.sum("nn").alias("below_range"))
    lower = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    totals = totals.withColumn("below_range", F.coalesce(F.sum("below_range").over(lower), F.lit(0)))
    before = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = parts.withColumn("below", F.coalesce(F.sum("nn").over(before), F.lit(0))).join(totals, "range")
    big = "decimal(19,0)"
    twice = F.sum(F.col("np").cast(big) * (2 * (F.col("below") + F.col("below_range")) + F.col("nn")).cast(big)).cast("double")
    pairs = 2 * F.sum("np").cast("double") * F.sum("nn").cast("double")
    return ranked.agg(F.when(pairs > 0, twice / pairs).otherwise(1.0).alias("roc_auc"))


def feature_names(model: PipelineModel, transformed_schema, features: str = "features") -> list[str]:
    """Names of the assembled vector slots, from the ML attribute metadata."""
    meta = transformed_schema[features].metadata.get("ml_attr", {})
    slots = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            slots[a["idx"]] = a.get("name", str(a["idx"]))
    n = meta.get("num_attrs", len(slots))
    return [slots.get(i, f"f{i}") for i in range(n)]


def metrics_frame(train: DataFrame, test: DataFrame, train_pred: DataFrame, test_pred: DataFrame,
                  inputs: Sequence[str], raw: str = "rawPrediction") -> DataFrame:
    """(metric, value): split sizes, baseline, train and test metrics, AUC, and the features in order."""
    spark = train.sparkSession

    def value(frame, name, column):
        return frame.select(F.lit(name).alias("metric"), F.col(column).cast("double").alias("value"))

    rows = F.count(F.lit(1)).alias("value")
    test_m = classification_metrics(test_pred)
    parts = [value(train.agg(rows), "train_rows", "value"), value(test.agg(rows), "test_rows", "value"),
             value(majority_class(train), "majority_label", "label"),
             value(classification_metrics(baseline_predictions(train, test)), "baseline_accuracy", "accuracy"),
             value(classification_metrics(train_pred), "train_accuracy", "accuracy")]
    parts += [value(test_m, f"test_{name}", column) for name, column in (
        ("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("f1", "f1"))]
    parts.append(value(roc_auc(test_pred, raw=raw), "test_roc_auc", "roc_auc"))
    # The feature list comes from the pipeline's definition.
    out = spark.createDataFrame([(f"feature:{c}", float(i)) for i, c in enumerate(inputs)], "metric string, value double")
    for p in parts:
        out = out.unionByName(p)
    return out


def feature_importance(model: PipelineModel, transformed_schema, inputs: Sequence[str]) -> DataFrame:
    """(feature_group, importance): the forest's importances summed per assembler input column, from its node table."""
    return forest.grouped_importances(forest.node_table(model.stages[-1]), feature_names(model, transformed_schema), inputs)


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """(column, index): StringIndexer's codes (frequency, then value) of a column of any number of categories.

    The counts are sorted in ranges and written with their place in their range; a prefix sum over the ranges, one row
    each, makes places into codes. No list of categories comes to the driver. NULLs have no code.
    """
    spark = df.sparkSession
    counts = df.where(qcol(column).isNotNull()).groupBy(qcol(column).alias(column)).agg(F.count(F.lit(1)).alias("__n"))
    placed = counts.orderBy(F.desc("__n"), qcol(column)).select(qcol(column).alias(column), F.monotonically_increasing_id().alias("__at"))
    path = shared_path(spark, "category-codes")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path).select(
        qcol(column).alias(column), F.shiftright("__at", 33).alias("__range"), F.col("__at").bitwiseAND((1 << 33) - 1).alias("__place"))
    lower = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    ranges = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__size")).withColumn("__before", F.coalesce(F.sum("__size").over(lower), F.lit(0)))
    return placed.join(ranges, "__range").select(qcol(column).alias(column), (F.col("__before") + F.col("__place")).cast("double").alias("index"))


def with_frequency_index(df: DataFrame, column: str, output: str, codes: DataFrame | None = None) -> DataFrame:
    """``df`` with the codes of ``codes`` (its own by default) joined on; values without a code get the next one after all codes."""
    codes = codes if codes is not None else frequency_index(df, column)
    unseen = codes.agg(F.count(F.lit(1)).cast("double")).scalar()
    named = codes.select(qcol(column).alias("__value"), F.col("index").alias("__index"))
    return (df.join(named, qcol(column) == F.col("__value"), "left")
            .withColumn(output, F.coalesce(F.col("__index"), unseen)).drop("__value", "__index"))
