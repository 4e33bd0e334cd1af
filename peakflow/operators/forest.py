"""A fitted random forest as data: its nodes as a table, its scores as a column expression, its importances as a query.

The node table has a row per node, so its size is bounded by the forest's own parameters (trees x 2^(depth + 1)).
Importances are summed from it in Spark. Scores come from one expression over arrays of the nodes: every tree is
walked from its root by an ``aggregate`` of as many steps as the forest is deep, and the shares of the leaves are added up. (CASE
branches nested as deep as 100 trees of 2,000 nodes would be far over what one generated method can hold.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import lateral, literal_array
from ..session import shared_path


def node_table(model: RandomForestClassificationModel) -> DataFrame:
    """(tree, node, feature, threshold, categories, left, right, gain, stats) of a fitted forest, from its saved form.

    ``left`` and ``right`` are -1 at leaves; a split on a categorical feature has ``categories`` (the values that go left)
    instead of a threshold; ``stats`` are the weighted training rows of each class.
    """
    session = SparkSession.active()
    path = shared_path(session, "forest")
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    categorical = n["split"]["numCategories"] > -1
    inner = n["leftChild"] >= 0
    values = n["split"]["leftCategoriesOrThreshold"]
    return session.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.when(inner & ~categorical, F.get(values, F.lit(0))).alias("threshold"), F.when(inner & categorical, values).alias("categories"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["gain"].alias("gain"), n["impurityStats"].alias("stats"))


def score(df: DataFrame, nodes: DataFrame, features: str = "features", probability_col: str = "probability", prediction_col: str = "prediction") -> DataFrame:
    """``df`` with each row's class probabilities (an array) and prediction, as the forest of ``nodes`` gives them.

    A tree's vote is the shares of the classes in the row's leaf; probabilities are the votes over their sum,
    and the first class of the most votes is predicted.
    """
    rows = sorted(nodes.collect(), key=lambda r: (r["tree"], r["node"]))  # bounded by the forest's parameters
    first: dict[int, int] = {}
    for i, r in enumerate(rows):
        first.setdefault(r["tree"], i)
    place = {(r["tree"], r["node"]): i for i, r in enumerate(rows)}
    child = [[place[r["tree"], r[side]] if r[side] >= 0 else -1 for r in rows] for side in ("left", "right")]
    level = [0] * len(rows)
    for i, (a, b) in enumerate(zip(*child, strict=True)):  # children come after their parent
        if a >= 0:
            level[a] = level[b] = level[i] + 1
    left, right = (literal_array(c, "int") for c in child)
    feature = literal_array([r["feature"] for r in rows], "int")
    threshold = literal_array([repr(r["threshold"]) if r["threshold"] is not None else 0 for r in rows], "double")
    sizes = [len(r["categories"] or ()) for r in rows]
    starts = [sum_ + 1 for sum_ in _running(sizes)]
    categories = literal_array([repr(v) for r in rows for v in r["categories"] or ()] or [0], "double")
    start, size = literal_array(starts, "int"), literal_array(sizes, "int")
    classes = len(rows[0]["stats"])
    shares = [literal_array([repr(r["stats"][c] / sum(r["stats"]) if sum(r["stats"]) else 0.0) for r in rows], "double") for c in range(classes)]

    def step(n: Column) -> Column:
        x = F.get(F.col("__x"), F.get(feature, n))
        goes_left = F.when(F.get(size, n) > 0, F.array_contains(F.slice(categories, F.get(start, n), F.get(size, n)), x)).otherwise(x <= F.get(threshold, n))
        return F.when(F.get(left, n) < 0, n).when(goes_left, F.get(left, n)).otherwise(F.get(right, n))

    steps = F.sequence(F.lit(1), F.lit(max(1, max(level))))
    leaves = F.transform(literal_array(first.values(), "int"), lambda root: F.aggregate(steps, root, lambda n, _: step(n)))
    walked = lateral(lateral(df, {"__x": vector_to_array(F.col(features))}), {"__leaves": leaves})

    def votes(share: Column) -> Column:
        return F.aggregate("__leaves", F.lit(0.0), lambda s, n: s + F.get(share, n))

    voted = lateral(walked, {"__votes": F.array(*map(votes, shares))})
    total = F.aggregate("__votes", F.lit(0.0), lambda s, v: s + v)
    out = {probability_col: F.transform("__votes", lambda v: v / total), prediction_col: (F.array_position("__votes", F.array_max("__votes")) - 1).cast("double")}
    return voted.withColumns(out).drop("__x", "__leaves", "__votes")


def _running(sizes: Sequence[int]) -> list[int]:
    out, total = [], 0
    for n in sizes:
        out.append(total)
        total += n
    return out


def importances(nodes: DataFrame) -> DataFrame:
    """(feature, importance): each tree's impurity gains (weighted by rows) as shares of their sum, summed over trees, as shares again."""
    gains = (nodes.where("left >= 0").groupBy("tree", "feature")
             .agg(F.sum(F.col("gain") * F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)).alias("gain")))
    trees = gains.groupBy("tree").agg(F.sum("gain").alias("of_tree")).where("of_tree <> 0")
    summed = gains.join(trees, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("of_tree")).alias("gain"))
    return summed.select("feature", (F.col("gain") / summed.agg(F.sum("gain")).scalar()).alias("importance"))


def grouped_importances(nodes: DataFrame, slots: Sequence[str], inputs: Sequence[str]) -> DataFrame:
    """(feature_group, importance) of every assembler input, highest first; ``slots`` names the places of the feature vector.

    A forest that never splits gives 0 for all.
    """
    spark = nodes.sparkSession
    by_length = sorted(inputs, key=len, reverse=True)
    groups = [next((g for g in by_length if name == g or name.startswith(g + "_")), name) for name in slots]
    named = spark.createDataFrame(list(enumerate(groups)), "feature int, feature_group string")  # the vector's metadata
    return (named.join(importances(nodes), "feature", "left").groupBy("feature_group")
            .agg(F.sum(F.coalesce("importance", F.lit(0.0))).alias("importance"))
            .orderBy(F.col("importance").desc(), "feature_group"))
