"""The reference's six programs as Spark jobs over any movement table.

``run_all`` preprocesses once, writes the result as a Parquet table in the
output folder (cutting lineage: every later report reads that table with
column pruning instead of replaying the parse and dedupe), then runs the
reduction, transformation, traffic, SQL and ML programs against it. All
outputs are written in parallel; nothing is collected to the driver except
model metadata.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import qcol
from ..operators import clean, label, ml, quality, traffic
from ..session import ensure_checkpoint_dir
from ..sources import sinks
from ..spec import FLIGHTS, MovementSpec
from . import preprocess as pre
from . import sql_queries as Q


def _out(out_dir: str, name: str) -> str:
    return out_dir.rstrip("/") + "/" + name


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` (a shared folder) and read it back."""
    sinks.write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def run_preprocessing(raw: DataFrame, out_dir: str, spec: MovementSpec = FLIGHTS) -> DataFrame:
    """Clean + label; writes the table, the quoted CSV and the quality reports. Returns the table."""
    pp = materialize(pre.preprocess(raw, spec), _out(out_dir, "preprocessed.parquet"))
    sinks.write_quoted_csv(pp, _out(out_dir, "preprocessed_dataset_csv"))
    # One pass over the raw table for the raw missing values and the raw,
    # unparsed, invalid-format and pre-dedupe row counts, written once so five
    # reports read one row.
    summary = pre.cleaning_summary(raw, spec)
    summary.frame = materialize(summary.frame, _out(out_dir, "reports/cleaning_summary.parquet"))
    rep = pre.reports(raw, spec, pp, summary)
    for name, frame in vars(rep).items():
        sinks.write_csv(frame, _out(out_dir, f"reports/{name}"))
    return pp


def run_reduction(pp: DataFrame, out_dir: str, spec: MovementSpec = FLIGHTS) -> DataFrame:
    reduced = clean.reduce_columns(pp, spec.keep_columns)
    sinks.write_parquet(reduced, _out(out_dir, "reduced_dataset.parquet"))
    sinks.write_csv(reduced, _out(out_dir, "reduced_dataset_csv"))
    sinks.write_csv(quality.volume_report(pp, reduced), _out(out_dir, "reports/reduction_volume"))
    return reduced


def run_transformation(pp: DataFrame, out_dir: str, spec: MovementSpec = FLIGHTS) -> DataFrame:
    """Encode features on all rows; writes (label, features), the flat CSV and the fitted pipeline."""
    frame = ml.ml_frame(pp, spec)
    model = ml.feature_pipeline(frame, spec).fit(frame)
    encoded = model.transform(frame)
    sinks.write_parquet(encoded.select("label", "features"), _out(out_dir, "transformed_dataset.parquet"))
    _, cats, _ = ml.feature_stages(frame, spec)
    nums = [c for c in spec.numeric_columns if c in frame.columns]
    sinks.write_csv(encoded.select(*nums, *[f"{c}_idx" for c in cats], "label"),
                    _out(out_dir, "transformed_dataset_csv"))
    sinks.save_model(model, _out(out_dir, "models/transformation_pipeline"))
    sinks.write_csv(quality.volume_report(pp, encoded), _out(out_dir, "reports/transformation_volume"))
    return encoded


def traffic_reports(pp: DataFrame, spec: MovementSpec = FLIGHTS) -> dict[str, DataFrame]:
    """The keyed-count questions of the RDD program."""
    return {
        "rows_total": traffic.rows_total(pp),
        "hourly_counts": traffic.hourly_counts(pp),
        "first_hour": traffic.first_hour(pp),
        "hourly_total": traffic.hourly_total(pp),
        "weekend_counts": traffic.weekend_counts(pp),
        "peak_counts": label.label_distribution(pp),
        "top_carriers": traffic.top_carriers(pp, spec),
        "top_destinations": traffic.top_destinations(pp, spec),
        "status_distribution": traffic.status_distribution(pp, spec),
        "carrier_by_label": traffic.carrier_by_label(pp, spec),
        "destination_by_label": traffic.destination_by_label(pp, spec),
        "route_count": traffic.route_count(pp, spec),
        "route_sample": traffic.distinct_routes(pp, spec, sample=10),
        "top_routes": traffic.top_routes(pp, spec),
        "cargo_counts": traffic.cargo_counts(pp),
        "avg_by_daytype": traffic.avg_by_daytype(pp),
    }


def run_traffic(pp: DataFrame, out_dir: str, spec: MovementSpec = FLIGHTS) -> None:
    for name, frame in traffic_reports(pp, spec).items():
        sinks.write_csv(frame, _out(out_dir, f"traffic/{name}"))


def run_sql(pp: DataFrame, out_dir: str, spec: MovementSpec = FLIGHTS) -> None:
    sinks.write_long_form(Q.answers(pp, spec), _out(out_dir, "sql_results_csv"))


def run_ml(pp: DataFrame, out_dir: str, spec: MovementSpec = FLIGHTS,
           split_keys: list[str] | None = None) -> DataFrame:
    """Split, baseline, forest, metrics, confusion, importances, saved model. Returns the metrics table."""
    spark = pp.sparkSession
    ensure_checkpoint_dir(spark)
    # The fit passes over its input many times: write the model's columns and the split's key once.
    keys = list(split_keys or [c for c in spec.keep_columns if c in pp.columns])
    columns = list(dict.fromkeys([c for c in (*spec.keep_columns, *keys) if c in pp.columns]))
    data = materialize(ml.ml_frame(pp.select(*[qcol(c) for c in columns]), spec), _out(out_dir, "ml_input.parquet"))
    renamed = dict(spec.rename_map)
    keys = [renamed.get(k, k) for k in keys]
    train, test = ml.hash_split(data, keys)
    model = ml.fit_model(train, spec)
    train_pred, test_pred = model.transform(train), model.transform(test)
    sinks.save_model(model, _out(out_dir, "models/random_forest_pipeline"))
    _, _, inputs = ml.feature_stages(train, spec)
    importance = ml.feature_importance(model, test_pred.schema, inputs)
    metrics = ml.metrics_frame(train, test, train_pred, test_pred, inputs).unionByName(
        importance.select(F.concat(F.lit("importance:"), "feature_group").alias("metric"), F.col("importance").alias("value")))
    sinks.write_metrics(metrics, _out(out_dir, "ml_metrics"))
    sinks.write_csv(ml.confusion(test_pred), _out(out_dir, "ml_confusion"))
    sinks.write_csv(importance, _out(out_dir, "ml_feature_importance"))
    sample = test_pred.select("label", "prediction", vector_to_array("probability").alias("probability"))
    sinks.write_quoted_csv(sample.limit(10), _out(out_dir, "ml_prediction_sample"))
    sinks.write_csv(quality.volume_report(pp, data), _out(out_dir, "reports/ml_volume"))
    return spark.read.option("header", True).schema("metric string, value double").csv(_out(out_dir, "ml_metrics"))


PROGRAMS = ("preprocess", "reduce", "transform", "traffic", "sql", "ml")


def run_all(spark: SparkSession, input_path: str, out_dir: str, spec: MovementSpec = FLIGHTS,
            programs=PROGRAMS) -> DataFrame:
    """Run the chosen programs; preprocessing runs once and the rest read its table."""
    if "preprocess" in programs:
        pp = run_preprocessing(spark.read.parquet(input_path), out_dir, spec)
    else:
        pp = spark.read.parquet(_out(out_dir, "preprocessed.parquet"))
    if "reduce" in programs:
        run_reduction(pp, out_dir, spec)
    if "transform" in programs:
        run_transformation(pp, out_dir, spec)
    if "traffic" in programs:
        run_traffic(pp, out_dir, spec)
    if "sql" in programs:
        run_sql(pp, out_dir, spec)
    if "ml" in programs:
        run_ml(pp, out_dir, spec)
    return pp
