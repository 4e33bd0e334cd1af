"""End-to-end run of the six programs on a table with the reference's flattened flight schema."""

import glob
import os

from pyspark.sql import functions as F

from peakflow.plans import programs
from peakflow.plans import preprocess as pre
from peakflow.session import shared_path
from peakflow.sources.bindings import movements_raw
from peakflow.spec import FLIGHTS
from conftest import SF_SMALL


def flights_raw(spark, base):
    """The messy movement view renamed to the reference's dotted column names, plus the extra columns."""
    m = movements_raw(spark, base)
    uid = F.col("movement_id") % 97
    return m.select(
        F.col("scheduled_local_raw").alias("movement.scheduledTime.local"),
        F.concat(F.date_format(F.col("scheduled_local") - F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd HH:mm"),
                 F.lit("Z")).alias("movement.scheduledTime.utc"),
        F.col("carrier_raw").alias("airline.name"),
        F.concat(F.lit(" x"), (uid % 9).cast("string")).alias("airline.iata"),
        F.concat(F.lit("ab"), (uid % 7).cast("string")).alias("airline.icao"),
        F.col("origin_raw").alias("origin_airport_iata"),
        F.col("dest_raw").alias("destination_airport_iata"),
        F.concat(F.lit("oe"), F.col("dest_raw")).alias("destination_airport_icao"),
        F.concat(F.lit("City "), F.col("dest_raw")).alias("destination_airport_name"),
        F.col("terminal_raw").alias("movement.terminal"),
        F.lit("Asia/Riyadh").alias("movement.airport.timeZone"),
        F.when(uid % 3 == 0, F.lit("A320")).otherwise(F.lit("B777")).alias("aircraft.model"),
        F.col("status"),
        F.when(uid % 2 == 0, F.lit("departure")).otherwise(F.lit("arrival")).alias("flight_type"),
        F.col("is_cargo").alias("isCargo"),
        F.array(F.col("status"), F.lit("ok")).alias("movement.quality"),
    )


def test_flight_schema_preprocess(spark):
    raw = flights_raw(spark, SF_SMALL)
    pp = pre.preprocess(raw, FLIGHTS)
    cols = set(pp.columns)
    assert {"scheduled_local_ts", "scheduled_utc_ts", "peak_traffic_label", "terminal_group",
            "airline.iata", "movement.quality"} <= cols
    r = pp.agg(F.count("*").alias("n"),
               F.count_if(F.col("`airline.iata`") == "UNKNOWN").alias("bad_iata"),
               F.count_if(F.unix_seconds("scheduled_local_ts") != F.unix_seconds("scheduled_utc_ts")).alias("zdiff"),
               ).collect()[0]
    assert r["n"] > 0 and r["bad_iata"] == 0
    # local strings with +03:00 and Z forms, utc strings from the same wall time minus 3 hours
    assert r["zdiff"] < r["n"]


def test_run_all(spark):
    raw = flights_raw(spark, SF_SMALL)
    src = shared_path(spark, "flights-raw")
    raw.write.parquet(src)
    out = shared_path(spark, "programs")
    programs.run_all(spark, src, out, FLIGHTS)
    local = out[len("file:"):] if out.startswith("file:") else out
    for name in ("preprocessed.parquet", "preprocessed_dataset_csv", "reduced_dataset.parquet",
                 "reduced_dataset_csv", "transformed_dataset.parquet", "sql_results_csv", "ml_metrics",
                 "models/random_forest_pipeline", "traffic/top_routes", "reports/missing_compare"):
        assert glob.glob(os.path.join(local, name, "*")), name
    metrics = {r["metric"]: r["value"] for r in spark.read.option("header", True)
               .schema("metric string, value double").csv(out + "/ml_metrics").collect()}
    assert metrics["train_rows"] + metrics["test_rows"] == spark.read.parquet(out + "/preprocessed.parquet").count()
    assert 0.0 <= metrics["test_roc_auc"] <= 1.0
    for name in ("cleaning_summary.parquet", "unparsed", "invalid_formats", "duplicates"):
        assert glob.glob(os.path.join(local, "reports", name, "*")), name
    unparsed = spark.read.option("header", True).option("inferSchema", True).csv(out + "/reports/unparsed").first()
    dups = spark.read.option("header", True).option("inferSchema", True).csv(out + "/reports/duplicates").first()
    assert dups["rows_before"] == unparsed["rows_after"] == raw.count() - unparsed["rows_removed"]
    assert dups["rows_after"] == spark.read.parquet(out + "/preprocessed.parquet").count()
    header = open(glob.glob(os.path.join(local, "preprocessed_dataset_csv", "part-*"))[0]).readline()
    assert '"movement_quality"' in header and '"airline.name"' in header


def test_command_line(spark):
    from peakflow.__main__ import main
    src = shared_path(spark, "flights-raw-cli")
    flights_raw(spark, SF_SMALL).write.parquet(src)
    out = shared_path(spark, "cli")
    main(["--input", src, "--output", out, "--programs", "preprocess,sql"])
    lines = spark.read.text(out + "/sql_results_csv").collect()
    assert any("sql_top_dest_dense" in r["value"] for r in lines)
