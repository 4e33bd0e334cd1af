from pyspark.sql import functions as F

from peakflow.operators import clean, quality
from peakflow.spec import FLIGHTS


def col(df, name):
    return [r[0] for r in df.select(F.col(f"`{name}`")).collect()]


def test_trim_keeps_tabs_and_newlines(spark):
    df = spark.createDataFrame([(" a ",), ("\t a \n",)], "s string")
    assert col(clean.trim_strings(df), "s") == ["a", "\t a \n"]


def test_null_like_tokens(spark):
    vals = ["NULL", "None", "na", "N/A", "NaN", "", "nano", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = col(clean.null_like_to_null(df), "s")
    assert out == [None, None, None, None, None, None, "nano", None]


def test_blank_after_trim_is_null(spark):
    df = spark.createDataFrame([("  ",)], "s string")
    assert col(clean.null_like_to_null(clean.trim_strings(df)), "s") == [None]


def test_upper_and_terminal(spark):
    df = spark.createDataFrame([("jed", "t  1")], "`airline.iata` string, `movement.terminal` string")
    out = clean.normalize_terminal(clean.upper_columns(df, FLIGHTS.upper_columns), "movement.terminal")
    assert out.collect()[0][:] == ("JED", "T1")


def test_absent_column_is_noop(spark):
    df = spark.createDataFrame([("x",)], "other string")
    assert clean.normalize_terminal(df, "movement.terminal").columns == ["other"]
    assert clean.upper_columns(df, FLIGHTS.upper_columns).collect() == df.collect()


def test_regex_nullify_and_counts(spark):
    df = spark.createDataFrame([("AB",), ("ABC",), (None,), ("AB\n",)], "`airline.iata` string")
    out = col(clean.regex_nullify(df, [("airline.iata", 2)]), "airline.iata")
    assert out == ["AB", None, None, None]
    counts = quality.invalid_format_counts(df, [("airline.iata", 2)]).collect()
    assert [(r["column"], r["invalid_count"]) for r in counts] == [("airline.iata", 2)]
    nulled = sum(1 for a, b in zip(col(df, "airline.iata"), out) if a is not None and b is None)
    assert nulled == 2


def test_cargo_flag(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "isCargo boolean")
    assert col(clean.bool_flag(df, "isCargo"), "isCargo_int") == [1, 0, 0]


def test_terminal_group(spark):
    df = spark.createDataFrame([(None,), ("  ",), ("T1",)], "`movement.terminal` string")
    assert col(clean.terminal_group(df, "movement.terminal"), "terminal_group") == ["UNKNOWN", "UNKNOWN", "T1"]
    no_term = spark.createDataFrame([(1,)], "x int")
    assert col(clean.terminal_group(no_term, "movement.terminal"), "terminal_group") == ["ALL"]


def test_fill_unknown_after_rules(spark):
    df = spark.createDataFrame([("abc",), (None,)], "`destination_airport_iata` string")
    out = clean.fill_unknown(clean.regex_nullify(df, FLIGHTS.format_rules), FLIGHTS.fill_unknown)
    assert col(out, "destination_airport_iata") == ["UNKNOWN", "UNKNOWN"]


def test_rename_keeps_position_and_reduce(spark):
    df = spark.createDataFrame([(1, "x", 2)], "hour_of_day int, `airline.name` string, z int")
    out = clean.rename_dotted(df)
    assert out.columns == ["hour_of_day", "airline_name", "z"]
    assert clean.reduce_columns(df).columns == ["hour_of_day", "airline.name"]


def test_categoricals(spark):
    df = spark.createDataFrame([(" a ", None), ("", "jed")], "status string, destination_airport_iata string")
    out = clean.clean_categoricals(df, FLIGHTS.categorical_columns, FLIGHTS.categorical_upper).collect()
    assert [tuple(r) for r in out] == [("a", "UNKNOWN"), ("UNKNOWN", "JED")]


def test_flatten_array(spark):
    df = spark.createDataFrame([(["a", "b"],), (None,)], "`movement.quality` array<string>")
    out = clean.flatten_array(df, "movement.quality")
    assert out.columns == ["movement_quality"]
    assert col(out, "movement_quality") == ["a,b", ""]


def test_safe_casts(spark):
    df = spark.createDataFrame([(None, "7.9", 3), ("x", None, None)], "s string, n string, i int")
    out = clean.safe_casts(df, strings=["s"], ints=["n", "i"]).collect()
    assert [tuple(r) for r in out] == [("UNKNOWN", 7, 3), ("x", 0, 0)]


def test_cast_columns_untrusted(spark):
    df = spark.createDataFrame([("5",), ("x",)], "hour_of_day string")
    assert col(clean.cast_columns(df, ["hour_of_day"]), "hour_of_day") == [5, None]
