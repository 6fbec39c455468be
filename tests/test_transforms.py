from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.nulls import normalize_nulls
from tessera.functions.regex import to_java_pattern
from tessera.operators import transforms as X


def test_null_tokens_exact_match(spark):
    df = spark.createDataFrame([("1", "NaN"), ("2", " NaN"), ("3", "missing value"), ("4", "ok"), ("5", "")],
                               "id string, v string")
    assert rows(normalize_nulls(df)) == [("1", None), ("2", " NaN"), ("3", None), ("4", "ok"), ("5", None)]


def test_clean_column_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a­b` int, `c​` int")
    assert X.clean_column_names(df).columns == ["ab", "c"]
    clash = spark.createDataFrame([(1, 2)], "`ab` int, `a­b` int")
    try:
        X.clean_column_names(clash)
        raise AssertionError("collision not detected")
    except ValueError:
        pass


def test_filename_groups_and_rules(spark):
    df = spark.createDataFrame([("Rx_2024.01.02_T10.11.12_77.json", "keep"), ("other.json", "keep")],
                               "_file_name string, name string")
    pat = r"(?P<name>\w+)_(?P<date>\d{4}\.\d{2}\.\d{2})_T(?P<time>\d{2}\.\d{2}\.\d{2})_(?P<Inspection>\d+)"
    rules = {"name": {"replace": [{"old": "_", "new": " "}]}, "date": {"replace": [{"old": ".", "new": "-"}]},
             "time": {"replace": [{"old": ".", "new": ":"}], "add suffix": "Z"}, "Inspection": {"add prefix": "#"}}
    out = X.add_filename_groups(df, pat, rules)
    got = rows(out, "_file_name", "name", "date", "time", "Inspection")
    assert got == [("Rx_2024.01.02_T10.11.12_77.json", "Rx", "2024-01-02", "10:11:12Z", "#77"),
                   ("other.json", "keep", None, None, None)]


def test_java_pattern_indexes():
    java, idx = to_java_pattern(r"(\w+)_(\d{8})_(?P<correlation_Key>\w+)\.json$")
    assert "?P<" not in java and idx == {"correlation_Key": 3}


def test_key_composition_and_null_key(spark):
    df = spark.createDataFrame([(" a ", "x"), (None, "y"), (None, None)], "k1 string, k2 string")
    keyed = X.with_key(df, ["k2", "k1"])  # sorted: k1, k2
    assert rows(keyed, "_key") == [("<NA>-<NA>",), ("<NA>-y",), ("a-x",)]
    single = X.with_key(df, ["k1"])
    assert rows(X.drop_null_keys(single), "_key") == [("a",)]


def test_published_flag_and_typed_keys(spark):
    df = spark.createDataFrame([("1", None), ("x", "True"), (None, "nan")], "pk string, flag string")
    out = X.published_flag(X.typed_keys(df, ["pk"]), ["flag", "other"])
    assert sorted(map(str, rows(out, "pk", "flag", "other", "_reject"))) == sorted(map(str, [
        (None, "False", "False", False), (None, "True", "False", True), (1, "False", "False", False)]))


def test_file_timestamp_iso(spark):
    df = spark.createDataFrame([("2024-03-01 12:34:56",)], "t string").select(
        F.to_timestamp("t").alias("_file_mtime"))
    assert X.add_file_timestamp(df, "ts").first()["ts"] == "2024-03-01T12:34:56Z"
