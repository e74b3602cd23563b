"""Table operators on hand-made frames."""

import json

import pytest
from pyspark.sql import functions as F

from veinwork.operators import association as A
from veinwork.operators import cleaning as C
from veinwork.operators import encoding as E
from veinwork.operators import profiling as P
from veinwork.operators import trees as M
from veinwork.operators.shape import columns_by_kind, project
from veinwork.plans.stop_queries import raw_stops
from veinwork.sources.readers import read_csv
from veinwork.sources.schema import FieldSpec, coerce, coercion_report
from veinwork.sources.sinks import metrics, metrics_report, write_report
from veinwork.sources.stops import STOP_FIELDS


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_stop_fields_cover_the_file():
    assert len(STOP_FIELDS) == 43 == len({f.name for f in STOP_FIELDS})
    kinds = [f.kind for f in STOP_FIELDS]
    assert [kinds.count(k) for k in ("text", "flag", "double", "whole", "timestamp")] == [27, 12, 2, 1, 1]


def test_csv_round_trip(spark, folder, tmp_path):
    raw = raw_stops(spark, folder)
    raw.write.option("header", True).csv(str(tmp_path / "stops"))
    typed = read_csv(spark, str(tmp_path / "stops"), STOP_FIELDS)
    assert typed.count() == raw.count()
    kinds = columns_by_kind(typed, exclude=["SeqID"])
    assert "Year" in kinds["numeric"] and "Accident" in kinds["boolean"] and "SeqID" not in kinds["categorical"]
    assert dict(typed.dtypes)["Date Of Stop"] == "timestamp_ntz"


def test_coercion_skips_and_counts(spark):
    raw = spark.createDataFrame([("a", "1", 5), ("b", None, 0)], "t string, n string, k int")
    specs = [FieldSpec("n", "double"), FieldSpec("k", "flag"), FieldSpec("absent", "whole")]
    assert [tuple(r) for r in coerce(raw, specs).collect()] == [("a", 1.0, True), ("b", None, False)]
    assert rows(coercion_report(raw, specs), "field") == [("k", "flag", 2, 0), ("n", "double", 1, 0)]
    with pytest.raises(ValueError):
        FieldSpec("x", "decimal")


def test_keep_first_counts_null_keys(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (None, 5), (None, 4)], "k int, o int")
    assert rows(C.keep_first(df, ["k"], ["o"]), "o") == [(1, 2), (None, 4)]
    assert P.duplicate_count(df, ["k"]).first()["duplicates"] == 2


def test_rules_on_nulls(spark):
    df = spark.createDataFrame([(91.0,), (0.0,), (None,)], "lat double")
    rule = C.range_rule("lat", F.col("lat"), -90.0, 90.0)
    assert rows(C.violation_counts(df, [rule]), "rule") == [("lat", 1), ("total", 1)]
    assert rows(C.valid_rows(df, [rule]), "lat") == [(0.0,)]


def test_imputation(spark):
    df = spark.createDataFrame(
        [("a", None, 1, None), ("b", "x", None, None), (None, "x", 4, None), ("b", "y", 2, "z"), ("a", None, None, None)],
        "m string, u string, n int, sparse string")
    clean, log = C.impute(df, constant=["u"])
    assert clean.columns == ["m", "u", "n"]
    assert sorted(tuple(r) for r in clean.collect()) == sorted(
        [("a", "Unknown", 1.0), ("b", "x", 2.0), ("a", "x", 4.0), ("b", "y", 2.0), ("a", "Unknown", 2.0)])
    assert {r["column"]: r["action"] for r in log.collect()} == {
        "sparse": "dropped", "u": "filled with 'Unknown'", "n": "filled with median (2.00)", "m": "filled with 'a'"}
    assert C.mode_values(spark.createDataFrame([(None,)], "e string"), ["e"]) == {"e": "Unknown"}


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 3 + [(None,)], "v double")
    found = P.histogram(df, "v", 4).orderBy("bin").collect()
    assert [r["n"] for r in found] == [0, 0, 3, 0]
    assert (found[0]["low"], found[-1]["high"]) == (1.5, 2.5)
    assert P.histogram(df.filter("v > 5"), "v", 4).count() == 0


def test_scaling_a_constant_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, None)], "a double, b double")
    standard = E.fit_standard(df, ["a", "b"]).transform(df)
    assert rows(standard, "a") == [(None, None), (-1.0, 0.0), (1.0, 0.0)]
    assert rows(E.fit_minmax(df, ["a", "b"]).transform(df), "a") == [(None, None), (0.0, 0.0), (1.0, 0.0)]


def test_one_hot_drops_the_first(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "v string")
    hot = E.one_hot(df, ["v"])
    assert hot.columns == ["v", "v_a", "v_b", "v_c"]  # Unknown sorts before the letters
    with pytest.raises(ValueError):
        E.one_hot(df, ["v"], limit=2)


def test_unseen_labels(spark):
    train = spark.createDataFrame([("b",), ("a",)], "v string")
    test = spark.createDataFrame([("a", "t"), ("z", "t"), (None, "t")], "v string, split string")
    coded = E.apply_labels(test, E.fit_labels(train, ["v"]), ["v"], unseen=0, mark_unseen=True)
    assert sorted(r["v_encoded"] for r in coded.collect()) == [0, 0, 0]
    assert rows(E.unseen_report(coded, ["v"], "split"), "column") == [("t", "v", 2)]


def test_rules_of_flags(spark):
    df = spark.createDataFrame([(True, False, True), (True, False, False), (False, False, True)], "a boolean, b boolean, c boolean")
    assert rows(A.association_rules(df, ["a", "b", "c"]), "antecedent") == [("a", "c", 0.333333, 0.5, 1)]


def test_correlation_with_gaps(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, None, 7.0), (4.0, 8.0, 7.0)], "a double, b double, c double")
    found = {(r["a"], r["b"]): r["r"] for r in A.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert found[("a", "b")] == found[("b", "a")] == found[("a", "a")] == 1.0
    assert found[("a", "c")] is None and found[("c", "c")] is None
    assert len(A.strong_pairs(df, ["a", "b", "c"]).collect()) == 1


def test_confusion_has_every_cell(spark):
    df = spark.createDataFrame([("x", "y"), ("x", "x"), ("y", "z")], "t string, p string")
    found = {(r[0], r[1]): (r[2], r[3]) for r in M.confusion_matrix(df, "t", "p").collect()}
    assert len(found) == 9
    assert found[("x", "y")] == (1, 50.0) and found[("y", "y")] == (0, 0.0) and found[("z", "x")] == (0, None)


def test_project_skips_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `b c` int")
    assert project(df, ["b c", "no", "a"]).columns == ["b c", "a"]


def test_report_files(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    report = metrics_report([metrics(df, "s", {"mean": F.avg("v")}), metrics(df, "t", {"rows": F.count("v")})])
    for fmt in ("parquet", "json", "csv"):
        write_report(report, str(tmp_path / fmt), fmt)
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2
    assert spark.read.json(str(tmp_path / "json")).filter("metric = 'mean'").first()["value"] == 2.0
    lines = [p.read_text() for p in (tmp_path / "json").glob("*.json")]
    assert json.loads(lines[0].splitlines()[0])["section"] in {"s", "t"}
