"""One test per null/arithmetic rule (N1..N17)."""

import pytest
from pyspark.sql import functions as F
from pyspark.errors import ArithmeticException

from checks import rows
from emberledger.functions import semantics as S
from emberledger.operators.relational import bind, lookup_join, to_long, when_map


def test_n1_na_sum_propagates_and_empty_is_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0)], "k string, v double")
    out = dict(df.groupBy("k").agg(S.na_sum("v").alias("s")).collect())
    assert out == {"a": None, "b": 5.0}
    empty = df.where("false").agg(S.na_sum("v").alias("s")).collect()[0]["s"]
    assert empty == 0.0


def test_n1_na_sum_window_and_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0)], "k string, v double")
    w = S.whole_partition("k")
    got = rows(df.select("k", S.na_sum("v", over=w).alias("s")).distinct())
    assert got == [("a", None), ("b", 6.0)]
    means = dict(df.groupBy("k").agg(S.na_mean("v").alias("m")).collect())
    assert means == {"a": None, "b": 3.0}


def test_number_text_rounds_ties_to_even_and_drops_zeros(spark):
    vals = [12.25, 12.35, 36.0, 36.04, 0.0, -0.04, 100000.0, 120000.0, 1500000.0, -2000000.0, 99999.96, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r.t for r in df.select("i", S.number_text("v", 1).alias("t")).orderBy("i").collect()]
    # 12.35 is stored below its name
    assert got == ["12.2", "12.3", "36", "36", "0", "0", "1e+05", "120000", "1500000", "-2e+06", "1e+05", "NA"]
    assert rows(spark.createDataFrame([(0.1225,)], "r double").select(S.percent_text("r", 1).alias("p"))) == [("12.2%",)]


def test_losses_match_null_fuels(spark):
    from emberledger.operators import factors

    rec = spark.createDataFrame([(None, 2020, 10.0), ("gas", 2020, 4.0)], "activity string, input_year int, amount double")
    loss = spark.createDataFrame([(None, "leak", 0.5, 2020)], "fuel_type string, type string, loss_factor double, input_year int")
    assert rows(factors.derive_losses(rec, loss), "activity", "amount") == [(None, 5.0)]
    both = rows(factors.with_losses(rec, loss), "activity", "amount")
    assert both == sorted([("gas", 4.0), (None, 10.0), (None, 5.0)], key=repr)


def test_n2_sum_or_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), ("b", None)], "k string, v double")
    assert dict(df.groupBy("k").agg(S.sum_or_zero("v").alias("s")).collect()) == {"a": 0.0, "b": 2.0}


def test_n3_null_safe_join_matches_null_keys(spark):
    facts = spark.createDataFrame([(None, 1.0), ("x", 2.0)], "k string, v double")
    dim = spark.createDataFrame([(None, "null-key"), ("x", "ex")], "k string, label string")
    assert rows(lookup_join(facts, dim, ["k"], "left", null_safe=True), "v", "label") == [
        (1.0, "null-key"), (2.0, "ex")]
    assert rows(lookup_join(facts, dim, ["k"], "left"), "v", "label") == [(1.0, None), (2.0, "ex")]


def test_n5_case_when_without_default_is_null(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert rows(df.select("k", when_map("k", {"a": "A"}).alias("x"))) == [("a", "A"), ("b", None)]


def test_n6_not_in_with_null_is_true(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    assert df.where(S.not_in("k", ["a"])).count() == 2
    assert df.where(~F.col("k").isin("a")).count() == 1  # Spark's plain NOT IN drops the null


def test_n7_concat_propagates_null_n8_label_prints_na(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    got = rows(df.select(S.concat_na("x", "y", sep="_").alias("c"), S.label_text("y").alias("l")))
    assert got == [("a_b", "b"), (None, "NA")]


def test_n9_str_remove_first_match_only(spark):
    df = spark.createDataFrame([("a_tonnes_tonnes",)], "s string")
    assert df.select(S.str_remove_first("s", "_tonnes")).collect()[0][0] == "a_tonnes"


def test_n10_str_extract_null_on_no_match(spark):
    df = spark.createDataFrame([("III.1.2",), ("V.x",), (None,)], "g string")
    got = rows(df.select(S.to_int(S.str_extract("g", r"\d$")).alias("d")))
    assert got == [(2,), (None,), (None,)]


def test_n11_division_by_zero_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -0.0), (3.0, 2.0)], "a double, b double")
    assert rows(df.select(S.safe_div("a", "b").alias("q"))) == [(1.5,), (None,), (None,)]
    with pytest.raises(ArithmeticException):
        df.select((F.col("a") / F.col("b")).alias("q")).collect()


def test_n12_unpivot_keeps_null_cells(spark):
    wide = spark.createDataFrame([(2020, 1.0, None)], "input_year int, a_tonnes double, b_tonnes double")
    long = to_long(wide, ["input_year"], None, "entity", "t")
    assert rows(long) == [(2020, "a_tonnes", 1.0), (2020, "b_tonnes", None)]


def test_n14_bind_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "scope int, activity string")
    b = spark.createDataFrame([("y",)], "activity string")
    assert rows(bind(a, b), "activity", "scope") == [("x", 1), ("y", None)]


def test_n17_half_even_rounding(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "v double")
    assert [r[0] for r in df.select(S.half_even("v", 2)).collect()] == [0.12, 0.38, 2.5]
    assert [r[0] for r in df.select(S.half_even("v", 0)).collect()] == [0.0, 0.0, 2.0]


def test_labels_text(spark):
    df = spark.createDataFrame([(0.2984,), (None,)], "r double")
    assert rows(df.select(S.percent_text("r").alias("p"))) == [("29.8%",), ("NA",)]


@pytest.mark.parametrize("value,decimals,want", [
    (0.15, 1, 0.1), (0.35, 1, 0.3), (2.675, 2, 2.67), (0.25, 1, 0.2), (0.75, 1, 0.8), (-0.15, 1, -0.1), (-0.25, 1, -0.2),
    (2.5, 0, 2.0), (3.5, 0, 4.0), (1e300, 2, 1e300), (1234.5, 0, 1234.0), (1.005, 2, 1.0), (0.285, 2, 0.28),
])
def test_n17_rounds_the_stored_number(spark, value, decimals, want):
    got = spark.createDataFrame([(value,), (None,)], "v double").select(S.half_even("v", decimals).alias("v"))
    assert [r.v for r in got.collect()] == [want, None]


@pytest.mark.parametrize("ratios,want", [
    ([0.0, 0.5, -0.25], ["0%", "50%", "-25%"]),  # gaps of 25 percent: whole percents
    ([0.0, 0.05, 0.10], ["0%", "5%", "10%"]),
    ([0.0, 0.005, 0.0125], ["0.00%", "0.50%", "1.25%"]),  # a gap of 0.5 percent
    ([0.0, 0.005, 0.012], ["0.0%", "0.5%", "1.2%"]),  # the last digit would be 0 in all
    ([0.0, -0.130617, -0.298498], ["0%", "-13%", "-30%"]),
    ([0.001, 0.002], ["0.1%", "0.2%"]),
    ([0.00012, 0.00034], ["0.012%", "0.034%"]),
    ([0.5], ["50%"]), ([0.5, 0.5], ["50%", "50%"]), ([None, 0.123], ["NA", "12%"]),
])
def test_x12_decimals_from_the_column(spark, ratios, want):
    df = spark.createDataFrame([(i, "a", r) for i, r in enumerate(ratios)] + [(99, "b", 0.1), (100, "b", 0.10012)], "i int, g string, r double")
    got = {r.i: r.t for r in df.select("i", S.fitted_percent_text("r", "g").alias("t")).collect()}
    assert [got[i] for i in range(len(ratios))] == want
    assert got[99] == "10.000%" and got[100] == "10.012%"
