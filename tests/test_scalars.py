import math

from pyspark.sql import functions as F

from duoscope.functions import scalars as S


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_tolerant_int(spark):
    got = col_values(spark, ["1994", "1994.7", "PG", "", None, " 2001 ", "-33.9"], S.tolerant_int)
    assert got == [1994, 1994, None, None, None, 2001, -33]


def test_normalize_title_unicode_whitespace(spark):
    got = col_values(spark, ["  The Matrix ", "\tAmélie ", "Inner  Spaces", None], S.normalize_title)
    assert got == ["the matrix", "amélie", "inner  spaces", None]


def test_release_year(spark):
    got = col_values(spark, ["1994-10-14", "2001/02/03", "bad", "", None, "1999-01-01 00:00:00", "1994-1-5",
                             "1987/3/09 noon", "1987-3/09", "1987-13-01", "03-02-1987"], S.release_year)
    assert got == [1994, 2001, None, None, None, 1999, 1994, 1987, None, None, None]


def test_primary_item(spark):
    got = col_values(spark, ["Drama", "Action, Drama", " Comedy ,X", None, ""], S.primary_item)
    assert got == ["Drama", "Action", "Comedy", None, ""]


def test_decade_floors_negative(spark):
    got = col_values(spark, [1994, 2000, -5, None], S.decade, "int")
    assert got == [1990, 2000, -10, None]


def test_vote_buckets_right_closed(spark):
    label = lambda c: S.bucketize(c, S.VOTE_BREAKS, S.VOTE_LABELS)[0]
    vals = [0.0, 100000.0, 100001.0, 500000.0, 1000000.0, 5000000.0, 5000001.0, -1.0, None, float("nan")]
    got = col_values(spark, vals, label, "double")
    assert got == ["<100k", "<100k", "100k–500k", "100k–500k", "500k–1M", ">1M", None, None, None, None]


def test_low_count_flag_and_log10(spark):
    assert col_values(spark, [19, 20, None], lambda c: S.low_count_flag(c), "int") == [True, False, None]
    got = col_values(spark, [1000.0, 0.0, -5.0, None], S.safe_log10, "double")
    assert got[0] == 3.0 and got[1:] == [None, None, None]


def test_corr_label(spark):
    got = col_values(spark, [0.1, -0.3, 0.5, 0.7, 0.9, None, float("nan")], S.corr_label, "double")
    assert got == ["very weak correlation", "weak correlation", "moderate correlation",
                   "strong correlation", "very strong correlation",
                   "correlation not computable", "correlation not computable"]


def test_formatters(spark):
    df = spark.createDataFrame([(0.0004, 0.1234, 0.5678), (0.25, -0.5, 0.5)], "p double, lo double, hi double")
    rows = df.select(S.fmt_p("p"), S.fmt_ci("lo", "hi")).collect()
    assert [tuple(r) for r in rows] == [("< 0.001", "[0.123, 0.568]"), ("0.250", "[-0.500, 0.500]")]


def test_point_label_and_thousands(spark):
    df = spark.createDataFrame([("Heat", 1995, 8.3, 9.0, -0.70000000001, 1234567.0)],
                               "t string, y int, a double, b double, d double, v double")
    row = df.select(S.point_label("t", "y", [("a", "a"), ("b", "b"), ("diff", "d")]),
                    S.thousands("v")).first()
    assert row[0] == "Heat (1995) / a: 8.3 / b: 9 / diff: -0.7"
    assert row[1] == "1,234,567"


def test_numbers_as_plain_text(spark):
    got = col_values(spark, [0.125, 0.375, 15000000.0, 1.5e-9, -0.001, 2.5, 100.0, None], S.num_text, "double")
    assert got == ["0.12", "0.38", "15000000", "0", "0", "2.5", "100", None]


def test_round_numeric_half_even(spark):
    df = spark.createDataFrame([(0.125, 2.5, 3)], "a double, b double, c int")
    r = S.round_numeric(df, 2).first()
    assert r.a == 0.12 and r.b == 2.5 and r.c == 3
    assert math.isclose(S.round_numeric(df, 0).first().b, 2.0)


def test_num_text_keeps_whole_zeros(spark):
    df = spark.createDataFrame([(100.0,), (0.0,), (-0.5,), (10.10,), (1e15,), (0.004,), (None,)], "x double")
    assert [r[0] for r in df.select(S.num_text("x"), "x").collect()] == ["100", "0", "-0.5", "10.1", "1000000000000000", "0", None]
