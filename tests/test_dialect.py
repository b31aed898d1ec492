from datetime import date

from pyspark.sql import functions as F

from provgraph.functions.dialect import (
    canonical_long,
    claim_year_month,
    month_diff,
    month_start,
    packed_claim_month,
    packed_date,
    rounded,
    safe_ratio,
    tsql_int,
)


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).collect()[0].v


def test_month_diff_counts_calendar_boundaries(spark):
    d = lambda s: F.lit(s).cast("date")
    assert one(spark, month_diff(d("2020-02-01"), d("2020-01-31"))) == 1
    assert one(spark, month_diff(d("2021-01-01"), d("2020-12-31"))) == 1
    assert one(spark, month_diff(d("2020-01-31"), d("2020-01-01"))) == 0
    assert one(spark, month_diff(d("2019-11-15"), d("2020-02-15"))) == -3


def test_month_start(spark):
    assert one(spark, month_start(F.lit("2020-02-29").cast("date"))) == date(2020, 2, 1)


def test_packed_date_is_safe(spark):
    assert one(spark, packed_date(F.lit(20200229))) == date(2020, 2, 29)
    assert one(spark, packed_date(F.lit(20210229))) is None  # not a leap year
    assert one(spark, packed_date(F.lit(20201301))) is None  # month 13
    assert one(spark, packed_date(F.lit(20200432))) is None  # day 32
    assert one(spark, packed_date(F.lit(None).cast("int"))) is None


def test_packed_claim_month_uses_month_digits_only(spark):
    # Q3: a bad day still yields a month, a bad month does not.
    assert one(spark, packed_claim_month(F.lit(2019), F.lit(20200432))) == date(2019, 4, 1)
    assert one(spark, packed_claim_month(F.lit(2020), F.lit(20201301))) is None


def test_claim_year_month_takes_year_from_claim_year(spark):
    assert one(spark, claim_year_month(F.lit(2019), F.lit("2020-01-15").cast("date"))) == date(2019, 1, 1)
    assert one(spark, claim_year_month(F.lit(2019), F.lit(None).cast("date"))) is None


def test_tsql_int(spark):
    assert one(spark, tsql_int(F.lit(""))) == 0  # Q6: blank is 0 in T-SQL
    assert one(spark, tsql_int(F.lit("   "))) == 0
    assert one(spark, tsql_int(F.lit("UNKNOWN"))) is None
    assert one(spark, tsql_int(F.lit("1234567890"))) == 1234567890
    assert one(spark, tsql_int(F.lit("2147483648"))) is None  # above 32-bit INT
    assert one(spark, tsql_int(F.lit(None).cast("string"))) is None


def test_canonical_long_matches_string_cast_join(spark):
    assert one(spark, canonical_long(F.lit("1100000001"))) == 1100000001
    assert one(spark, canonical_long(F.lit("01100000001"))) is None
    assert one(spark, canonical_long(F.lit(" 5"))) is None
    assert one(spark, canonical_long(F.lit(""))) is None


def test_safe_ratio_is_double_and_null_on_zero(spark):
    assert abs(one(spark, safe_ratio(F.lit(3), F.lit(7))) - 3 / 7) < 1e-15
    assert one(spark, safe_ratio(F.lit(3), F.lit(0))) is None
    assert one(spark, safe_ratio(F.lit(3), F.lit(None).cast("long"))) is None


def test_packed_dates_by_arithmetic_equal_those_by_text(spark):
    """Odd lengths and impossible days included; 8-digit values are not parsed as text."""
    odd = [0, -5, 1, 196001, 1996011, 999999999, -19960101, 99999999, 10000101, 19000229, 20000229, 20010230, 20010431, 20011231, 20010010, 20010100, None]
    values = odd + [y * 10000 + m * 100 + d for y in (1899, 1900, 2000, 2023, 2024) for m in range(14) for d in (0, 1, 28, 29, 30, 31, 32)]
    rows = [(v, y) for v in values for y in (1996, 2000, 999, 12345, None)]
    df = spark.createDataFrame(rows, "v int, y int")
    s = F.col("v").cast("string")
    text = F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2), F.lit("-"), F.substring(s, 7, 2)).try_cast("date")
    month = F.concat(F.col("y").cast("string"), F.lit("-"), F.substring(s, 5, 2), F.lit("-01")).try_cast("date")
    wrong = df.filter(~packed_date("v").eqNullSafe(text) | ~packed_claim_month("y", "v").eqNullSafe(month))
    assert wrong.collect() == []


def test_rounded_equals_round(spark):
    df = spark.range(200_000).select((F.rand(3) * F.pow(F.lit(10.0), F.floor(F.rand(4) * 6)) - 5).alias("x"))
    ties = spark.createDataFrame([(v,) for v in (0.5 / 64, 1 / 128, -1 / 128, 0.0, -0.0, 3.0, None, float("nan"), float("inf"), 1e300)], "x double")
    both = df.union(ties)
    for digits in (6, 9):
        assert both.filter(~rounded("x", digits).eqNullSafe(F.round("x", digits))).collect() == []
