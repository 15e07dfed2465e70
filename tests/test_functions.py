"""Scalars, segments, money and aggregate expressions on hand-made rows."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll import functions as fn


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def ts(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize(
    ("start", "end", "days"),
    [
        ("2024-01-15 23:00:00", "2024-01-16 01:00:00", 1),
        ("2024-01-15 01:00:00", "2024-01-15 23:00:00", 0),
        ("2024-01-16 01:00:00", "2024-01-15 23:00:00", -1),
        ("2024-02-28 12:00:00", "2024-03-01 00:00:00", 2),
    ],
)
def test_days_between_counts_day_boundaries(spark, start, end, days):
    assert one(spark, fn.days_between(ts(start), ts(end))) == days


def test_days_between_takes_both_timestamp_kinds(spark):
    late, early = F.lit("2024-01-16 01:00:00"), F.lit("2024-01-15 23:00:00")
    assert one(spark, fn.days_between(early.cast("timestamp_ntz"), late.cast("timestamp"))) == 1


@pytest.mark.parametrize(
    ("micros", "expected"),
    [
        (1705314600123456, datetime(2024, 1, 15, 10, 30)),
        (0, datetime(1970, 1, 1)),
        (-1, datetime(1970, 1, 1)),
        (-1_500_000, datetime(1969, 12, 31, 23, 59, 59)),
        (None, None),
    ],
)
def test_epoch_micros_drops_the_fraction(spark, micros, expected):
    moment = fn.epoch_micros_to_ts(F.lit(micros).cast("bigint")).cast("timestamp_ntz")
    assert one(spark, moment) == expected


def test_share_pct(spark):
    assert one(spark, fn.share_pct(F.lit(1.0), F.lit(3.0))) == 33.33
    assert one(spark, fn.share_pct(F.lit(1.005), F.lit(100.0))) == 1.01
    assert one(spark, fn.share_pct(F.lit(0.0), F.lit(0.0))) is None
    assert one(spark, fn.share_pct(F.lit(1.0), F.lit(0.0))) is None


def test_date_or_today(spark):
    assert one(spark, fn.date_or_today(date(2024, 4, 27))) == date(2024, 4, 27)
    assert one(spark, fn.date_or_today(None) == F.current_date())


def test_value_segment_cuts(spark):
    spent = spark.createDataFrame([(499.99,), (500.0,), (999.99,), (1000.0,), (None,)], "spent double")
    labels = [r[0] for r in spent.select(fn.value_segment(F.col("spent"))).collect()]
    assert labels == ["Low Value", "Medium Value", "Medium Value", "High Value", "Low Value"]


def test_frequency_segment_cuts(spark):
    counts = spark.createDataFrame([(4,), (5,), (9,), (10,), (None,)], "n bigint")
    labels = [r[0] for r in counts.select(fn.frequency_segment(F.col("n"))).collect()]
    assert labels == [
        "Occasional (1-4 transactions)",
        "Regular (5-9 transactions)",
        "Regular (5-9 transactions)",
        "Frequent (10+ transactions)",
        "Occasional (1-4 transactions)",
    ]


def test_segment_cuts_are_parameters(spark):
    assert one(spark, fn.value_segment(F.lit(60.0), high=100, medium=50)) == "Medium Value"
    assert one(spark, fn.frequency_segment(F.lit(20), frequent=20, regular=8)) == "Frequent (20+ transactions)"
    assert one(spark, fn.frequency_segment(F.lit(7), frequent=20, regular=8)) == "Occasional (1-7 transactions)"


@pytest.mark.parametrize("price", [0.1, 19.99, 1299.99, 0.0375, 1.459, 123456789.01, -5.25])
def test_money_units_are_exact_up_to_four_decimals(spark, price):
    assert one(spark, fn.money_units(F.lit(price))) == round(price * 10000)
    assert one(spark, fn.units_to_double(fn.money_units(F.lit(price)))) == price


def test_money_of_null_and_of_decimal(spark):
    assert one(spark, fn.money_units(F.lit(None).cast("double"))) is None
    assert one(spark, fn.money_units(F.lit("19.99").cast("decimal(12,2)"))) == 199900


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", "true")


def total(spark, lines, quantity="int"):
    df = spark.createDataFrame(lines, f"q {quantity}, p double")
    return df.agg(fn.total_amount(F.col("q"), F.col("p")), fn.mean_amount(F.col("q"), F.col("p"))).first()


def test_small_prices_keep_their_digits(spark, ansi):
    assert math.isclose(total(spark, [(100_000, 0.00004)] * 10)[0], 40.0)
    assert math.isclose(one(spark, fn.line_amount(F.lit(3), F.lit(1.23456789))), 3.70370367)


@pytest.mark.parametrize("bad", [math.inf, -math.inf])
def test_an_infinite_price_makes_its_total_infinite(spark, ansi, bad):
    assert tuple(total(spark, [(2, 1.5), (1, bad)])) == (bad, bad)
    assert one(spark, fn.money_units(F.lit(bad))) == 0


def test_nan_stays_nan(spark, ansi):
    assert all(map(math.isnan, total(spark, [(2, 1.5), (1, math.nan)])))


def test_large_totals_neither_wrap_nor_fail(spark, ansi):
    assert total(spark, [(100_000, 9e9)] * 4)[0] == 3.6e15
    assert total(spark, [(2_000_000_000, 400_000.0)] * 2)[0] == 1.6e15
    assert total(spark, [(1, 2e10)] * 100_000)[0] == 2e15  # whole units, beyond 64 bits of them
    assert total(spark, [(9_000_000_000_000_000_000, 0.00006)], "bigint")[0] == pytest.approx(5.4e14)
    assert one(spark, fn.line_amount(F.lit(2), F.lit(1e300))) == 2e300


def test_fractional_quantities(spark, ansi):
    assert tuple(total(spark, [(1.5, 10.0), (0.5, 4.0)], "double")) == (17.0, 8.5)
    assert total(spark, [(-1.5, 10.0), (0.25, 0.01), (None, 1.0), (2.0, None)], "double")[0] == -14.9975
    assert total(spark, [(0.0001, 0.0001)] * 3, "double")[0] == 3e-8
    assert total(spark, [(1 / 3, 3.0)] * 6, "double")[0] == pytest.approx(6.0, rel=1e-15)
    assert total(spark, [(2.5, 1e-7)] * 4, "double")[0] == pytest.approx(1e-6, rel=1e-12)
    assert total(spark, [(1e300, 1e-300), (3e15, 1e-6), (0.5, 1e300)], "double")[0] == pytest.approx(5e299)
    assert total(spark, [(40_000_000_000.0, 0.5), (2.0**52, 0.0)], "double")[0] == 2e10
    assert total(spark, [(20_000.5, 1_000_000.0)] * 1000, "double")[0] == 20_000_500_000_000.0
    for bad in (math.inf, -math.inf):
        assert total(spark, [(1.5, 2.0), (bad, 1.0)], "double")[0] == bad
    assert math.isnan(total(spark, [(1.5, 2.0), (math.nan, 1.0)], "double")[0])
    assert one(spark, fn.line_amount(F.lit(1.5), F.lit(19.99))) == 29.985
    assert one(spark, fn.line_amount(F.lit(0.1), F.lit(0.7))) == 0.07
    assert one(spark, fn.line_amount(F.lit("2.75").cast("decimal(10,2)"), F.lit(4.0))) == 11.0


def test_whole_and_general_parts_agree(spark):
    df = spark.range(5000).selectExpr("cast(id % 97 - 40 AS int) AS q", "(id * 7919 % 100003 - 500) / 10000 AS p", "id % 7 AS k")
    q, p = F.col("q"), F.col("p")
    out = df.groupBy("k").agg(*(f(q, p, whole=w).alias(f"{f.__name__}{w}") for f in (fn.total_amount, fn.mean_amount) for w in (True, False)))
    assert all(r["total_amountTrue"] == r["total_amountFalse"] and r["mean_amountTrue"] == r["mean_amountFalse"] for r in out.collect())


def test_fractional_sums_do_not_depend_on_the_order(spark):
    df = spark.range(60_000).selectExpr("(id * 7919 % 99991) / 10000 AS q", "(id * 104729 % 999983) / 10000 AS p")
    sums = {tuple(df.repartition(n, "q").agg(fn.total_amount(F.col("q"), F.col("p")), fn.total_units(df, "q")).first()) for n in (1, 3, 8)}
    exact = sum((i * 7919 % 99991) * (i * 104729 % 999983) for i in range(60_000))
    assert [s[0] for s in sums] == [exact / 10**8] and len(sums) == 1


def test_line_amount(spark):
    assert one(spark, fn.line_amount(F.lit(3), F.lit(19.99))) == 59.97
    assert one(spark, fn.line_amount(F.lit(-2), F.lit(0.1))) == -0.2


def test_total_amount_does_not_drift(spark):
    df = spark.range(100_000).select(F.lit(1).alias("q"), F.lit(0.1).alias("p"))
    assert df.agg(fn.total_amount(F.col("q"), F.col("p"))).first()[0] == 10000.0
    assert df.agg(F.sum("p")).first()[0] != 10000.0  # what a plain sum of doubles gives


def test_means_skip_missing_values(spark):
    df = spark.createDataFrame([(1, 10.0), (3, 20.0), (None, 40.0), (5, None)], "q int, p double")
    assert df.agg(fn.mean_amount(F.col("q"), F.col("p"))).first()[0] == 35.0
    assert math.isclose(df.agg(fn.mean_money(F.col("p"))).first()[0], 70 / 3)


def test_means_over_nothing_are_null(spark):
    df = spark.createDataFrame([], "q int, p double")
    out = df.agg(fn.mean_amount(F.col("q"), F.col("p")), fn.mean_money(F.col("p")), fn.total_amount(F.col("q"), F.col("p")))
    assert tuple(out.first()) == (None, None, None)


@pytest.mark.parametrize(
    ("values", "expected"), [([1, 2, 2], 1), ([2, 3], 2), ([-3, -4], -3), ([None, 5], 5), ([None], None), ([], None)]
)
def test_int_avg_truncates_toward_zero(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "n bigint")
    out = df.agg(fn.int_avg(F.col("n")).alias("mean"))
    assert out.first()[0] == expected
    assert out.schema["mean"].dataType.simpleString() == "bigint"


def test_counts(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "n int")
    out = df.agg(
        fn.row_count(),
        fn.value_count(F.col("n")),
        fn.count_where(F.col("n") >= 2),
        fn.count_where(F.col("n") < 0),
        fn.distinct_count(F.col("n")),
        fn.distinct_count(F.col("n"), rsd=0.05),
    )
    assert tuple(out.first()) == (4, 3, 2, 0, 2, 2)


def test_ratio_of_sums(spark):
    df = spark.createDataFrame([("a", 6.0, 2), ("a", 3.0, 1), ("b", 5.0, 0), ("c", None, 3)], "k string, x double, n bigint")
    out = df.groupBy("k").agg(fn.ratio_of_sums(F.col("x"), F.col("n")))
    assert rows(out, "k") == [("a", 3.0), ("b", None), ("c", None)]
