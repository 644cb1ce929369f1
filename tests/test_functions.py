from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import epoch, raw_trades, rows, trades
from lotwise.functions import clock
from lotwise.functions.trades import asset_class, final_lot, is_demo, is_p2, is_real
from lotwise.sources.sample import sample_tables


def test_final_lot_follows_the_login_family(spark):
    df = spark.createDataFrame(
        [(7012, 3.5, 200), (3012, 3.5, 200), (5070, 3.5, 200), (17012, 3.5, 200), (50, 3.5, 1)],
        "login bigint, lots double, volume bigint",
    )
    lots = [r.f for r in df.select(final_lot().alias("f")).collect()]
    assert lots == [Decimal("3.500"), Decimal("3.500"), Decimal("2.000"), Decimal("2.000"), Decimal("0.010")]


@pytest.mark.parametrize("symbol, expected", [
    ("BTCUSD", "Crypto"), ("XAUUSD", "Commodities"), ("AUDUSD", "Indices"), ("US30", "Indices"),
    ("EURUSD", "Forex"), ("eurusd", "Unknown"), ("ABC", "Unknown"), (None, "Unknown"),
])
def test_asset_class(spark, symbol, expected):
    df = spark.createDataFrame([(symbol,)], "symbol string")
    assert df.select(asset_class().alias("a")).first().a == expected


@pytest.mark.parametrize("account, real, p2", [
    ("REAL", True, False), ("real 50K", True, False), ("Surreal", True, False), (None, False, False),
    ("p2 100k", False, True), ("P2 50K", False, False), ("Stellar 1-Step Demo 200K", False, True),
    ("Stellar 2-Step Demo 200K", False, False), ("Real P2 100K", True, True),
])
def test_segments(spark, account, real, p2):
    df = spark.createDataFrame([(account,)], "type_account string")
    row = df.select(is_real().alias("real"), is_demo().alias("demo"), is_p2().alias("p2")).first()
    assert (row.real, row.demo, row.p2) == (real, not real, p2)


@pytest.mark.parametrize("at, expected", [
    ("00:14:59", "Unknown Session"), ("00:15:00", "Market-Open Session"), ("02:44:00", "Market-Open Session"),
    ("02:44:01", "Unknown Session"), ("02:44:30", "Unknown Session"), ("02:44:00.5", "Unknown Session"),
    ("02:45:00", "Prime Asia Session"), ("10:04:00", "London Opening Session"), ("10:05:00", "London Session"),
    ("21:00:00", "NY Session"), ("21:00:30", "Unknown Session"), ("21:01:00", "Late Trading Hours Session"),
    ("23:59:00", "Market-Closing Session"), ("23:59:01", "Unknown Session"), ("00:00:00", "Unknown Session"),
])
def test_session_bounds(spark, at, expected):
    df = trades(spark, [{"open_time_str": f"2024-08-22 {at}"}])
    assert df.first().session == expected


def test_session_of_a_missing_clock_is_unknown(spark):
    assert trades(spark, [{"open_time_str": None}]).first().session == "Unknown Session"


def test_unclosed_and_odd_close_times(spark):
    opened = 1724284000
    cases = {None: 0, "0": 0, "10800": 10800, "x": 0, "1724284800.0": 1724284800, "1e30": 0, "NaN": 0}
    df = trades(spark, [{"open_time": opened, "close_time": c} for c in cases])
    got = [r.h for r in df.orderBy("id").select(F.col("holding_time").alias("h")).collect()]
    assert got == [c - opened for c in cases.values()]
    closed = [r.c for r in df.orderBy("id").select(clock.is_closed().alias("c")).collect()]
    assert closed == [False, False, False, False, True, False, False]


def test_open_time_must_be_a_number(spark):
    df = raw_trades(spark, [{}]).withColumn("open_time", F.lit("x"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clock.normalize_times(df).collect()


def test_results_do_not_depend_on_the_session_time_zone(spark):
    # the clocks of New York skip 02:00 to 03:00 on this day
    texts = ["2024-03-10 02:30:00", "2024-03-10 12:00:00", "2024-03-10 00:10:00"]
    df = trades(spark, [{"open_time": epoch(t), "open_time_str": t} for t in texts])

    def result():
        sample = sample_tables(spark, "/root/testdata/sf0.001").trades
        return (
            df.select(F.hour("open_time"), "session", F.col("open_time").cast("string"), "holding_time",
                      clock.outside_hours(F.col("open_time"))).orderBy("open_time").collect(),
            sample.agg(F.sum("open_time"), F.max("close_time_str")).collect(),
        )

    zone = spark.conf.get("spark.sql.session.timeZone")
    before = result()
    assert [r.session for r in before[0]] == ["Unknown Session", "Market-Open Session", "London Session"]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert result() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_day_bounds():
    first, last = clock.day_bounds("2024-01-15")
    assert (first, last) == (1705276800, 1705363199)
    assert clock.day_bounds("2024-01-15", 3) == (first - 10800, last - 10800)


def test_window_takes_opens_and_closes_inclusively(spark):
    first, last = clock.day_bounds("2024-01-15")
    cases = [
        (first, last + 9, True), (first - 9, first, True), (last, last + 9, True), (first - 9, last, True),
        (first - 9, last + 9, False), (first - 9, first - 1, False), (last + 1, last + 9, False),
        (first - 9, None, False), (first, None, True),
    ]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "open_time bigint, close_time bigint")
    got = [bool(r.w) for r in df.select(clock.in_window(first, last).alias("w")).collect()]
    assert got == [expected for _, _, expected in cases]


def test_hour_range_ignores_dates(spark):
    df = trades(spark, [
        {"open_time": epoch("2024-08-22 00:10:00"), "close_time": epoch("2024-08-24 00:30:00")},
        {"open_time": epoch("2024-08-22 00:10:00"), "close_time": epoch("2024-08-22 01:00:00")},
    ])
    assert [r.w for r in df.orderBy("id").select(clock.within_hours(0, 1).alias("w")).collect()] == [True, False]


def test_outside_market_hours(spark):
    times = {"00:14:59": True, "00:15:00": False, "23:59:00": False, "23:59:01": True, "12:00:00": False}
    df = trades(spark, [{"open_time": epoch(f"2024-08-22 {t}")} for t in times])
    got = [r.o for r in df.orderBy("id").select(clock.outside_hours(F.col("open_time")).alias("o")).collect()]
    assert got == list(times.values())
    assert rows(df.limit(0)) == []


def test_previous_day():
    from datetime import date

    from lotwise.plans.daily import previous_day

    assert previous_day(date(2024, 3, 1)) == "2024-02-29"
    assert previous_day(date(2025, 1, 1)) == "2024-12-31"
    assert len(previous_day()) == 10
