"""Trading-behaviour reports. Input: normalised trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise import constants as K
from lotwise.functions.clock import is_closed, within_hours
from lotwise.functions.trades import total

# seconds that a trade is held
FAST, VERY_FAST, QUICK = 9, 3, 180


def _hft_measures(fast: int, very_fast: int) -> list[Column]:
    """Of an account's trades that close after they open."""
    forward = F.col("close_time") > F.col("open_time")
    return [
        F.count_if(forward & (F.col("holding_time") <= fast)).alias("fast"),
        F.count_if(forward & (F.col("holding_time") <= very_fast)).alias("very_fast"),
        F.count_if(forward).alias("forward"),
        F.min(F.when(forward, F.col("id"))).alias("forward_id"),
        F.min_by("equity", F.when(forward, F.col("id"))).alias("forward_equity"),
    ]


def hft_summary(trades: DataFrame, fast: int = FAST, very_fast: int = VERY_FAST, n: int = 20) -> DataFrame:
    """Logins with most trades held ``fast`` seconds or less."""
    # The account type is a grouping key first, so that the pass over the
    # trades is a hash aggregate; one row per login and type remains.
    forward = trades.where((F.col("close_time") > F.col("open_time")) & F.col("login").isNotNull())
    return hft_of(forward.groupBy("login", "type_account").agg(*_hft_measures(fast, very_fast)), fast, very_fast, n)


def hft_of(accounts: DataFrame, fast: int = FAST, very_fast: int = VERY_FAST, n: int = 20) -> DataFrame:
    """The same from rows that add up to logins, with the measures of the same bounds."""
    return (
        accounts.where("forward > 0").groupBy("login")
        .agg(
            F.sum("fast").alias(f"trades_le_{fast}s"),
            F.sum("very_fast").alias(f"trades_le_{very_fast}s"),
            F.sum("forward").alias("total_trades"),
            F.min_by("forward_equity", "forward_id").cast("double").alias("equity"),
            F.min_by("type_account", "forward_id").alias("type_account"),
        )
        .where(F.col(f"trades_le_{fast}s") > 0)
        .withColumn(f"ratio_le_{very_fast}s", F.col(f"trades_le_{very_fast}s") / F.col("total_trades"))
        .orderBy(F.col(f"trades_le_{fast}s").desc(), "login")
        .limit(n)
    )


def _forex_settlement() -> Column:
    return (F.col("asset_class") == "Forex") & is_closed() & within_hours(0, 1)


def _indices_settlement() -> Column:
    return (F.col("asset_class") == "Indices") & is_closed() & within_hours(1, 2)


def _illiquid(pairs=K.LOW_LIQUIDITY_PAIRS) -> Column:
    watched = F.col("symbol").isin(pairs) & F.col("asset_class").isin(list(K.ASSET_CLASSES))
    return watched & is_closed() & within_hours(22, 24)


def count_where(trades: DataFrame, condition: Column, min_count: int = 5) -> DataFrame:
    """Logins with ``min_count`` or more trades that meet a condition."""
    met = trades.where(condition & F.col("login").isNotNull())
    return often(met.groupBy("login").agg(F.count(F.lit(1)).alias("trade_count")), "trade_count", min_count)


def often(accounts: DataFrame, count: str, min_count: int = 5) -> DataFrame:
    """The same from rows that add up to logins."""
    return accounts.groupBy("login").agg(F.sum(count).alias("trade_count")).where(F.col("trade_count") >= min_count)


def settlement_forex(trades: DataFrame, min_count: int = 5) -> DataFrame:
    return count_where(trades, _forex_settlement(), min_count)


def settlement_indices(trades: DataFrame, min_count: int = 5) -> DataFrame:
    return count_where(trades, _indices_settlement(), min_count)


def ll_hour(trades: DataFrame, min_count: int = 5, pairs=K.LOW_LIQUIDITY_PAIRS) -> DataFrame:
    """Trading of illiquid pairs in the last two hours of the day."""
    return count_where(trades, _illiquid(pairs), min_count)


def _held_measures(fast: int) -> list[Column]:
    return [
        # in double: a bigint of seconds could overflow on unclosed trades
        F.sum(F.col("holding_time").cast("double")).alias("held"),
        F.count("holding_time").alias("held_count"),
        F.max("holding_time").alias("longest"),
        F.min("holding_time").alias("shortest"),
        F.count("id").alias("trade_count"),
        F.count(F.lit(1)).alias("rows"),
        total("final_lot").alias("lots"),
        total("profit").alias("profit"),
        F.count_if(F.col("holding_time") <= fast).alias("quick"),
    ]


def holder_measures() -> list[Column]:
    """What the behaviour reports with default bounds need of an account's trades."""
    return [
        *_hft_measures(FAST, VERY_FAST),
        *_held_measures(QUICK),
        F.count_if(_forex_settlement()).alias("forex_settlement"),
        F.count_if(_indices_settlement()).alias("indices_settlement"),
        F.count_if(_illiquid()).alias("illiquid"),
    ]


def merged_measures() -> list[Column]:
    """The same measures from rows that hold them for different trades."""
    sums = [
        "fast", "very_fast", "forward", "held", "held_count", "trade_count", "rows", "lots", "profit", "quick",
        "forex_settlement", "indices_settlement", "illiquid",
    ]
    return [
        *[F.sum(name).alias(name) for name in sums],
        F.max("longest").alias("longest"),
        F.min("shortest").alias("shortest"),
        F.min_by("forward_equity", "forward_id").alias("forward_equity"),
        F.min("forward_id").alias("forward_id"),
    ]


def arbitrage_traders(trades: DataFrame, fast: int = QUICK, closed_only: bool = False) -> DataFrame:
    """Holding times per (login, email, account type).

    ``trades_within_3_min`` counts all fast trades of the login, so its share of
    one group's trades can exceed 100. Trades still open count as held until
    1970 unless ``closed_only``.
    """
    if closed_only:
        trades = trades.where(is_closed())
    trades = trades.where(F.col("login").isNotNull())
    group = ["login", "email", "type_account"]
    # Country as a key makes its mode a plain count; the groups above it are
    # then merged from one row per country.
    accounts = trades.groupBy(*group, "country_name").agg(*_held_measures(fast))
    return arbitrage_of(accounts)


def arbitrage_of(accounts: DataFrame) -> DataFrame:
    """The same from one row per login, email, account type and country."""
    group = ["login", "email", "type_account"]
    by_country = accounts.where(F.col("email").isNotNull() & F.col("type_account").isNotNull())
    known_country = F.when(F.col("country_name").isNotNull(), F.struct(-F.col("rows"), F.col("country_name")))
    groups = by_country.groupBy(*group).agg(
        (F.sum("held") / F.sum("held_count") / 60).alias("average_holding_time"),
        (F.max("longest") / 60).alias("max_holding_time"),
        (F.min("shortest") / 60).alias("min_holding_time"),
        F.sum("trade_count").alias("trade_count"),
        F.sum("lots").cast("double").alias("total_used_lot"),
        F.sum("profit").cast("double").alias("total_profit"),
        F.min_by("country_name", known_country).alias("country"),
    ).dropna(subset=["average_holding_time", "max_holding_time", "min_holding_time"])
    quick = accounts.groupBy("login").agg(F.sum("quick").alias("trades_within_3_min"))
    share = F.try_divide(F.col("trades_within_3_min"), F.col("trade_count")) * 100
    return (
        groups.join(quick, "login")
        .select(
            *group, "average_holding_time", "max_holding_time", "min_holding_time", "trade_count",
            "trades_within_3_min", share.alias("trades_within_3_min_pct"),
            "total_used_lot", "total_profit", "country",
        )
    )
