"""Activity by hour of day. Input: normalised trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.functions.clock import is_closed
from lotwise.functions.trades import total
from lotwise.operators.cells import hour_cells


def hour_summary(cells: DataFrame, name: str, pairs: DataFrame | None = None) -> DataFrame:
    """Totals per hour of a clock, with the countries of the largest and of the
    most profitable trade (ties to the first trade). ``cells`` have the hour as ``name``;
    ``pairs`` has a row at least for each hour and login, by default the cells."""
    hourly = cells.where(F.col(name).isNotNull())
    pairs = hourly if pairs is None else pairs.where(F.col(name).isNotNull())
    # Carrying the texts of the top trades through an aggregate of the trades would
    # turn it from a hash into a sort aggregate. So the country is a key first; a
    # second aggregate, over a few thousand rows, picks the countries.
    by_country = hourly.groupBy(name, "country_name").agg(
        total("trade_count").alias("trade_count"),
        total("lots").alias("total_lots"),
        total("profit").alias("total_profit"),
        F.max("max_lot").alias("top_lot"),
        F.max("max_profit").alias("top_profit"),
        F.max("lot_trade").alias("lot_trade"),
        F.max("profit_trade").alias("profit_trade"),
    )
    totals = by_country.groupBy(name).agg(
        F.sum("trade_count").alias("trade_count"),
        F.sum("total_lots").cast("double").alias("total_lots"),
        F.sum("total_profit").cast("double").alias("total_profit"),
        F.max_by("country_name", "lot_trade").alias("highest_lot_country"),
        F.max("top_lot").cast("double").alias("highest_lot_country_lot"),
        F.max_by("country_name", "profit_trade").alias("highest_profit_country"),
        F.max("top_profit").cast("double").alias("highest_profit_country_profit"),
    )
    logins = pairs.groupBy(name).agg(F.countDistinct("login").alias("unique_logins"))
    return totals.join(logins, name).select(
        name, "trade_count", "total_lots", "total_profit", "unique_logins", "highest_lot_country",
        "highest_lot_country_lot", "highest_profit_country", "highest_profit_country_profit",
    )


def open_hour_summary(trades: DataFrame) -> DataFrame:
    return hour_summary(hour_cells(trades), "open_hour")


def close_hour_summary(trades: DataFrame, closed_only: bool = False) -> DataFrame:
    """Trades still open count in the hour of their placeholder close, unless
    ``closed_only``."""
    if closed_only:
        trades = trades.where(is_closed())
    return hour_summary(hour_cells(trades), "close_hour")
