"""Reports by symbol. Input: cells (see ``operators.cells``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.functions.trades import total
from lotwise.operators.ranking import top_per_group
from lotwise.operators.totals import described, totals_by

ACCOUNT = ["type_account", "country_name"]


def distinct_symbols(cells: DataFrame) -> DataFrame:
    return cells.select("symbol").distinct()


def symbol_session_totals(cells: DataFrame) -> DataFrame:
    """Profit and lots per symbol and session."""
    return (
        cells.where(F.col("symbol").isNotNull())
        .groupBy("symbol", "session")
        .agg(
            total("profit").cast("double").alias("session_profit"),
            total("lots").cast("double").alias("session_lot"),
        )
    )


def _best_session(measure: str):
    """(session, profit, lots) of the session with the largest measure, ties to
    the alphabetically first session."""
    return F.min_by(
        F.struct("session", "session_profit", "session_lot"),
        F.struct(-F.col(measure), F.col("session")),
    )


def max_profit_session(cells: DataFrame) -> DataFrame:
    return symbol_session_totals(cells).groupBy("symbol").agg(_best_session("session_profit").alias("s")).select(
        "symbol",
        F.col("s.session").alias("max_profit_session"),
        F.col("s.session_profit").alias("max_profit_session_profit"),
        F.col("s.session_lot").alias("max_profit_session_lot"),
    )


def max_lot_session(cells: DataFrame) -> DataFrame:
    return symbol_session_totals(cells).groupBy("symbol").agg(_best_session("session_lot").alias("s")).select(
        "symbol",
        F.col("s.session").alias("max_lot_session"),
        F.col("s.session_lot").alias("final_lot"),
    )


def pairwise_summary(cells: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Totals per symbol with its most profitable and its largest session.

    ``pairs`` has a row at least for each symbol and login, by default the cells.
    """
    cells = cells.where(F.col("symbol").isNotNull())
    pairs = cells if pairs is None else pairs.where(F.col("symbol").isNotNull())
    # A symbol has at most 13 sessions: after this aggregate everything but the
    # distinct count works on a handful of rows.
    sessions = cells.groupBy("symbol", "session").agg(
        total("trade_count").alias("trade_count"),
        total("lots").alias("session_lot"),
        total("profit").alias("session_profit"),
    )
    summary = sessions.groupBy("symbol").agg(
        F.sum("trade_count").alias("trade_count"),
        F.sum("session_lot").cast("double").alias("total_lots"),
        F.sum("session_profit").cast("double").alias("total_profit"),
        _best_session("session_profit").alias("by_profit"),
        _best_session("session_lot").alias("by_lot"),
    )
    logins = pairs.groupBy("symbol").agg(F.countDistinct("login").alias("unique_logins"))
    return summary.join(logins, "symbol").select(
        "symbol", "trade_count", "total_lots", "total_profit", "unique_logins",
        F.col("by_profit.session").alias("max_profit_session"),
        F.col("by_profit.session_profit").cast("double").alias("max_profit_session_profit"),
        F.col("by_profit.session_lot").cast("double").alias("max_profit_session_lot"),
        F.col("by_lot.session").alias("max_lot_session"),
        F.col("by_lot.session_lot").cast("double").alias("final_lot"),
    )


def symbol_summary(cells: DataFrame) -> DataFrame:
    """Totals per symbol over all accounts, with lots per trade and per trader."""
    lots = F.col("final_lot")
    return (
        totals_by(
            cells.where(F.col("symbol").isNotNull()),
            "symbol",
            total("trade_count").alias("trade_count"),
            total("profit").cast("double").alias("total_profit"),
            total("positive_profit").cast("double").alias("positive_trades_sum"),
            total("negative_profit").cast("double").alias("negative_trades_sum"),
            total("lots").cast("double").alias("final_lot"),
            distinct="login",
            name="trader_count",
        )
        .withColumn("final_lot_per_trade", F.try_divide(lots, F.col("trade_count")))
        .withColumn("final_lot_per_trader", F.try_divide(lots, F.col("trader_count")))
    )


def _per_symbol_login(cells: DataFrame, measures: dict) -> DataFrame:
    known = F.col("symbol").isNotNull() & F.col("login").isNotNull()
    return described(
        cells.where(known), ["symbol", "login"], measures,
        {"account_type": "type_account", "country_name": "country_name"})


def top_logins(cells: DataFrame, n: int = 3) -> DataFrame:
    """Most profitable logins of each symbol; ``current_pnl`` holds their lots."""
    logins = _per_symbol_login(cells, {"profit": ("profit", "sum"), "current_pnl": ("lots", "sum")})
    return top_per_group(logins, "symbol", "profit", "login", n).select(
        "symbol", "login", F.col("profit").cast("double").alias("profit"), "account_type",
        F.col("current_pnl").cast("double").alias("current_pnl"), "country_name",
    )


def top_lots_per_trade(cells: DataFrame, n: int = 3) -> DataFrame:
    """Logins with the largest single trade of each symbol."""
    logins = _per_symbol_login(cells, {"max_lot_per_trade": ("max_lot", "max"), "current_pnl": ("profit", "sum")})
    return top_per_group(logins, "symbol", "max_lot_per_trade", "login", n).select(
        "symbol", "login", F.col("max_lot_per_trade").cast("double").alias("max_lot_per_trade"), "account_type",
        F.col("current_pnl").cast("double").alias("current_pnl"), "country_name",
    )


def symbol_pnl_summary(cells: DataFrame) -> DataFrame:
    """Profit per symbol; the report uses real accounts that are not breached."""
    return (
        cells.where(F.col("symbol").isNotNull())
        .groupBy("symbol")
        .agg(
            total("profit").cast("double").alias("total_pnl"),
            total("positive_profit").cast("double").alias("positive_profit_total"),
            total("trade_count").alias("trade_count"),
        )
    )


def top_symbols(cells: DataFrame, by: str, n: int = 5) -> DataFrame:
    """Top symbols by ``total_pnl`` or ``trade_count``."""
    return symbol_pnl_summary(cells).orderBy(F.col(by).desc(), "symbol").limit(n)


def swap_summary(cells: DataFrame) -> DataFrame:
    known = F.col("symbol").isNotNull() & F.col("login").isNotNull()
    return cells.where(known).groupBy("login", "symbol").agg(total("swap").cast("double").alias("swap"))
