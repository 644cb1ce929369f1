"""Reports by login. Input: normalised trades, or cells where named so."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.functions.trades import first_known, total


def high_pnl_traders(trades: DataFrame, n: int = 10, ranked_on: DataFrame | None = None) -> DataFrame:
    """Logins with the highest profit, with their best trade and main country.

    ``ranked_on`` are cells of the same trades, by default the trades.
    """
    trades = trades.where(F.col("login").isNotNull())
    ranked_on = trades if ranked_on is None else ranked_on.where(F.col("login").isNotNull())
    # Rank on the one sum that decides, then describe the winners: the wide
    # aggregate (mode, arg-max, texts) sees the trades of n logins only.
    top = (
        ranked_on.groupBy("login").agg(total("profit").alias("p"))
        .orderBy(F.col("p").desc(), "login").limit(n).select("login")
    )
    best_trade = F.when(F.col("profit").isNotNull(), F.struct("profit", -F.col("id")))
    return (
        trades.join(F.broadcast(top), "login", "left_semi")
        .groupBy("login")
        .agg(
            total("profit").cast("double").alias("profit"),
            F.mode("country_name", deterministic=True).alias("country_name"),
            F.max("profit").cast("double").alias("highest_profit_trade"),
            F.max_by("symbol", best_trade).alias("highest_profit_pair"),
            F.max("final_lot").cast("double").alias("highest_used_lot"),
            total("final_lot").cast("double").alias("total_used_lot"),
            F.count("id").alias("trade_count"),
            first_known("email", "id").alias("email"),
        )
        .orderBy(F.col("profit").desc(), "login")
        .limit(n)
    )


def login_trade_lot(trades: DataFrame) -> DataFrame:
    """Trade count and lots per login, with the first known account data."""
    return (
        trades.where(F.col("login").isNotNull())
        .groupBy("login")
        .agg(
            F.count("id").alias("trade_count"),
            total("final_lot").cast("double").alias("total_lots"),
            first_known("country_name", "id").alias("country_name"),
            first_known("email", "id").alias("email"),
            first_known("type_account", "id").alias("account_type"),
            first_known("created_at", "id").alias("created_at"),
        )
    )


def today_pnl_by_login(cells: DataFrame) -> DataFrame:
    return (
        cells.where(F.col("login").isNotNull()).groupBy("login")
        .agg(total("profit").cast("double").alias("today_pnl"))
    )


def _balances(trades: DataFrame) -> DataFrame:
    """Per login and starting balance: profit, first and last trade, last equity."""
    return (
        trades.where(F.col("login").isNotNull())
        .groupBy("login", "starting_balance")
        .agg(
            total("profit").alias("profit"),
            F.min("id").alias("first_id"),
            F.max("id").alias("last_id"),
            F.max_by("equity", "id").alias("last_equity"),
        )
    )


def _pnl(balances: DataFrame) -> DataFrame:
    overall = F.max_by("last_equity", "last_id") - F.min_by("starting_balance", "first_id")
    return balances.groupBy("login").agg(F.sum("profit").alias("today_pnl"), overall.alias("overall_pnl"))


def overall_pnl_by_login(trades: DataFrame) -> DataFrame:
    """Equity at the last trade minus starting balance at the first."""
    return _pnl(_balances(trades)).select("login", F.col("overall_pnl").cast("double").alias("overall_pnl"))


def positive_pnl_traders(trades: DataFrame) -> DataFrame:
    """Logins in profit today and overall; one row per distinct starting balance."""
    return positive_pnl_of(_balances(trades))


def positive_pnl_of(balances: DataFrame) -> DataFrame:
    """The same from rows of login and starting balance, see ``_balances``."""
    balances = balances.where(F.col("login").isNotNull())
    winners = _pnl(balances).where("today_pnl > 0 AND overall_pnl > 0")
    return winners.join(balances.select("login", "starting_balance"), "login").select(
        "login",
        F.col("today_pnl").cast("double").alias("today_pnl"),
        F.col("overall_pnl").cast("double").alias("overall_pnl"),
        F.col("starting_balance").cast("double").alias("starting_balance"),
    )


def positive_pnl_trades(trades: DataFrame, unbreached: DataFrame) -> DataFrame:
    """Trades in ``unbreached`` of the positive-PnL traders among ``trades``."""
    winners = _pnl(_balances(trades)).where("today_pnl > 0 AND overall_pnl > 0")
    return unbreached.join(winners.select("login"), "login", "left_semi")


def most_active_session_per_login(cells: DataFrame) -> DataFrame:
    """Session with most trades of each login, ties to the first by name."""
    return (
        cells.where(F.col("login").isNotNull())
        .groupBy("login", "session")
        .agg(total("trade_count").alias("trade_count"))
        .groupBy("login")
        .agg(
            F.min_by("session", F.struct(-F.col("trade_count"), F.col("session"))).alias("session"),
            F.max("trade_count").alias("trade_count"),
        )
    )
