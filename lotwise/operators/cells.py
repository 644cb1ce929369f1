"""Additive measures, per trade or pre-aggregated.

Most reports sum a few measures over different keys of the same trades. They
are written against *cells*: rows with the keys below and summable measures. A
trade is the finest cell. ``roll_up`` merges the trades of equal keys, so that
a whole report set reads the trades once and then works on the rolled-up table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.functions.trades import first_at, gain, loss, total
from lotwise.schemas import LOTS, MONEY

KEYS = ["login", "symbol", "session", "type_account", "email", "country_name", "breachedby"]
SUMS = [
    "trade_count", "lots", "lot_count", "profit", "profit_count",
    "positive_profit", "negative_profit", "swap",
]


MAXIMA = ["max_lot", "max_profit", "lot_trade", "profit_trade"]


def _known(column: str):
    return F.col(column).isNotNull().cast("bigint")


def as_cells(trades: DataFrame) -> DataFrame:
    """One cell per trade; no shuffle."""
    return trades.select(*_cell())


def _cell() -> list:
    return [
        *KEYS,
        _known("id").alias("trade_count"),
        F.coalesce("final_lot", F.lit(0).cast(LOTS)).alias("lots"),
        _known("final_lot").alias("lot_count"),
        F.coalesce("profit", F.lit(0).cast(MONEY)).alias("profit"),
        _known("profit").alias("profit_count"),
        gain().alias("positive_profit"),
        loss().alias("negative_profit"),
        F.coalesce("swap", F.lit(0).cast(MONEY)).alias("swap"),
        F.col("final_lot").alias("max_lot"),
        F.col("id").alias("first_id"),
    ]


def hour_cells(trades: DataFrame, *others: str) -> DataFrame:
    """One cell per trade with the hours of both clocks, the account's balance, numbers that order its top trades and ``others``."""
    extra = trades.select(
        "*",
        F.hour("open_time").cast("bigint").alias("open_hour"), F.hour("close_time").cast("bigint").alias("close_hour"),
        F.col("profit").alias("max_profit"),
        first_at("final_lot", "id").alias("lot_trade"), first_at("profit", "id").alias("profit_trade"),
    )
    more = ["open_hour", "close_hour", "starting_balance", "equity", *MAXIMA[1:]]
    return extra.select(*_cell(), *more, *others)


def roll_up(cells: DataFrame) -> DataFrame:
    """Merge cells of equal keys."""
    return cells.groupBy(*KEYS).agg(
        *[total(m).alias(m) for m in SUMS],
        F.max("max_lot").alias("max_lot"),
        F.min("first_id").alias("first_id"),
    )
