"""Data-quality checks. Input: normalised trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.functions.clock import outside_hours

COLUMNS = ["login", "symbol", "open_time", "final_lot", "profit"]


def _rows(trades: DataFrame) -> DataFrame:
    return trades.select(*COLUMNS).withColumns({
        "final_lot": F.col("final_lot").cast("double"),
        "profit": F.col("profit").cast("double"),
    })


def missing_open_time(trades: DataFrame) -> DataFrame:
    return _rows(trades.where(F.col("open_time").isNull()))


def outlier_open_time(trades: DataFrame) -> DataFrame:
    """Trades opened outside market hours."""
    return _rows(trades.where(outside_hours(F.col("open_time"))))
