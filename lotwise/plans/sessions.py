"""Reports by trading session. Input: cells (see ``operators.cells``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise import constants as K
from lotwise.functions.trades import total


def session_ranges(spark: SparkSession, sessions=K.SESSIONS) -> DataFrame:
    rows = ", ".join(f"('{name}', '{first} - {last}')" for name, first, last in sessions)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS ranges(session, session_time_range)")


def session_summary(cells: DataFrame) -> DataFrame:
    """Totals and means per session, without trades outside all sessions."""
    totals = (
        cells.groupBy("session")
        .agg(
            total("lots").cast("double").alias("lot_used"),
            total("trade_count").alias("number_of_trades"),
            total("profit").cast("double").alias("total_pnl"),
            F.sum("profit_count").alias("profit_count"),
            F.sum("lot_count").alias("lot_count"),
        )
    )
    # Twelve constant rows. The inner join drops the trades outside all sessions;
    # a filter would be pushed below the session column and compute it twice.
    ranges = F.broadcast(session_ranges(cells.sparkSession))
    return totals.join(ranges, "session").select(
        "session", "session_time_range", "lot_used", "number_of_trades", "total_pnl",
        F.try_divide(F.col("total_pnl"), F.col("profit_count")).alias("average_pnl"),
        F.try_divide(F.col("lot_used"), F.col("lot_count")).alias("average_lot"),
    )
