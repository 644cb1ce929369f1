"""Trade history stored by day, so that a window opens only the files of its own days.

``opened`` holds every trade under the UTC day of its open time. ``closed`` holds the trades that close on another day once
more, under that day. So the trades of a window are in the window's days of these two tables, however long a trade was held.
Days are numbers, counted from 1970-01-01.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lotwise import schemas as S
from lotwise.functions.clock import in_window
from lotwise.sources.tables import TABLE_SCHEMAS, BrokerTables, conform

DAY_SECONDS = 86400


def day_number(seconds: str) -> Column:
    """The day of an epoch second; exact for every whole number, also before 1970."""
    return F.expr(f"({seconds} - pmod({seconds}, {DAY_SECONDS})) div {DAY_SECONDS}")


def write_history(trades: DataFrame, root: str) -> None:
    """Write or replace the history under ``root``.

    A day's files are ranges of trade ids, so a day that holds most trades is written by many tasks, and a small one by one.
    A trade without a close time, or that closes on the day it opens, is stored once, all others twice. Trades without an
    open time have a folder of their own in ``opened``.
    """
    days = trades.withColumns({"open_day": day_number("open_time"), "close_day": day_number("close_time")})
    elsewhere = days.where("close_day IS NOT NULL AND NOT (close_day <=> open_day)")
    for name, rows, day in (("opened", days, "open_day"), ("closed", elsewhere, "close_day")):
        kept = rows.select(*S.TRADES.names, day)
        kept.repartitionByRange(day, "id").write.mode("overwrite").partitionBy(day).parquet(f"{root.rstrip('/')}/{name}")


def read_history(spark: SparkSession, root: str, window: tuple[int, int]) -> DataFrame:
    """Trades opened or closed in the window (epoch seconds, both included), each once."""
    first, last = window
    first_day, last_day = first // DAY_SECONDS, last // DAY_SECONDS

    def days_of(name: str, day: str) -> DataFrame:
        schema = T.StructType([*S.TRADES.fields, T.StructField(day, T.LongType())])
        return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}").where(F.col(day).between(first_day, last_day))

    opened = days_of("opened", "open_day").where(in_window(first, last))
    # what opened on one of these days has been found above
    found = F.col("open_time").between(first_day * DAY_SECONDS, (last_day + 1) * DAY_SECONDS - 1)
    closed = days_of("closed", "close_day").where(F.col("close_time").between(first, last) & ~F.coalesce(found, F.lit(False)))
    return opened.select(*S.TRADES.names).unionByName(closed.select(*S.TRADES.names))


def read_history_tables(spark: SparkSession, root: str, window: tuple[int, int]) -> BrokerTables:
    """The window's trades from ``<root>/history`` and the account tables stored as ``<root>/<name>`` parquet datasets."""
    root = root.rstrip("/")
    accounts = {
        name: conform(spark.read.parquet(f"{root}/{name}"), schema) for name, schema in TABLE_SCHEMAS.items() if name != "trades"
    }
    return BrokerTables(trades=read_history(spark, f"{root}/history", window), **accounts)
