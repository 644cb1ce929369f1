"""Reports over a period from stored sums of its days.

The shared passes are run once over a day's trades and stored. A report over any period merges the days' rows, a few
for each account, instead of reading the trades again; a day that changes is stored again alone. So that no trade counts
twice, a trade belongs to the day it opened, by the epoch clock. Trades without an open time belong to no day.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.operators.shared import GRAINS, grain, holders, merged_holders, merged_parts, parted_grains
from lotwise.plans.catalog import SHARED, TRADELESS

DAY = "open_date"


def store_days(trades: DataFrame, root: str) -> None:
    """Store the sums of normalised trades by day under ``root``, in two passes; days without a trade here stay as they are.

    All trades of a day have to be there: what is stored of that day is replaced.
    """
    days = trades.withColumn(DAY, F.to_date("open_time")).where(F.col(DAY).isNotNull())
    for name, table, parts in (("grains", parted_grains(days, by=DAY), [DAY, "grain"]), ("holders", holders(days, by=DAY), [DAY])):
        # adaptive execution splits a day that holds most rows over many tasks and joins small ones; ranges would need
        # a sample first, for which Spark computes all sums once more
        spread = table.hint("rebalance", *parts)
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(f"{root.rstrip('/')}/{name}")


def read_days(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Grains and holders of the days from ``first`` to ``last`` (both included, None: no bound), as if made from all their trades."""

    def days_of(name: str) -> DataFrame:
        table = spark.read.parquet(f"{root.rstrip('/')}/{name}")
        for bound, inside in ((first, F.col(DAY) >= F.lit(first).cast("date")), (last, F.col(DAY) <= F.lit(last).cast("date"))):
            table = table.where(inside) if bound else table
        return table.drop(DAY)

    return merged_parts(days_of("grains")), merged_holders(days_of("holders"))


def period_builders(spark: SparkSession, root: str, first: str | None = None, last: str | None = None):
    """Builders of the reports in ``TRADELESS`` over the days from ``first`` to ``last``."""
    summed, accounts = read_days(spark, root, first, last)
    cells = {name: grain(summed, name) for name in GRAINS}
    return {name: partial(SHARED[name], None, cells, accounts) for name in TRADELESS}
