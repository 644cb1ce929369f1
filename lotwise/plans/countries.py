"""Reports by country. Input: cells (see ``operators.cells``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.functions.trades import total
from lotwise.operators.ranking import top_per_group
from lotwise.operators.totals import described, totals_by


def most_profitable_countries(cells: DataFrame, n: int = 10) -> DataFrame:
    return (
        totals_by(
            cells.where(F.col("country_name").isNotNull()),
            "country_name",
            total("trade_count").alias("trade_count"),
            total("lots").cast("double").alias("total_lots"),
            total("profit").cast("double").alias("total_profit"),
            distinct="login",
            name="trader_count",
        )
        .orderBy(F.col("total_profit").desc(), "country_name")
        .limit(n)
    )


def top_country_names(cells: DataFrame, n: int = 10) -> DataFrame:
    return (
        cells.where(F.col("country_name").isNotNull())
        .groupBy("country_name")
        .agg(total("profit").alias("p"))
        .orderBy(F.col("p").desc(), "country_name")
        .limit(n)
        .select("country_name")
    )


def most_profitable_logins(
    cells: DataFrame, ranked_on: DataFrame, countries: int = 10, n: int = 3, with_email: bool = True
) -> DataFrame:
    """Top logins of each of the most profitable countries.

    The countries are ranked on ``ranked_on``. The demo report ranks them on
    the real accounts too.
    """
    # `countries` rows, so the broadcast has a fixed size
    wanted = F.broadcast(top_country_names(ranked_on, countries))
    texts = {"account_type": "type_account"} | ({"email": "email"} if with_email else {})
    logins = described(
        cells.where(F.col("login").isNotNull()).join(wanted, "country_name", "left_semi"),
        ["country_name", "login"],
        {"profit": ("profit", "sum"), "trade_count": ("trade_count", "sum"), "total_lots": ("lots", "sum")},
        texts,
    )
    return top_per_group(logins, "country_name", "profit", "login", n).withColumns({
        "profit": F.col("profit").cast("double"),
        "total_lots": F.col("total_lots").cast("double"),
    })
