"""Schemas of the source tables and of the enriched hand-off."""

from __future__ import annotations

from pyspark.sql import types as T

# Finer than any amount a broker books; a value that is finer still is an error
# on read (`sources.tables.exact`), never rounded.
LOTS = T.DecimalType(18, 6)
MONEY = T.DecimalType(18, 6)

TRADES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("open_time", T.LongType()),
    T.StructField("close_time", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("login", T.LongType()),
    T.StructField("volume", T.LongType()),
    T.StructField("lots", LOTS),
    T.StructField("close_time_str", T.StringType()),
    T.StructField("commission", MONEY),
    T.StructField("digits", T.IntegerType()),
    T.StructField("open_time_str", T.StringType()),
    T.StructField("profit", MONEY),
    T.StructField("reason", T.StringType()),
    T.StructField("sl", T.DoubleType()),
    T.StructField("swap", MONEY),
    T.StructField("ticket", T.LongType()),
    T.StructField("tp", T.DoubleType()),
    T.StructField("type_str", T.StringType()),
    T.StructField("created_at", T.StringType()),
])

ACCOUNTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("login", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("equity", MONEY),
    T.StructField("breachedby", T.StringType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("starting_balance", MONEY),
])

CUSTOMERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("email", T.StringType()),
    T.StructField("country_id", T.LongType()),
])

COUNTRIES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
])

# Enriched trades: the hand-off between extract and analysis.
ENRICHED = T.StructType(
    [f for f in TRADES.fields if f.name not in ("volume", "lots")]
    + [
        T.StructField("volume", T.LongType()),
        T.StructField("final_lot", LOTS),
        T.StructField("asset_class", T.StringType()),
        T.StructField("type_account", T.StringType()),
        T.StructField("equity", MONEY),
        T.StructField("breachedby", T.StringType()),
        T.StructField("starting_balance", MONEY),
        T.StructField("email", T.StringType()),
        T.StructField("country_name", T.StringType()),
    ]
)
