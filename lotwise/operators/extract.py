"""Extract and enrichment: window, key reduction, joins to the account data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.functions.clock import in_window
from lotwise.functions.trades import asset_class, final_lot
from lotwise.operators.joins import BROADCAST_LIMIT_BYTES, are_small
from lotwise.sources.tables import BrokerTables

TRADE_COLUMNS = [
    "id", "open_time", "close_time", "symbol", "open_price", "close_price", "login",
    "volume", "close_time_str", "commission", "digits", "open_time_str", "profit",
    "reason", "sl", "swap", "ticket", "tp", "type_str", "created_at",
]
INTERNAL_KEYS = ["account_id", "customer_id", "country_id"]


def extract_trades(trades: DataFrame, window: tuple[int, int] | None = None) -> DataFrame:
    """Trades opened or closed in the window (epoch seconds, both included)."""
    if window is not None:
        trades = trades.where(in_window(*window))
    return trades.select(*TRADE_COLUMNS, final_lot().alias("final_lot"))


def _matching(table: DataFrame, key: str, keys: DataFrame, keys_column: str) -> DataFrame:
    # distinct first: it combines on the map side, so a hot key crosses the
    # network once per task and not once per row
    wanted = keys.select(F.col(keys_column).alias(key)).distinct()
    return table.join(wanted, key, "left_semi")


def extract_accounts(accounts: DataFrame, trades: DataFrame) -> DataFrame:
    """Accounts that own one of ``trades``."""
    return _matching(account_columns(accounts), "login", trades, "login")


def extract_customers(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Customers that own one of ``accounts``."""
    return _matching(customer_columns(customers), "customer_id", accounts, "customer_id")


def extract_countries(countries: DataFrame, customers: DataFrame) -> DataFrame:
    """Countries of ``customers``."""
    return _matching(country_columns(countries), "country_id", customers, "country_id")


def account_columns(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        F.col("id").alias("account_id"), "login", F.col("type").alias("type_account"),
        "equity", "breachedby", "customer_id", "starting_balance",
    )


def customer_columns(customers: DataFrame) -> DataFrame:
    return customers.select(F.col("id").alias("customer_id"), "email", "country_id")


def country_columns(countries: DataFrame) -> DataFrame:
    return countries.select(F.col("id").alias("country_id"), F.col("name").alias("country_name"))


def enrich(
    tables: BrokerTables, window: tuple[int, int] | None = None, broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Trades with asset class, account, customer and country columns.

    The account side is joined up first, so the trades cross the network at
    most once, whatever the number of account tables. It is broadcast if its
    tables are small. If not, and with a window, only the accounts of the window's
    trades take part, and the joins to them cut the customers and countries down.
    """
    trades = extract_trades(tables.trades, window)
    accounts = account_columns(tables.accounts)
    customers = customer_columns(tables.customers)
    countries = country_columns(tables.countries)
    small = are_small([accounts, customers, countries], broadcast_limit)
    if window is not None and not small:
        accounts = extract_accounts(tables.accounts, trades)
    holders = accounts.join(customers, "customer_id").join(countries, "country_id").drop(*INTERNAL_KEYS)
    if small:
        holders = F.broadcast(holders)
    return trades.withColumn("asset_class", asset_class()).join(holders, "login").drop(*INTERNAL_KEYS)
