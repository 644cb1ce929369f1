"""Broker tables derived from the generic ``events``, ``customer`` and
``nation`` tables: every event is a trade, every customer an account holder.

Exact arithmetic only, so that any SQL engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise import schemas as S
from lotwise.functions.clock import EPOCH
from lotwise.sources.tables import BrokerTables, conform

SYMBOLS = [
    "EURUSD", "XAUUSD", "NDX100", "BTCUSD", "AUDJPY", "US30", "GBPJPY", "AUDUSD",
    "ETHUSD", "XAGUSD", "EURCHF", "GER30", "USDJPY", "ABCXYZ", "CADCHF", "UK100",
]
LOGIN_BASES = [70000000, 30000000, 50000000, 10000000]
ACCOUNT_TYPES = [
    "Phase A Real 100K", "Stellar 1-Step Demo 100K", "Evaluation P2 200K",
    "real 50K", "Phase A Demo 25K", "Phase B REAL 200K", None,
]
STARTING_BALANCES = [50000, 100000, 200000]
BROKER_CLOCK_OFFSET = 10800


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
NATION = "n_nationkey int, n_name string"


def _pick(index: str, values: list) -> str:
    """The value at a 0-based index."""
    items = ", ".join("NULL" if v is None else repr(v) for v in values)
    return f"element_at(array({items}), cast({index} + 1 AS int))"


def _login(customer_key: str) -> str:
    return f"{customer_key} + {_pick(f'{customer_key} % 4', LOGIN_BASES)}"


def _clock_text(epoch: str) -> str:
    return f"cast(timestampadd(SECOND, {epoch}, {EPOCH}) AS string)"


def sample_trades(events: DataFrame) -> DataFrame:
    base = events.selectExpr(
        "event_id AS id",
        f"{_login('user_id')} AS login",
        "event_type",
        "cast(value AS decimal(18,2)) AS v",
        # From a generator of one row: Spark moves filters on derived columns
        # below a projection, where each use would parse the JSON again.
        "explode(array(cast(get_json_object(props, '$.k') AS bigint))) AS k",
        # over an interval, as timestampdiff would go through the session time zone
        f"cast(cast(ts - {EPOCH} AS interval second) AS bigint) AS opened",
    )
    closed = base.selectExpr(
        "*",
        """CASE id % 10
             WHEN 0 THEN opened + 2 WHEN 1 THEN opened + 8 WHEN 2 THEN opened + 120
             WHEN 3 THEN CASE k % 3 WHEN 0 THEN 0 WHEN 2 THEN 10800 END
             WHEN 4 THEN opened + 172800 WHEN 5 THEN opened + 600
             ELSE opened + k * 300 END AS closed""",
    )
    trades = closed.selectExpr(
        "id", "login", "opened AS open_time", "closed AS close_time",
        f"{_pick('k % 16', SYMBOLS)} AS symbol",
        "CASE WHEN id % 2 = 0 THEN 'Buy' ELSE 'SELL' END AS type_str",
        "cast(v * 100 AS bigint) AS volume",
        "v * 0.5 AS lots",
        """CASE WHEN k <> 97 THEN v * (CASE WHEN (k + id) % 2 = 0 THEN 1 ELSE -1 END)
             + (CASE WHEN event_type = 'purchase' THEN 5 ELSE 0 END) END AS profit""",
        "k % 7 * -0.1 AS swap",
        f"{_clock_text(f'opened + {BROKER_CLOCK_OFFSET}')} AS open_time_str",
        f"{_clock_text(f'coalesce(closed, 0) + {BROKER_CLOCK_OFFSET}')} AS close_time_str",
        f"{_clock_text(f'opened + {BROKER_CLOCK_OFFSET}')} AS created_at",
        "0 AS commission", "2 AS digits", "id AS ticket",
        "NULL AS reason", "NULL AS sl", "NULL AS tp", "NULL AS open_price", "NULL AS close_price",
    )
    return conform(trades, S.TRADES)


def sample_accounts(customer: DataFrame) -> DataFrame:
    balance = f"cast({_pick('c_custkey % 3', STARTING_BALANCES)} AS decimal(18,2))"
    return conform(
        customer.selectExpr(
            "c_custkey + 1 AS id",
            f"{_login('c_custkey')} AS login",
            f"{_pick('c_custkey % 7', ACCOUNT_TYPES)} AS type",
            f"{balance} + cast(c_acctbal AS decimal(18,2)) - 3000 AS equity",
            "CASE c_mktsegment WHEN 'MACHINERY' THEN 'daily_loss' WHEN 'FURNITURE' THEN 'max_loss' END AS breachedby",
            "c_custkey AS customer_id",
            f"{balance} AS starting_balance",
        ),
        S.ACCOUNTS,
    )


def sample_customers(customer: DataFrame) -> DataFrame:
    return conform(
        customer.selectExpr(
            "c_custkey AS id",
            "CASE WHEN c_custkey % 11 <> 10 THEN lower(replace(c_name, '#', '.')) || '@example.com' END AS email",
            "c_nationkey AS country_id",
        ),
        S.CUSTOMERS,
    )


def sample_countries(nation: DataFrame) -> DataFrame:
    return conform(nation.selectExpr("n_nationkey AS id", "n_name AS name"), S.COUNTRIES)


def sample_tables(spark: SparkSession, directory: str) -> BrokerTables:
    def read(name, schema):
        return spark.read.schema(schema).parquet(f"{directory}/{name}.parquet")

    customer = read("customer", CUSTOMER)
    return BrokerTables(
        trades=sample_trades(read("events", EVENTS)),
        accounts=sample_accounts(customer),
        customers=sample_customers(customer),
        countries=sample_countries(read("nation", NATION)),
    )
