"""Small hand-made inputs."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import types as T

from lotwise.functions.clock import normalize_times
from lotwise.functions.trades import asset_class
from lotwise.schemas import ENRICHED

# close_time as text, so that unparseable values can be planted
RAW = T.StructType([
    T.StructField(f.name, T.StringType()) if f.name == "close_time" else f
    for f in ENRICHED.fields
    if f.name != "asset_class"
])


def epoch(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def _typed(field: T.StructField, value):
    if value is None:
        return None
    if isinstance(field.dataType, T.DecimalType):
        return Decimal(str(value))
    if isinstance(field.dataType, T.StringType):
        return str(value)
    return value


def raw_trades(spark, rows: list[dict]):
    """Enriched trades with defaults for what a row leaves out."""
    full = []
    for number, row in enumerate(rows):
        opened = row.get("open_time", epoch("2024-08-22 12:00:00"))
        base = {
            "id": number,
            "open_time": opened,
            "close_time": None if opened is None else opened + 600,
            "open_time_str": "2024-08-22 12:00:00",
            "symbol": "EURUSD",
            "login": 50000001,
            "type_str": "buy",
            "final_lot": 1,
            "profit": 10,
            "swap": 0,
            "type_account": "Real 100K",
            "equity": 1000,
            "starting_balance": 900,
            "email": "a@example.com",
            "country_name": "Norland",
            "created_at": "2024-08-22 12:00:00",
        }
        base.update(row)
        full.append(tuple(_typed(f, base.get(f.name)) for f in RAW.fields))
    return spark.createDataFrame(full, RAW).withColumn("asset_class", asset_class())


def trades(spark, rows: list[dict]):
    return normalize_times(raw_trades(spark, rows))


def rows(df):
    """Result rows as dicts, in order of their values."""
    return sorted((r.asDict() for r in df.collect()), key=lambda d: [str(v) for v in d.values()])
