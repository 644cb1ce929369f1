"""What many reports sum up, from shared passes over the trades.

A report that scans the trades itself costs a scan of all days' columns for a handful
of sums. Two passes serve most reports instead. ``grains`` sums the same measures
over several key sets: Spark expands every trade to one row a key set and combines
these in the map tasks, so what is shuffled and stored is the key sets' distinct
values. ``holders`` has one key set, the account, and the measures of trading
behaviour, which would only burden the rows of the other key sets.

Distinct logins of a key are rows of a key set that holds the login, so they stay
exact. Tables of several days merge into those of the period, see ``merged_grains``
and ``merged_holders``: sums add up, and first and last values go by the trade ids
that are kept with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.trades import is_real, is_unbreached, total
from lotwise.operators.cells import MAXIMA, SUMS, hour_cells
from lotwise.plans import behaviour
from lotwise.schemas import LOTS, MONEY

# Key sets by name. ``real`` and ``unbreached`` are the segments of an account, see plans.segments.
GRAINS = {
    "session": ("real", "unbreached", "symbol", "session"),
    "pair": ("real", "symbol", "login", "type_account", "country_name"),
    "account": ("real", "login", "type_account", "email", "country_name"),
    "balance": ("real", "login", "starting_balance"),
    "open_hour": ("real", "open_hour", "country_name"),
    "open_login": ("real", "open_hour", "login"),
    "close_hour": ("real", "close_hour", "country_name"),
    "close_login": ("real", "close_hour", "login"),
}
HOLDER = ("login", "email", "type_account", "country_name")

# The sums of amounts, with the type of a trade's amount. A sum is made in two parts, numbers of 2^30 millionths and what
# is left of the millionths: sums of bigints cost less than those of long decimals, and hold 2^33 trades of any amounts.
# What is negative of the profit is the rest of it.
AMOUNTS = {"lots": LOTS, "profit": MONEY, "positive_profit": MONEY, "swap": MONEY}
COUNTS = [m for m in SUMS if m not in (*AMOUNTS, "negative_profit")]
PARTS = [f"{m}_{part}" for m in AMOUNTS for part in ("high", "low")]
PART_BITS = 30


def _grain(names: list[str]) -> Column:
    """The name of a row's key set, from the bits of the keys that are not in it."""
    name = F.lit(None).cast("string")
    for grain, keys in GRAINS.items():
        missing = sum(1 << place for place, key in enumerate(reversed(names)) if key not in keys)
        name = F.when(F.grouping_id() == missing, F.lit(grain)).otherwise(name)
    return name


def _keys() -> list[str]:
    return list(dict.fromkeys(key for keys in GRAINS.values() for key in keys))


def _parted(cells: DataFrame) -> DataFrame:
    """Cells with the parts of their amounts."""
    # few expressions: with more, the code that Spark generates for a row passes 8,000 bytes, beyond which Java interprets it
    unit = {m: F.expr(f"cast({m} * {10**AMOUNTS[m].scale} AS bigint)") for m in ("lots", "profit", "swap")}
    unit["positive_profit"] = F.greatest(unit["profit"], F.lit(0))
    parts = {}
    for m in AMOUNTS:
        parts |= {f"{m}_high": F.shiftright(unit[m], PART_BITS), f"{m}_low": unit[m].bitwiseAND(F.lit(2**PART_BITS - 1))}
    return cells.withColumns(parts)


def whole_grains(table: DataFrame) -> DataFrame:
    """Grains with sums of amounts from those with parts."""
    wide = "cast({} AS decimal(19, 0))"
    amounts = {
        m: F.expr(f"cast(({wide.format(m + '_high')} * {2**PART_BITS} + {wide.format(m + '_low')}) * 1e-{kind.scale}BD AS decimal(28, {kind.scale}))")
        for m, kind in AMOUNTS.items()
    }
    amounts["negative_profit"] = (amounts["profit"] - amounts["positive_profit"]).cast(f"decimal(28, {MONEY.scale})")
    kept = [c for c in table.columns if c not in PARTS and c not in SUMS]
    place = kept.index(MAXIMA[0])
    return table.select(*kept[:place], *[F.coalesce(amounts[m], F.lit(0)).alias(m) if m in amounts else m for m in SUMS], *kept[place:])


def grains(trades: DataFrame, by: str | None = None) -> DataFrame:
    """Cells of every key set in ``GRAINS``, told apart by ``grain``; keys outside a row's set are null. One scan, one shuffle.

    With a column ``by`` of the trades, it is a key of every set, and the rows of each of its values are the table of these trades.
    """
    return _summed(_cells(trades, by), [total(m).alias(m) for m in SUMS], by)


def parted_grains(trades: DataFrame, by: str | None = None) -> DataFrame:
    """The same with the sums of amounts in parts, to be stored and merged, see ``merged_parts``."""
    return _summed(_parted(_cells(trades, by)), [F.sum(m).alias(m) for m in COUNTS + PARTS], by)


def _cells(trades: DataFrame, by: str | None) -> DataFrame:
    return hour_cells(trades, *([by] if by else [])).withColumns({"real": is_real(), "unbreached": is_unbreached()})


def _summed(cells: DataFrame, sums: list[Column], by: str | None) -> DataFrame:
    names, own = _keys(), [F.col(by)] if by else []
    return cells.groupingSets([[*own, *map(F.col, keys)] for keys in GRAINS.values()], *own, *names).agg(
        _grain(names).alias("grain"),
        *sums,
        *[F.max(m).alias(m) for m in MAXIMA],
        F.min("first_id").alias("first_id"),
        F.max("first_id").alias("last_id"),
        F.max_by("equity", "first_id").alias("last_equity"),
    )


def merged_grains(table: DataFrame) -> DataFrame:
    """One table of grains from the rows of several, if no trade is in two of them."""
    return _like(_merged(table, SUMS), table)


def merged_parts(table: DataFrame) -> DataFrame:
    """One table of grains from the rows of several with parts."""
    return whole_grains(_like(_merged(table, COUNTS + PARTS), table))


def _merged(table: DataFrame, sums: list[str]) -> DataFrame:
    return table.groupBy("grain", *_keys()).agg(
        *[total(m).alias(m) for m in sums],
        *[F.max(m).alias(m) for m in MAXIMA],
        F.min("first_id").alias("first_id"),
        F.max_by("last_equity", "last_id").alias("last_equity"),
        F.max("last_id").alias("last_id"),
    )


def _like(merged: DataFrame, table: DataFrame) -> DataFrame:
    """Columns and types of ``table``; a sum of sums would be a wider decimal."""
    return merged.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields if f.name in merged.columns])


def grain(table: DataFrame, name: str) -> DataFrame:
    """The cells of one key set, without the keys of the others."""
    others = {key for keys in GRAINS.values() for key in keys} - set(GRAINS[name])
    return table.where(F.col("grain") == name).drop("grain", *others)


def holders(trades: DataFrame, by: str | None = None) -> DataFrame:
    """One row per account (``HOLDER``), and value of ``by``, with the measures of all reports on trading behaviour."""
    own = [by] if by else []
    return trades.where(F.col("login").isNotNull()).groupBy(*own, *HOLDER).agg(*behaviour.holder_measures())


def merged_holders(table: DataFrame) -> DataFrame:
    """One row per account from the rows of several tables, if no trade is in two of them."""
    return _like(table.groupBy(*HOLDER).agg(*behaviour.merged_measures()), table)
