"""Column expressions on a single trade: lot size, asset class, segment."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lotwise import constants as K
from lotwise.schemas import LOTS, MONEY


def final_lot(login="login", lots="lots", volume="volume", prefixes=K.LOT_BASED_LOGIN_PREFIXES) -> Column:
    """Lots as booked for lot-based logins, hundredths of the volume otherwise."""
    lot_based = " OR ".join(f"cast({login} AS string) LIKE '{prefix}%'" for prefix in prefixes)
    return F.expr(f"cast(CASE WHEN {lot_based} THEN {lots} ELSE {volume} * 0.01 END AS {LOTS.simpleString()})")


def asset_class(symbol="symbol", classes=K.ASSET_CLASSES) -> Column:
    """Asset class of a symbol; the first class that lists it wins."""
    cases = " ".join(f"WHEN {symbol} IN {sql_list(symbols)} THEN '{name}'" for name, symbols in classes.items())
    return F.expr(f"CASE {cases} ELSE '{K.UNKNOWN_ASSET_CLASS}' END")


def sql_list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def is_real(type_account="type_account") -> Column:
    """Real-money account; an account without a type is not real."""
    return F.coalesce(F.lower(type_account).contains(K.REAL_MARK), F.lit(False))


def is_demo(type_account="type_account") -> Column:
    return ~is_real(type_account)


def is_p2(type_account="type_account") -> Column:
    """Second-phase programme accounts of the two largest sizes."""
    kind = F.col(type_account)
    return F.coalesce(kind.rlike(K.P2_PROGRAM_PATTERN) & kind.rlike(K.P2_SIZE_PATTERN), F.lit(False))


def is_unbreached(breachedby="breachedby") -> Column:
    return F.col(breachedby).isNull()


def signed_lot(lot="final_lot", side="type_str") -> Column:
    """Positive for buys, negative for every other side."""
    size = F.coalesce(F.col(lot), F.lit(0).cast(LOTS))
    return F.when(F.lower(side) == "buy", size).otherwise(-size)


def gain(profit="profit") -> Column:
    return F.when(F.col(profit) > 0, F.col(profit)).otherwise(F.lit(0).cast(MONEY))


def loss(profit="profit") -> Column:
    return F.when(F.col(profit) < 0, F.col(profit)).otherwise(F.lit(0).cast(MONEY))


def total(column: str) -> Column:
    """Sum that is 0, not null, when every value is null."""
    return F.coalesce(F.sum(column), F.lit(0))


def first_at(amount: str, order: str) -> Column:
    """A number that is largest for the largest ``amount``, and there for the smallest ``order``.

    Unlike a struct, a decimal is aggregated by hash. ``amount`` has up to 18
    digits, ``order`` is a bigint.
    """
    scale = 10**MONEY.scale
    return F.expr(f"cast({amount} * {scale} AS decimal(18, 0)) * 10000000000000000000 - {order}")


def first_known(column: str, order: str) -> Column:
    """First non-null value in ``order``."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))
