"""Sums and a distinct count over one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.trades import first_known, total


def totals_by(df: DataFrame, key: str, *measures: Column, distinct: str, name: str) -> DataFrame:
    """``measures`` per ``key`` and the number of distinct ``distinct`` values.

    In one aggregate Spark would shuffle a row with all partial sums per pair
    of key and distinct value. Apart, the sums shrink to one row per key and
    task, and the pairs travel without them. ``key`` must not be null.
    """
    sums = df.groupBy(key).agg(*measures)
    counts = df.groupBy(key).agg(F.countDistinct(distinct).alias(name))
    return sums.join(counts, key)


def described(cells: DataFrame, keys: list[str], measures: dict[str, tuple[str, str]], texts: dict[str, str]) -> DataFrame:
    """Sums or maxima per ``keys``, and the first known value of some text columns.

    ``measures`` gives (column, ``sum`` or ``max``) by name, ``texts`` the column by
    name. A text in an aggregate makes it sort its input, so the texts are keys of a
    first aggregate; they hardly differ within the keys, which leaves little to the
    second one.
    """
    how = {"sum": total, "max": F.max}
    first = cells.groupBy(*dict.fromkeys([*keys, *texts.values()])).agg(
        *[how[kind](column).alias(name) for name, (column, kind) in measures.items()],
        F.min("first_id").alias("first_id"),
    )
    first = first.withColumns({name: F.col(column) for name, column in texts.items()})
    return first.groupBy(*keys).agg(
        *[how[kind](name).alias(name) for name, (_, kind) in measures.items()],
        *[first_known(name, "first_id").alias(name) for name in texts],
    )
