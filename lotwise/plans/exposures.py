"""Exposure reports. Input: normalised trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise import constants as K
from lotwise.operators.exposure import exposure_breaches
from lotwise.operators.lineage import stored
from lotwise.operators.ranking import number_rows

COLUMNS = ["login", "max_total_lots", "equity", "package_type", "breachedby", "pnl"]


def class_exposure(trades: DataFrame, asset_class: str, limits=K.EXPOSURE_LIMITS, **options) -> DataFrame:
    """Breaching logins of one asset class."""
    only = {asset_class: limits[asset_class]}
    return exposure_breaches(trades, only, stage=stored, **options).select(*COLUMNS)


def exposure_combined(trades: DataFrame, limits=K.EXPOSURE_LIMITS, **options) -> DataFrame:
    """The breaching logins of all classes side by side: the n-th login of each
    class, in login order, shares row n. Logins in one row are unrelated.

    Numbering reads the breaching logins several times, so they are stored first."""
    breaches = stored(exposure_breaches(trades, limits, stage=stored, **options), "exposure-breaches")
    numbered = number_rows(breaches, "asset_class", "login")
    cells = [
        # one row per class and position, so any aggregate picks it
        F.max(F.when(F.col("asset_class") == name, F.col(c))).alias(f"{name.lower()}_{c}")
        for name in limits
        for c in COLUMNS
    ]
    return numbered.groupBy("position").agg(*cells)
