"""Account segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.functions.trades import is_demo, is_p2, is_real, is_unbreached


def real(df: DataFrame) -> DataFrame:
    """Of trades, or of cells that have the segment as a key."""
    return df.where(F.col("real") if "real" in df.columns else is_real())


def demo(df: DataFrame) -> DataFrame:
    return df.where(~F.col("real") if "real" in df.columns else is_demo())


def p2(df: DataFrame) -> DataFrame:
    return df.where(is_p2())


def real_unbreached(df: DataFrame) -> DataFrame:
    return real(df).where(F.col("unbreached") if "unbreached" in df.columns else is_unbreached())


SEGMENTS = {"real": real, "demo": demo}


def segment_counts(cells: DataFrame) -> DataFrame:
    """Trades and logins per segment."""
    segment = F.when(is_real(), F.lit("Real")).otherwise(F.lit("Demo"))
    return cells.groupBy(segment.alias("segment")).agg(
        F.sum("trade_count").alias("trade_count"),
        F.countDistinct("login").alias("unique_logins"),
    )
