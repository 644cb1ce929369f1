"""Exposure over a period, one segment of time after the other.

At a cut between two segments, the net lots of each login and symbol are all that later exposure depends on. So a segment,
such as a day, is computed from the nets at its start and the trades that open or close in it, and stores its peaks and the
nets at its end. A period is the largest of its segments' peaks; no earlier trade is read again.

Nets belong to the rows they were computed from: once a trade that was still open has closed, store the segments again from
the one in which it opened.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise import constants as K
from lotwise.operators.exposure import HOLDER, OWNER, breaches, exposure_legs, in_lots, nets, peaks, with_holders
from lotwise.operators.lineage import stored


def _place(root: str, name: str, at: str) -> str:
    # a time has one spelling, without a colon, which not all file systems take
    return f"{root.rstrip('/')}/{name}/at={datetime.fromisoformat(at):%Y-%m-%dT%H%M%S.%f}"


def store_segment(
    trades: DataFrame, root: str, start: str, end: str, opening: bool = False, limits=K.EXPOSURE_LIMITS, **options,
) -> None:
    """Store the peaks of a segment, and the nets at its end, under ``root``.

    ``start`` and ``end`` are times as text, such as ``2024-01-15``; the end is left out. ``trades`` are normalised and
    hold at least those that open or close in the segment; others do not count. ``opening`` starts a chain, with
    nothing live; else the segment that ends at ``start`` has to be stored. A segment may be stored again: it reads
    nothing that it writes.
    """
    spark = trades.sparkSession
    before = None if opening else spark.read.parquet(_place(root, "nets", start))
    inside = F.lit(False)
    for time in ("open_time", "close_time"):
        inside = inside | ((F.col(time) >= F.lit(start).cast("timestamp_ntz")) & (F.col(time) < F.lit(end).cast("timestamp_ntz")))
    legs = stored(exposure_legs(trades.where(inside), limits), "exposure-legs")
    window = (start, end)
    found = peaks(legs, window=window, before=before, stage=stored, **options)
    with_holders(found, legs).write.mode("overwrite").parquet(_place(root, "peaks", start))
    nets(legs, window, before).write.mode("overwrite").parquet(_place(root, "nets", end))


def exposure_of_segments(spark: SparkSession, root: str, starts: list[str], limits=K.EXPOSURE_LIMITS) -> DataFrame:
    """Logins whose largest live exposure in the segments that begin at ``starts`` reaches the threshold of the class.

    Over a whole chain this is ``exposure_breaches`` of all its trades.
    """
    found = spark.read.parquet(*[_place(root, "peaks", start) for start in starts])
    # the first trade of the period gives the account data
    merged = found.groupBy(*OWNER).agg(
        F.max("peak").alias("peak"), F.min(F.struct("first_id", *HOLDER)).alias("first"))
    return breaches(in_lots(merged.select(*OWNER, "peak", *[F.col(f"first.{c}") for c in HOLDER])), limits)
