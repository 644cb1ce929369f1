"""Size check in front of a broadcast."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Rows in memory against the compressed columns that the estimate counts.
EXPANSION = 4

_SIZE = re.compile(r"sizeInBytes=([0-9.E+]+) ([KMGTPE]?i?B)")
_UNITS = {unit: 1024**n for n, unit in enumerate(("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"))}


def plan_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a frame, from file statistics; no job runs."""
    name = f"size_of_{uuid.uuid4().hex}"
    df.createTempView(name)
    try:
        plan = df.sparkSession.sql(f"EXPLAIN COST SELECT * FROM {name}").first()[0]
    finally:
        df.sparkSession.catalog.dropTempView(name)
    number, unit = _SIZE.search(plan).groups()
    return int(float(number) * _UNITS[unit])


def are_small(tables: list[DataFrame], limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether tables joined on their keys fit ``limit`` bytes of memory together.

    Such a join has no more rows than the largest of them; Spark's estimate for
    the join itself is the product of its inputs and says nothing. Files are taken
    for ``EXPANSION`` times their size.
    """
    return EXPANSION * sum(map(plan_bytes, tables)) <= limit
