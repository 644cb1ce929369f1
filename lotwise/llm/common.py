"""Reading tables, joins, Python workers and small column helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotwise.operators.lineage import stored as stored  # what the operators of this package import from here

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no name can clash with a working column."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ascii_lower(col: Column) -> Column:
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def merge_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join two sides of which neither has a bound: both are shuffled, and hot keys split at run time.

    The same plan at every size; without the hint, small inputs would be broadcast.
    """
    return left.join(right.hint("merge"), on, how)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "lotwise-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(archive)  # Spark's file server takes it to the executors
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, task: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose functions can import this package on every executor."""
    ship_package(df.sparkSession)
    return df.mapInArrow(task, schema)
