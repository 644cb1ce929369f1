"""Batches of documents that ask a table of all their distinct keys, without sending their texts.

A batch is one row that holds many documents and, as an array, the distinct keys in
them. Its keys cross the network once a batch, not once an occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.common import merge_join


def exploded(batches: DataFrame, *arrays: str) -> DataFrame:
    """One row for each distinct key: the batch's other columns, ``at`` (its place) and a value of each array."""
    others = [c for c in batches.columns if c not in arrays]
    rows = batches.select(*others, F.posexplode(F.arrays_zip(*arrays)).alias("at", "entry"))
    return rows.select(*others, "at", *[F.col(f"entry.{a}").alias(a) for a in arrays])


def answered(batches: DataFrame, asked: DataFrame, known: DataFrame, on: Column, *values: str) -> DataFrame:
    """Batches with ``answers``, an array of structs (at, values…), null if none of their keys has any.

    ``asked`` has a row of ``batch`` and ``at`` for each key of a batch, ``known`` a row of ``values``, not null, for a key at
    most. So the join has a row for each key asked, however many are known, and an array is no longer than the batch's keys.
    """
    found = merge_join(asked, known, on, "left")
    answer = F.when(F.col(values[0]).isNotNull(), F.struct("at", *values))
    back = found.groupBy(F.col("batch").alias("to")).agg(F.collect_list(answer).alias("answers"))
    return merge_join(batches, back, F.col("batch") == F.col("to"), "left").drop("to")
