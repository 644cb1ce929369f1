"""Top rows per group and distributed row numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def top_per_group(df: DataFrame, group: str, by: str, tie: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest ``by`` in each group, ties by ``tie``.

    Spark keeps only ``n`` rows per group and task before the shuffle, so a hot
    group costs its task no more than a small one.
    """
    order = W.partitionBy(group).orderBy(F.col(by).desc_nulls_last(), F.col(tie))
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def number_rows(df: DataFrame, group: str, key: str, name: str = "position", bits: int = 22) -> DataFrame:
    """1-based row number in ``key`` order within ``group``.

    ``key`` is a bigint that is unique in its group. A plain row number would
    sort a whole group in one task. Here the key's high bits form blocks, rows
    are numbered inside their block only, and the sizes of the blocks in front
    are added. No window ever holds more than ``2**bits`` rows of a level.
    """
    blocks = list(range(bits, 64, bits))
    numbered = df.withColumns({f"_b{shift}": F.shiftright(key, shift) for shift in blocks})

    in_block = W.partitionBy(group, f"_b{bits}").orderBy(key)
    numbered = numbered.withColumn(name, F.row_number().over(in_block).cast("bigint"))

    for level, shift in enumerate(blocks):
        enclosing = [f"_b{s}" for s in blocks[level:]]
        before = (
            W.partitionBy(group, *enclosing[1:2])
            .orderBy(enclosing[0])
            .rowsBetween(W.unboundedPreceding, -1)
        )
        sizes = (
            df.select(group, *[F.shiftright(key, s).alias(f"_b{s}") for s in blocks[level:]])
            .groupBy(group, *enclosing)
            .count()
            .select(group, enclosing[0], F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_ahead"))
        )
        numbered = (
            numbered.join(sizes, [group, enclosing[0]])
            .withColumn(name, F.col(name) + F.col("_ahead"))
            .drop("_ahead")
        )
    return numbered.drop(*[f"_b{shift}" for shift in blocks])
