"""Dense numbering of rows without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Bits below a block and below a group of blocks. A block has at most 2^22 keys, a group 2^22
# blocks, and 64-bit keys have at most 2^20 groups.
_BLOCK_BITS = 22
_GROUP_BITS = 44


def _before(order: str, group: str | None = None):
    """Rows counted in earlier blocks (of the same group)."""
    window = Window.partitionBy(F.col(group) if group else F.lit(0)).orderBy(order)
    return F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def number_rows(df: DataFrame, key: str, out: str) -> DataFrame:
    """Add ``out`` = 1, 2, 3, ... in ascending order of ``key``, a unique, non-NULL 64-bit integer.

    A plain ``row_number`` over the whole table runs in one task. Here rows are numbered within
    blocks of consecutive key values, and block sizes are summed up to give each block its offset.
    As keys are unique, key arithmetic alone bounds every window: 2^22 rows in a block, 2^22 blocks
    in a group and, in the only window over everything, 2^20 groups, however many rows there are
    and however their keys are distributed.
    """
    # Not nullable, so that no step adds a null filter of its own and all share one shuffle.
    block, group = (F.coalesce(F.shiftright(F.col(key), bits), F.lit(0)) for bits in (_BLOCK_BITS, _GROUP_BITS))
    blocks = df.groupBy(block.alias("_block"), group.alias("_group")).agg(F.count(F.lit(1)).alias("n"))
    groups = blocks.groupBy("_group").agg(F.sum("n").alias("n"))
    group_offsets = groups.select("_group", _before("_group").alias("_skipped"))
    offsets = (
        blocks.withColumn("_offset", _before("_block", "_group"))
        .join(group_offsets, "_group")
        .select("_block", (F.col("_offset") + F.col("_skipped")).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_block").orderBy(key))
    return (
        df.withColumn("_block", block)
        .withColumn("_within", within)
        .join(offsets, "_block")
        .withColumn(out, F.col("_within") + F.col("_offset"))
        .drop("_block", "_within", "_offset")
    )
