"""Line numbers without sorting or moving the lines.

A scan cuts files into blocks that are read apart. Within a block, consecutive lines have
consecutive places, so a line number is its place minus the first place of its block, plus the
lines of all earlier blocks of the file. Only one small row per block is ever shuffled: a file
that holds a third of all lines is as many blocks as it has, and no task sees it whole.

`place` must stem from one evaluation: stage the scan before numbering it, so that counting and
numbering see the same rows even if files grow meanwhile.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def block_offsets(lines: DataFrame, file_columns, block_columns) -> DataFrame:
    """One row per block with `_shift`, the difference between line number and place."""
    blocks = lines.groupBy(*file_columns, *block_columns).agg(
        F.min("place").alias("_first"), F.count(F.lit(1)).alias("_lines")
    )
    earlier = (
        W.partitionBy(*file_columns)
        .orderBy(*block_columns)
        .rowsBetween(W.unboundedPreceding, -1)
    )
    return blocks.select(
        *file_columns, *block_columns,
        (F.coalesce(F.sum("_lines").over(earlier), F.lit(0)) - F.col("_first") + 1)
        .alias("_shift"),
    )


def number_lines(
    lines: DataFrame, offsets: DataFrame, file_columns, block_columns
) -> DataFrame:
    """Replace block and place by a 1-based `line_number`."""
    keys = [*file_columns, *block_columns]
    return lines.join(offsets, keys).select(
        *[c for c in lines.columns if c not in (*block_columns, "place")],
        (F.col("place") + F.col("_shift")).alias("line_number"),
    )


def numbered(lines: DataFrame, file_columns, block_columns) -> DataFrame:
    """Both steps at once, for lines that are staged or otherwise fixed."""
    offsets = block_offsets(lines, file_columns, block_columns)
    return number_lines(lines, offsets, file_columns, block_columns)
