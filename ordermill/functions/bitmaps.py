"""Distinct counts of whole numbers that add up: one bit for each number, in bitmaps of 32,768 numbers each.

A bitmap is made where the rows are, merges with others by OR, and can be stored. The distinct customers of a week or
a year are those of its days' bitmaps put together, without a look at the lines. Numbers that lie close together, as
ids that are given out in turn, make few bitmaps.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmaps(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """``by..., bucket, bits``: the numbers of a column within each group; nulls are left out."""
    seen = df.where(F.col(column).isNotNull())
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bits")
    return seen.groupBy(*by, F.bitmap_bucket_number(column).alias("bucket")).agg(bits)


def merged(parts: DataFrame, by: list) -> DataFrame:
    """Bitmaps of coarser groups, such as weeks of days."""
    return parts.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(parts: DataFrame, by: list[str], name: str) -> DataFrame:
    """How many distinct numbers each group has."""
    return parts.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
