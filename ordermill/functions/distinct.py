"""Several distinct counts, and sums beside them, from one read."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tallied(df: DataFrame, by: list[str], distinct: list[str], measures: dict[str, str]) -> DataFrame:
    """``by..., kind, value`` and measures: a row for each distinct value of each of the columns ``distinct`` in a group.

    ``measures`` names columns and how they are added up (``sum``, ``min`` or ``max``; of numbers or times); they go along with the first
    distinct column only, which should be the one with the fewest values. Every line gives one narrow row a column,
    which meets its likes where it is read: only distinct values go through the shuffle, which is on the group and the
    value, so a hot group is dealt out. All state is of fixed width, so nothing is sorted.
    """
    kinds = dict(df.dtypes)
    cells = []
    for k, column in enumerate(distinct):
        own = [F.col(m) if k == 0 else F.lit(None).cast(kinds[m]) for m in measures]
        cells.append(F.struct(F.lit(k).alias("kind"), F.col(column).cast("string").alias("value"), *[c.alias(m) for c, m in zip(own, measures)]))
    rows = df.select(*by, F.inline(F.array(*cells)))
    return rows.groupBy(*by, "kind", "value").agg(*[getattr(F, how)(m).alias(m) for m, how in measures.items()])


def values_of(kind: int) -> Column:
    """Distinct values of the column at that place of ``distinct``, nulls left out, as an aggregate of ``tallied`` rows."""
    return F.count(F.when(F.col("kind") == kind, F.col("value")))
