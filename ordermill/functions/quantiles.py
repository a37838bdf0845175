"""Exact linear-interpolation quantiles that no single task has to hold, and that start no job of their own.

The built-in ``percentile`` merges every distinct value of a group in one task, which does not survive a column such
as revenue per customer on a large table. Here the input is read once into counts per distinct value (copies collapse
before the shuffle). The counts are dealt out by ranges of the value; the sums of the ranges, one row each, tell which
ranges hold the wanted ranks, and only within those a running sum finds the two neighbours of each. The result is a
lazy one-row frame, which filters and columns take in as a scalar subquery.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType)


def _whole_number(df: DataFrame, column: str) -> tuple[Column, int, int]:
    """``column`` as a bigint, the power of ten it was scaled by, and its width in bits."""
    kind = df.schema[column].dataType
    if isinstance(kind, WHOLE):
        return F.col(column).cast("bigint"), 0, 32
    if isinstance(kind, T.LongType):
        return F.col(column), 0, 63
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        scaled = F.col(column) * F.lit(10**kind.scale).cast("decimal(19,0)")
        return scaled.cast("bigint"), kind.scale, (10**kind.precision).bit_length()
    raise TypeError(f"exact quantiles need a whole or decimal(<=18) column, {column} is {kind}")


def scale_of(df: DataFrame, column: str) -> int:
    """The power of ten that ``value_counts`` scales a column by."""
    return _whole_number(df, column)[1]


def value_counts(df: DataFrame, columns: list[str], weight: str | None = None) -> DataFrame:
    """``name, v, n``: how often each column has each value, as a whole number of its smallest digit; nulls left out."""
    cells = [F.struct(F.lit(c).alias("name"), _whole_number(df, c)[0].alias("v")) for c in columns]
    weighed = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    values = df.select(F.inline(F.array(*cells)), weighed.alias("n")).where("v is not null")
    return values.groupBy("name", "v").agg(F.sum("n").alias("n"))


def quantile_ends(
    df: DataFrame, columns: list[str], fractions: list[float], weight: str | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """``name, v, p``: the values ``v`` on both sides of each quantile of each column, two rows for a quantile.

    ``v`` is a whole number of the smallest digit; ``p`` has the fraction, the side (0 below, 1 above) and the share
    of the way from the one to the other.
    """
    if counts is None:
        counts = value_counts(df, columns, weight)
    # a given number of ranges stays as it is, so that both readers below see the same ones
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.repartitionByRange(ranges, "name", "v").withColumn("part", F.spark_partition_id())
    whole, earlier = Window.partitionBy("name"), Window.partitionBy("name").orderBy("part")
    # as many rows as ranges
    sizes = dealt.groupBy("name", "part").agg(F.sum("n").alias("size"))
    sizes = sizes.withColumns({"total": F.sum("size").over(whole), "until": F.sum("size").over(earlier)})
    position = (F.col("total") - 1) * F.col("fraction")
    wanted = (
        sizes.withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
        .select("*", F.posexplode(F.array(F.floor(position), F.ceil(position))).alias("side", "rank"))
        .withColumn("inside", F.col("rank") - (F.col("until") - F.col("size")))
        .where("inside >= 0 and inside < size")
        .select("name", "part", "fraction", "side", "inside", (position - F.floor(position)).alias("share"))
    )
    # two ranks for each column and fraction, so at most as many ranges
    places = wanted.groupBy("name", "part").agg(F.collect_list(F.struct("fraction", "side", "inside", "share")).alias("places"))
    within = Window.partitionBy("name", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        dealt.join(F.broadcast(places), ["name", "part"])
        .withColumn("upto", F.sum("n").over(within))
        .select("name", "v", "n", "upto", F.explode("places").alias("p"))
        .where("p.inside >= upto - n and p.inside < upto")
        .select("name", "v", "p")
    )


def quantile_row(
    df: DataFrame, columns: list[str], fractions: list[float], weight: str | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """One row with an array of doubles for each column: its quantiles in the order of ``fractions``.

    Nulls are ignored; a column without any value has nulls. ``weight`` names a column that says how often a row
    counts. ``counts`` gives the value counts where they are at hand.
    """
    scales = {c: _whole_number(df, c)[1] for c in columns}
    found = quantile_ends(df, columns, fractions, weight, counts)

    def end(column: str, fraction: float, side: int) -> Column:
        here = (F.col("name") == column) & (F.col("p.fraction") == float(fraction)) & (F.col("p.side") == side)
        return F.max(F.when(here, F.col("v"))) / F.lit(float(10 ** scales[column]))

    cells = []
    for c in columns:
        quantiles = []
        for f in fractions:
            share = F.max(F.when((F.col("name") == c) & (F.col("p.fraction") == float(f)), F.col("p.share")))
            lower, upper = end(c, f, 0), end(c, f, 1)
            quantiles.append(lower + (upper - lower) * share)
        cells.append(F.array(*quantiles).alias(c))
    return found.agg(*cells)


def quantile_columns(df: DataFrame, column: str, fractions: list[float], weight: str | None = None) -> list[Column]:
    """The quantiles of one column as scalars for use in other frames."""
    row = quantile_row(df, [column], fractions, weight).select(column).scalar()
    return [row[k] for k in range(len(fractions))]


def exact_quantiles(
    df: DataFrame, columns: list[str], fractions: list[float], weight: str | None = None, few: int | None = None
) -> dict[str, list[float | None]]:
    """``quantile_row`` as numbers on the driver, for looking at. The plan is one and the same for all sizes; ``few``,
    which once chose between two, is still taken and changes nothing."""
    row = quantile_row(df, columns, fractions, weight).first()
    return {c: list(row[c]) for c in columns}
