"""Model features: label codes, scaling, splitting and the two feature sets."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill import schema as S
from ordermill.functions import expressions as E
from ordermill.functions.picking import sample_n
from ordermill.operators import cleaning as C
from ordermill.session import settled

ENCODED = [f"{c}_encoded" for c in S.CATEGORY_FEATURES]
FEATURES = S.NUMERIC_FEATURES + ENCODED
RANGE_ENCODED = [f"{c}_encoded" for c in S.RANGE_FEATURES]


def label_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature, category, code``: the place of each category among the sorted ones.

    Missing values are the category ``nan``. ``df`` is read once. The categories are sorted by ranges, ranked within
    each range and offset by the counts of the earlier ranges, so no task holds the whole dictionary of a column with
    very many categories, whatever they begin with. The finished dictionary is kept on shared storage.
    """
    cells = [
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("category"))
        for c in columns
    ]
    spark = df.sparkSession
    distinct = df.select(F.inline(F.array(*cells))).distinct()
    ranges = distinct.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "feature", "category")
    categories = settled(ranges.withColumn("part", F.spark_partition_id()))
    earlier = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        categories.groupBy("feature", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("feature", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    place = F.row_number().over(Window.partitionBy("feature", "part").orderBy("category"))
    return settled(
        categories.withColumn("place", place)
        .join(offsets, ["feature", "part"])
        .select("feature", "category", (F.col("before") + F.col("place") - 1).cast("int").alias("code"))
    )


def label_encode(df: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_encoded``; categories that are not in the dictionary get 0.

    How each look-up is joined is left to Spark, which broadcasts a dictionary that it measures as small and splits
    the lines of a frequent category where it shuffles.
    """
    for c in columns:
        codes = dictionary.where(F.col("feature") == c).select(
            F.col("category").alias("_category"), F.col("code").alias("_code")
        )
        category = F.coalesce(F.col(c).cast("string"), F.lit("nan"))
        df = (
            df.join(codes, category == F.col("_category"), "left")
            .withColumn(f"{c}_encoded", F.coalesce("_code", F.lit(0)))
            .drop("_category", "_code")
        )
    return df


def scaling(train: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the mean and population deviation of every column."""
    stats = []
    for c in columns:
        value = F.col(c).cast("double")
        deviation = F.stddev_pop(value)
        stats += [F.avg(value).alias(f"{c}_mean"), F.when(deviation > 0, deviation).otherwise(1.0).alias(f"{c}_std")]
    return train.agg(*stats)


def standard_scale(df: DataFrame, stats: DataFrame, columns: list[str]) -> DataFrame:
    """Shift and scale ``columns`` by statistics that were fitted on the training rows."""
    once = stats.select(F.struct("*")).scalar()
    scaled = df.withColumn("_stats", once)
    values = {
        c: (F.col(c).cast("double") - F.col(f"_stats.{c}_mean")) / F.col(f"_stats.{c}_std") for c in columns
    }
    return scaled.withColumns(values).drop("_stats")


def in_train(test_size: float = 0.2, seed: int | None = None, key: Column | None = None) -> Column:
    """Whether a row is on the training side of the repeatable split by row key."""
    bucket = E.key_number(E.keyed(E.row_key() if key is None else key, seed)) % 100
    return bucket < round((1 - test_size) * 100)


def train_test_split(df: DataFrame, test_size: float = 0.2, seed: int | None = None, key=None) -> tuple:
    """Repeatable split by row key; copies of a line stay on the same side."""
    train = in_train(test_size, seed, key)
    return df.where(train), df.where(~train)


def training_sample(raw: DataFrame, sample_size: int | None = 50000, seed: int | None = None) -> DataFrame:
    """Valid lines within the training caps, by default a repeatable pick of 50,000."""
    lines = raw.transform(C.valid_sales).transform(C.training_caps).transform(C.with_revenue)
    return lines if sample_size is None else sample_n(lines, sample_size, E.row_key(), seed)


def model_columns(lines: DataFrame) -> DataFrame:
    """Lines with every column the revenue model's features come from."""
    return lines.transform(C.with_time_parts).transform(C.with_calendar_flags).transform(C.with_categories)


def train_features(raw: DataFrame, sample_size: int | None = 50000) -> tuple[DataFrame, DataFrame]:
    """The ten features, Revenue and row key of the training lines; and the label dictionary."""
    lines = model_columns(training_sample(raw, sample_size))
    if sample_size is not None:
        lines = settled(lines)
    dictionary = label_dictionary(lines, S.CATEGORY_FEATURES)
    encoded = label_encode(lines, dictionary, S.CATEGORY_FEATURES)
    return encoded.select(*FEATURES, "Revenue", E.row_key().alias("row_key")), dictionary


def prepare_ml_dataset(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scaled train and test rows of the coarser feature set, and its label dictionary.

    ``raw`` is read once, into a slim table of what the later steps need.
    """
    kept = raw.transform(C.drop_critical_nulls).transform(C.positive_lines)
    lines = settled(kept.select("Quantity", "UnitPrice", "InvoiceDate", "Country", E.row_key().alias("row_key")))
    lines = (
        lines.transform(C.trim_p99)
        .transform(C.with_revenue)
        .transform(C.with_time_parts)
        .transform(C.with_calendar_flags)
        .transform(C.with_ranges)
    )
    lines = settled(lines.select(*S.NUMERIC_FEATURES, *S.RANGE_FEATURES, "Revenue", "row_key"))
    dictionary = label_dictionary(lines, S.RANGE_FEATURES)
    encoded = label_encode(lines, dictionary, S.RANGE_FEATURES)
    columns = S.NUMERIC_FEATURES + RANGE_ENCODED
    rows = settled(encoded.select(*columns, "Revenue", "row_key"))
    train, test = train_test_split(rows, key=F.col("row_key"))
    stats = settled(scaling(train, columns))
    return standard_scale(train, stats, columns), standard_scale(test, stats, columns), dictionary


def target_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("samples"),
        F.min("Revenue").alias("min_revenue"),
        F.max("Revenue").alias("max_revenue"),
        E.mean(F.sum("Revenue"), F.count("Revenue")).alias("avg_revenue"),
    )
