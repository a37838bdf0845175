"""Column expressions shared by the operators. All of them stay in generated JVM code."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.schema import DATE_FORMATS, RAW_COLUMNS, REVENUE, WEEKDAYS


def mean(total: Column, n: Column, digits: int = 2) -> Column:
    """``total / n`` in decimal arithmetic, rounded half up; null when ``n`` is 0."""
    return F.round(F.try_divide(total.cast("decimal(28,4)"), n.cast("decimal(20,0)")), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is 0."""
    return F.round(F.try_divide(part.cast("decimal(22,4)") * 100, whole.cast("decimal(22,4)")), digits)


def revenue() -> Column:
    return (F.col("Quantity") * F.col("UnitPrice")).cast(REVENUE)


def right_closed(value: Column, edges: list, labels: list, open_below: bool = False) -> Column:
    """Label of the bin ``(edges[i], edges[i+1]]`` that holds ``value``.

    The last bin has no upper edge. Values at or under the first edge have no bin,
    or fall in the first one with ``open_below``.
    """
    out = F.when(value.isNull(), None)
    if not open_below:
        out = out.when(value <= edges[0], None)
    for upper, label in zip(edges[1:], labels):
        out = out.when(value <= upper, label)
    return out.otherwise(labels[-1])


def weekday_name(index: Column) -> Column:
    """Monday for 0 to Sunday for 6."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), (index + 1).cast("int"))


def row_key() -> Column:
    """Repeatable key of an order line; lines that are equal in every column share it, no others do.

    Each text has its length before it and each number or time a mark after it, so no two lines run together to the
    same text.
    """
    parts = []
    for c in RAW_COLUMNS:
        if c in ("Quantity", "InvoiceDate", "UnitPrice", "CustomerID"):
            value = F.col(c).cast("decimal(18,4)") if c == "UnitPrice" else F.col(c)
            parts += [F.coalesce(value.cast("string"), F.lit("-")), F.lit(";")]
        else:
            parts.append(F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")))
    return F.md5(F.concat(*parts))


def typed(text: Column, kind: T.DataType) -> Column:
    """A text field as a value of ``kind``, or null if it isn't one.

    Whole numbers may have zeros after a point, as files that went through floating point have. Times come as ISO
    text with or without seconds, fractions and zone, or in one of the formats of the order files.
    """
    if isinstance(kind, (T.TimestampType, T.DateType)):
        tries = [F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]]
        return F.coalesce(*tries).cast(kind)
    if isinstance(kind, T.IntegralType):
        whole = F.trim(text)
        return F.when(whole.contains("."), F.regexp_replace(whole, r"\.0*$", "")).otherwise(whole).try_cast(kind)
    return text if isinstance(kind, T.StringType) else F.trim(text).try_cast(kind)


def key_number(key: Column) -> Column:
    """First 32 bits of a hexadecimal key as a whole number."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")


def keyed(key: Column, seed: int | None = None) -> Column:
    """``key`` itself, or a fresh key for every ``seed``."""
    return key if seed is None else F.md5(F.concat(key, F.lit(f"|{seed}")))


def ranked_key() -> list[Column]:
    """Order for text keys that puts whole numbers in numeric order."""
    return [F.length("key").asc(), F.col("key").asc()]
