"""Registry of queries with their oracle SQL, and what both sides share."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators import kpi
from ordermill.schema import RAW_COLUMNS
from checks.warehouse import retail_raw

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register a query ``(spark, folder) -> DataFrame`` and the SQL that must agree with it."""

    def add(run):
        def checked(spark: SparkSession, folder: str) -> DataFrame:
            return portable(run(spark, folder))

        checked.__name__, checked.__doc__ = name, run.__doc__
        QUERIES[name] = checked
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def portable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: text for dates, doubles for decimals, bigint for integers."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


MONEY_COLUMNS = ["Quantity", "UnitPrice", "CustomerID", "InvoiceDate"]


def raw(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Raw order lines; with ``columns`` only these and the ones valid sales are told by."""
    if not columns:
        return retail_raw(spark, folder)
    return retail_raw(spark, folder, [c for c in RAW_COLUMNS if c in columns or c in MONEY_COLUMNS])


def lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return kpi.order_lines(raw(spark, folder, *(columns or RAW_COLUMNS)))


# Oracle side. Money is whole cents, so that rounding is exact.

RAW = """
retail_raw as (
  select cast(l_orderkey as varchar) as InvoiceNo,
    cast(l_partkey as varchar) as StockCode,
    case when l_partkey % 97 = 0 then null
      when l_partkey % 11 = 0 then concat('  ', p_name, ' ')
      when l_partkey % 13 = 0 and l_orderkey % 7 = 0 then concat(p_name, ' v2')
      else p_name end as Description,
    cast(case when l_orderkey % 53 = 0 then -cast(l_quantity as int)
      when l_orderkey % 59 = 0 then 0
      when l_orderkey % 67 = 0 then 10 * cast(l_quantity as int)
      else cast(l_quantity as int) end as bigint) as Quantity,
    o_orderdate + interval '1' minute * ((o_orderkey * 37) % 1440) as InvoiceDate,
    cast(case when l_partkey % 89 = 0 then 0
      when l_partkey % 83 = 0 then (25 + (l_partkey * 7919) % 4000) / 2.0
      else (25 + (l_partkey * 7919) % 4000) / 100.0 end as decimal(10,2)) as UnitPrice,
    case when l_orderkey % 41 = 0 then null else o_custkey end as CustomerID,
    case n_nationkey when 0 then 'UK' when 1 then 'UNITED KINGDOM'
      when 2 then ' USA ' when 3 then 'US' else n_name end as Country
  from lineitem left join orders on l_orderkey = o_orderkey
    left join part on l_partkey = p_partkey
    left join customer on o_custkey = c_custkey
    left join nation on c_nationkey = n_nationkey)"""

DERIVED = """cast(round(UnitPrice * 100) as bigint) as price_cents,
    Quantity * cast(round(UnitPrice * 100) as bigint) as cents,
    cast(InvoiceDate as date) as Date, cast(hour(InvoiceDate) as bigint) as Hour,
    cast(isodow(InvoiceDate) - 1 as bigint) as DayOfWeek,
    cast(month(InvoiceDate) as bigint) as Month, cast(year(InvoiceDate) as bigint) as Year"""

VALID = "Quantity > 0 and UnitPrice > 0 and CustomerID is not null and InvoiceDate is not null"

LINES = f"""{RAW},
lines as (select *, {DERIVED} from retail_raw where {VALID})"""

ROW_KEY = "md5(" + " || ".join(
    f"coalesce({c}, '-') || ';'" if c.startswith("cast") else f"coalesce(length({c}) || ':' || {c}, '-')"
    for c in ["InvoiceNo", "StockCode", "Description", "cast(Quantity as varchar)", "cast(InvoiceDate as varchar)",
              "cast(cast(UnitPrice as decimal(18,4)) as varchar)", "cast(CustomerID as varchar)", "Country"]
) + ")"

REVENUE = "cast(sum(cents) as double) / 100"

COUNTRY = """case trim(Country) when 'UNITED KINGDOM' then 'United Kingdom' when 'UK' then 'United Kingdom'
    when 'USA' then 'United States' when 'US' then 'United States' else trim(Country) end"""

DESCRIPTION = "upper(trim(coalesce(Description, 'Unknown Product')))"


def with_lines(body: str) -> str:
    return f"with {LINES}\n{body}"


def with_raw(body: str) -> str:
    return f"with {RAW}\n{body}"


def half_up(numerator: str, denominator: str, digits: int = 2) -> str:
    """Whole-number ratio, rounded half away from zero; null when the denominator is 0."""
    n, d, scale = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)", 10**digits
    whole = f"((2 * abs({n}) * {scale} + {d}) // nullif(2 * {d}, 0))"
    return f"(cast(sign({n}) * {whole} as double) / {scale})"


def mean_cents(total: str = "sum(cents)", n: str = "count(*)", digits: int = 2) -> str:
    return half_up(total, f"100 * {n}", digits)


def bins(value: str, edges: list, labels: list, open_below: bool = False) -> str:
    out = "case" if open_below else f"case when {value} <= {edges[0]} then null"
    for upper, label in zip(edges[1:], labels):
        out += f" when {value} <= {upper} then '{label}'"
    return f"{out} when {value} is not null then '{labels[-1]}' end"


def text(timestamp: str) -> str:
    return f"strftime({timestamp}, '%Y-%m-%d %H:%M:%S')"


def quantile(column: str, fraction: float) -> str:
    return f"quantile_cont(cast({column} as double), {fraction})"
