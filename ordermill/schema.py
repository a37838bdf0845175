"""Schemas and fixed values shared by all operators."""

from pyspark.sql import types as T

RAW_ORDER_LINE = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("UnitPrice", T.DecimalType(18, 4)),
        T.StructField("CustomerID", T.LongType()),
        T.StructField("Country", T.StringType()),
    ]
)

RAW_COLUMNS = RAW_ORDER_LINE.fieldNames()

# InvoiceDate still as text: files and messages that may hold unparseable dates.
RAW_ORDER_TEXT = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "InvoiceDate" else f.dataType)
        for f in RAW_ORDER_LINE.fields
    ]
)

MONEY = "decimal(18,2)"
#: Prices have up to four digits after the point, so revenue has too; only results are rounded.
REVENUE = "decimal(18,4)"

# Defaults and lookup tables that results depend on.
CRITICAL_COLUMNS = ["CustomerID", "InvoiceDate", "Quantity", "UnitPrice"]
MESSAGE_COLUMNS = ["InvoiceNo", "Quantity", "UnitPrice"]
DATE_FORMATS = ["M/d/yyyy H:mm", "M/d/yyyy H:mm:ss"]
ANONYMOUS_CUSTOMER = 99999
UNKNOWN_PRODUCT = "Unknown Product"
UNKNOWN = "Unknown"
COUNTRY_NAMES = {
    "UNITED KINGDOM": "United Kingdom",
    "UK": "United Kingdom",
    "USA": "United States",
    "US": "United States",
}
PRICE_EDGES = [0, 2, 5, 15]
QUANTITY_EDGES = [0, 1, 3, 10]
PRICE_RANGE_EDGES = [0, 5, 15, 50]
QUANTITY_RANGE_EDGES = [0, 2, 5, 20]
PRICE_LABELS = ["Low", "Medium", "High", "Premium"]
QUANTITY_LABELS = ["Single", "Few", "Multiple", "Bulk"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
SEGMENT_FLOORS = {"VIP": 2000, "High Value": 1000, "Medium Value": 200}
SEGMENT_QUANTILES = {"VIP": 0.95, "High Value": 0.67, "Medium Value": 0.33}
LOWEST_SEGMENT = "Low Value"
HIGH_VALUE_REVENUE = 100
ORDER_MIX = {"random": 0.6, "high_value": 0.2, "bulk": 0.1, "single": 0.1}
METRIC_THRESHOLDS = {
    "cpu": (80.0, 95.0),
    "memory": (80.0, 95.0),
    "api_response": (1000.0, 5000.0),
}
SYSTEM_METRICS = {"cpu": "CPU", "memory": "memory"}
DEFAULT_THRESHOLDS = (80.0, 95.0)
NUMERIC_FEATURES = [
    "Quantity",
    "UnitPrice",
    "Hour",
    "DayOfWeek",
    "Month",
    "IsWeekend",
    "IsBusinessHours",
]
CATEGORY_FEATURES = ["Country", "PriceCategory", "QuantityCategory"]
RANGE_FEATURES = ["Country", "PriceRange", "QuantityRange"]
# The scorer's defaults, and those of the batch job, which leaves month and country to the scorer.
REQUEST_DEFAULTS = {
    "quantity": 1,
    "unit_price": 10.0,
    "hour": 14,
    "day_of_week": 2,
    "month": 6,
    "country": "United Kingdom",
}
BATCH_REQUEST_DEFAULTS = {"quantity": 1, "unit_price": 0.0, "hour": 12, "day_of_week": 1}
