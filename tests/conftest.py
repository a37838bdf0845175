import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ordermill-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def orders(spark):
    """Raw order lines from tuples of invoice, product, text, quantity, date, price, customer, country."""
    from ordermill.schema import RAW_ORDER_TEXT

    def make(*rows, dated=True):
        from decimal import Decimal

        from pyspark.sql import functions as F

        fixed = [(*r[:5], None if r[5] is None else Decimal(str(r[5])), *r[6:]) for r in rows]
        df = spark.createDataFrame(fixed, RAW_ORDER_TEXT)
        return df.withColumn("InvoiceDate", F.to_timestamp("InvoiceDate")) if dated else df

    return make
