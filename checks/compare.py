"""Run queries next to their oracle SQL: ``python -m checks.compare [folder] [name ...]``."""

import math
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from checks.registry import ORACLES, QUERIES
from checks.warehouse import TABLES


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ordermill-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def canonical(columns: list[str], rows: list) -> tuple:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(out, key=repr)


def difference(spark: SparkSession, con, folder: str, name: str) -> str:
    """Empty when both sides agree."""
    df = QUERIES[name](spark, folder)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return "" if got[1] else "no rows"
    result = con.execute(ORACLES[name])
    want = canonical([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    off = [(g, w) for g, w in zip(got[1], want[1]) if repr(g) != repr(w)]
    return f"{len(off)} of {len(want[1])} rows differ, first {off[0]}" if off else ""


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(folder)
    for name in sys.argv[2:] or QUERIES:
        began = time.time()
        try:
            found = difference(spark, con, folder, name)
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        kind = "oracle" if name in ORACLES else "rows"
        print(f"{'ok  ' if not found else 'FAIL'} {name} ({kind}, {time.time() - began:.1f}s) {found}", flush=True)


if __name__ == "__main__":
    main()
