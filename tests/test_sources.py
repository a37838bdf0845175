"""Files of the formats the readers promise."""

import json

from tests.helpers import rows
from pyspark.sql import functions as F

from ordermill.operators import cleaning, model
from ordermill.session import fresh_path
from ordermill.sources import orders as O
from ordermill.streaming import orders as stream


def test_latin1_csv_with_bad_fields(spark, tmp_path):
    text = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    text += "1,A,café,2,2024-01-01 10:00:00,1.50,7,UK\n2,B,,many,2024-01-01 10:00:00,1.50,,UK\n"
    (tmp_path / "orders.csv").write_bytes(text.encode("latin-1"))
    got = O.read_orders_csv(spark, str(tmp_path))
    assert rows(got, "InvoiceNo", "Description", "Quantity", "CustomerID") == [("1", "café", 2, 7), ("2", None, None, None)]


def test_json_array_file(spark, tmp_path):
    lines = [{"InvoiceNo": str(i), "Quantity": i, "UnitPrice": 1.25, "InvoiceDate": "2024-01-01T10:00:00"} for i in range(3)]
    (tmp_path / "orders.json").write_text(json.dumps(lines, indent=1))
    got = O.read_orders_json(spark, str(tmp_path))
    assert rows(got.select("InvoiceNo", F.hour("InvoiceDate"))) == [("0", 10), ("1", 10), ("2", 10)]


LINES = """InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country
1,A,x,2,12/1/2010 8:26,1.50,17850.0,UK
2,A,x,2,2010-12-01 08:26,0.001,17850,UK
3,A,x,2.0,2010-12-01 08:26:00.5,0.055, 17850 ,UK
4,A,x,2,2010-12-01T08:26:00.123456,1e-3,17850.5,UK
5,A,x,two,soon,free,,UK
6,A,x,,,,,UK
"""


def test_every_field_is_typed_or_told(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(LINES)
    got = O.read_orders_csv(spark, str(tmp_path))
    parts = got.select("InvoiceNo", "Quantity", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm"), F.col("UnitPrice").cast("string"), "CustomerID")
    day = "2010-12-01 08:26"
    assert rows(parts) == [
        ("1", 2, day, "1.5000", 17850),
        ("2", 2, day, "0.0010", 17850),
        ("3", 2, day, "0.0550", 17850),
        ("4", 2, day, "0.0010", None),
        ("5", None, None, None, None),
        ("6", None, None, None, None),
    ]
    rejected = O.rejected_orders(O.read_csv_text(spark, str(tmp_path)))
    assert rows(rejected, "InvoiceNo", "rejected_fields") == [("4", ["CustomerID"]), ("5", ["Quantity", "InvoiceDate", "UnitPrice"])]
    priced = got.transform(cleaning.valid_sales).transform(cleaning.with_revenue)
    assert rows(priced.select("InvoiceNo", F.col("Revenue").cast("string"))) == [("1", "3.0000"), ("2", "0.0020"), ("3", "0.1100")]


def test_messages_without_amounts_are_dead(spark):
    whole = json.dumps({"InvoiceNo": "1", "Quantity": 2, "UnitPrice": 0.055, "InvoiceDate": "2024-01-01T10:00:00.123456", "CustomerID": 17850.0})
    messages = spark.createDataFrame([(whole,), ("{}",), ('{"Quantity": 2}',), ('{"InvoiceNo": "1", "Quantity": "x", "UnitPrice": 1}',)], "value string")
    parsed = stream.parse_orders(messages)
    assert rows(parsed.select("InvoiceNo", "Quantity", F.col("UnitPrice").cast("string"), F.minute("InvoiceDate"), "CustomerID")) == [("1", 2, "0.0550", 0, 17850)]
    assert stream.dead_letters(messages).count() == 3


def test_a_run_that_is_tried_again_replaces_its_metrics(spark, tmp_path):
    for run in ("a", "b", "a"):
        O.append_metrics(spark.createDataFrame([(run, 1)], "run string, n int"), str(tmp_path), run)
    assert rows(O.read_metrics(spark, str(tmp_path)), "run", "n") == [("a", 1), ("b", 1)]


def test_model_survives_saving(spark):
    data = spark.range(200).select(F.col("id").alias("Quantity"), (F.col("id") % 7).alias("UnitPrice"))
    data = data.withColumn("Revenue", F.col("Quantity") * F.col("UnitPrice"))
    fitted = model.train_forest(data, ["Quantity", "UnitPrice"], numTrees=3, maxDepth=4, seed=1)
    encoders = spark.createDataFrame([("Country", "UK", 0)], "feature string, category string, code int")
    path = fresh_path(spark, "saved")
    model.save_model(fitted, encoders, path, "test")
    loaded, dictionary, about = model.load_model(spark, path)
    assert rows(loaded.transform(data), "prediction") == rows(fitted.transform(data), "prediction")
    assert about["feature_names"] == ["Quantity", "UnitPrice"] and dictionary.count() == 1
    assert model.feature_importance(loaded, spark).count() == 2


def test_every_record_is_typed_or_rejected(spark, tmp_path):
    lines = [
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country",
        '1,A,"one, two",2,2024-01-01 10:00:00,1.50,7,UK',
        "2,A,x",
        "3,A,x,1,2024-01-01 10:00:00,1.50,7,UK,extra",
        "4,A,x,many,2024-01-01 10:00:00,1.50,7,UK",
        "5,A,,1,2024-01-01 10:00:00,1.50,,",
    ]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    text = O.read_csv_text(spark, str(tmp_path))
    assert rows(O.typed_orders(text), "InvoiceNo") == [("1",), ("4",), ("5",)]
    rejected = O.rejected_orders(text)
    assert rows(rejected.select("reason", "record", F.array_join("rejected_fields", ","))) == [
        ("3 fields instead of 8", "2,A,x", ""),
        ("9 fields instead of 8", lines[3], ""),
        ("untyped", None, "Quantity"),
    ]


def test_cut_json_is_rejected_as_it_stands(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"InvoiceNo":"1","Quantity":2}\n{"InvoiceNo":"2","Quan\n[1, 2\nhello\n')
    text = O.read_json_text(spark, str(tmp_path), multi_line=False)
    assert rows(O.typed_orders(text), "InvoiceNo", "Quantity") == [("1", 2)]
    assert rows(O.rejected_orders(text), "record") == [("[1, 2",), ("hello",), ('{"InvoiceNo":"2","Quan',)]


def test_inventory_of_folders(spark, tmp_path):
    for folder, n in (("a", 3), ("b", 5)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / folder))
    files = O.file_inventory(spark, str(tmp_path), "id bigint")
    totals = {r["folder"]: (r["files"], r["rows"]) for r in O.folder_totals(files).collect()}
    assert totals == {"a": (1, 3), "b": (1, 5), "all": (2, 8)}
    name = files.where("folder = 'a'").first()["file_name"]
    expected = spark.createDataFrame([(name,), ("c.parquet",)], "file_name string")
    assert rows(O.completeness(files, expected)) == [("c.parquet", "missing"), (name, "present")]
    assert rows(O.completeness(files, expected, "2999-01-01"))[1] == (name, "stale")
