import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepwell.operators.normalize import normalize_transactions
from keepwell.operators.validation import DataValidationError, validate_transactions
from keepwell.schemas import SchemaError
from keepwell.sources.files import read_raw_transactions

RAW = "InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, " \
      "UnitPrice string, CustomerID string, Country string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_id_cleanup_and_lenient_parse(spark):
    df = normalize_transactions(raw(spark, [
        ("1", "P1", "x", "2", "2024-01-01 10:00:00", "1.5", "12345.0", "France"),
        ("2", "P1", "x", "abc", "zz", "1.0", "7", "France"),
    ]))
    rows = {r["invoice_no"]: r for r in df.collect()}
    assert rows["1"]["customer_id"] == "12345"
    assert rows["1"]["invoice_date"] == dt.datetime(2024, 1, 1, 10)
    assert rows["1"]["line_value"] == 3.0
    assert rows["2"]["quantity"] is None and rows["2"]["invoice_date"] is None


def test_cancellation_flag_null_safe(spark):
    df = normalize_transactions(raw(spark, [
        ("c123", "P", "x", "1", "2024-01-01", "1", "1", "UK"),
        ("123", "P", "x", "-1", "2024-01-01", "1", "1", "UK"),
        (None, "P", "x", "1", "2024-01-01", "1", "1", "UK"),
        ("9", "P", "x", None, "2024-01-01", "1", "1", "UK"),
    ]))
    flags = [r["is_cancellation"] for r in df.orderBy(F.col("invoice_no").asc_nulls_last()).collect()]
    # order: '123', '9', 'c123', null
    assert flags == [True, False, True, False]


def test_event_id_distinguishes_null_from_text(spark):
    df = normalize_transactions(raw(spark, [
        ("1", None, "x", "1", "2024-01-01", "1", "1", "UK"),
        ("1", "", "x", "1", "2024-01-01", "1", "1", "UK"),
    ]))
    assert df.select("event_id").distinct().count() == 2


def test_missing_columns_named(spark):
    with pytest.raises(SchemaError, match="country"):
        normalize_transactions(spark.createDataFrame([("1",)], "InvoiceNo string"))


def test_negative_price_blocks(spark):
    tx = normalize_transactions(raw(spark, [("1", "P1", "x", "1", "2024-01-01", "-1", "1", "France")]))
    with pytest.raises(DataValidationError, match="negative unit_price"):
        validate_transactions(tx)


def test_empty_customer_is_missing(spark):
    tx = normalize_transactions(raw(spark, [
        ("1", "P1", "x", "1", "2024-01-01", "1", "", "France"),
        ("2", "P1", "x", "1", "2024-01-02", "1", "5", "France"),
    ]))
    summary = validate_transactions(tx)
    assert summary["rows"] == 1 and summary["missing_customer_rate"] == 0.5


def test_reader_dispatch(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported"):
        read_raw_transactions(spark, str(tmp_path / "x.xlsx"))
    with pytest.raises(FileNotFoundError):
        read_raw_transactions(spark, str(tmp_path / "missing.csv"))
    path = tmp_path / "tx.csv"
    path.write_text("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                    "1,P1,x,2,2024-01-01 00:00:00,1.25,17850.0,United Kingdom\n")
    tx = normalize_transactions(read_raw_transactions(spark, str(path)))
    r = tx.first()
    assert r["customer_id"] == "17850" and r["line_value"] == 2.5


def test_month_first_export_dates(spark):
    df = normalize_transactions(raw(spark, [
        ("1", "P", "x", "6", "12/1/2010 8:26", "2.55", "17850.0", "United Kingdom"),
        ("2", "P", "x", "6", "2010-12-01 08:26:00", "2.55", "17850.0", "United Kingdom"),
    ]))
    dates = {r["invoice_date"] for r in df.collect()}
    assert dates == {dt.datetime(2010, 12, 1, 8, 26)}


def test_lenient_parse_takes_no_suffixes_or_bare_numbers(spark):
    df = normalize_transactions(raw(spark, [
        ("1", "P", "x", "5d", "12346", "2.5f", "1", "UK"),
        ("2", "P", "x", "1e3", "2010-12-01T08:26:00", ".5", "1", "UK"),
        ("3", "P", "x", "NaN", "20101201", "Infinity", "1", "UK"),
        ("4", "P", "x", " -7 ", "2010-12-01", "1.", "1", "UK"),
    ]))
    rows = {r["invoice_no"]: r for r in df.collect()}
    assert [rows[i]["quantity"] for i in "1234"] == [None, 1000.0, None, -7.0]
    assert [rows[i]["unit_price"] for i in "1234"] == [None, 0.5, None, 1.0]
    assert [rows[i]["invoice_date"] and rows[i]["invoice_date"].year for i in "1234"] == [None, 2010, None, 2010]


def test_csv_quotes_commas_and_line_ends(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                    '1,P1,"SET ""A"", LARGE",2,2024-01-01,1.25,17850.0,United Kingdom\n'
                    '2,P1,"two\nlines",3,2024-01-01,1.5,17851.0,France\n'
                    "3,P1,plain,4,2024-01-01,1.5,17852.0,France\n")
    rows = {r["invoice_no"]: r for r in normalize_transactions(read_raw_transactions(spark, str(path))).collect()}
    assert len(rows) == 3 and rows["1"]["description"] == 'SET "A", LARGE' and rows["2"]["description"] == "two\nlines"
    assert [rows[i]["quantity"] for i in "123"] == [2.0, 3.0, 4.0] and rows["2"]["customer_id"] == "17851"


def test_csv_sink_reads_back(spark, tmp_path):
    from keepwell.sources.files import read_csv, write_csv
    df = spark.createDataFrame([('a "b", c', 1.5, 2), ("d", None, 3)], "t string, x double, n int")
    write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"), df.schema)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_counters_come_from_the_pass_that_writes(spark, tmp_path):
    from pyspark.sql import Observation
    from keepwell.operators.validation import counters, validate_transactions, validation_summary, write_counted
    raw = spark.createDataFrame(
        [(f"{'C' if i % 9 == 0 else ''}{i}", "s", "d", float(i % 4 - 1), f"2024-01-{i % 27 + 1:02d} 10:00:00", 1.5, None if i % 10 == 0 else f"c{i % 6}", "Peru")
         for i in range(90)], "invoice_no string, stock_code string, description string, quantity double, invoice_date string, "
        "unit_price double, customer_id string, country string")
    lines = normalize_transactions(raw)
    counted = write_counted(lines, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert validation_summary(back, counted).first() == validation_summary(back).first()
    assert validate_transactions(back, counted=counted) == validate_transactions(back)
    plan = back.observe(Observation("x"), *counters())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
    assert write_counted(lines.limit(0), str(tmp_path / "e"))["all_rows"] == 0
